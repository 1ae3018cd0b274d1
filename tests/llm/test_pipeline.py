import os
import sys
from collections import Counter

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, ROOT)

import __spark_entry__ as entry  # noqa: E402
import corpus_pipeline as P  # noqa: E402
from test_decontaminate import brute as slow_hits  # noqa: E402
from test_simhash import slow_components, slow_fingerprint  # noqa: E402
from test_tokens import want as slow_ids  # noqa: E402


def test_stages_by_brute_force(spark, folder):
    """Each stage's rows against a slow version on what the stage before it kept."""
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    columns = docs.columns
    kept = [docs.collect()]
    for name, stage in P.STAGES[:-1]:
        docs = spark.createDataFrame(kept[-1], docs.schema)
        out = stage(spark, docs, folder)
        assert out.columns == columns, name
        kept.append(out.collect())
    whole, clean, single, pure, mixed = kept

    bad = {"idiot", "scum", "trash", "moron", "loser", "clown", "stupid", "worthless", "pathetic", "disgusting"}
    gone = {r["doc_id"] for r in whole} - {r["doc_id"] for r in clean}
    assert gone and sum(not bad & set(r["text"].lower().replace(".", " ").replace(",", " ").split())
                        for r in whole if r["doc_id"] in gone) <= 0.01 * len(whole) + 1

    rows = sorted(clean, key=lambda r: r["doc_id"])
    roots = slow_components([slow_fingerprint(r["text"]) for r in rows])
    assert {r["doc_id"] for r in single} == {rows[i]["doc_id"] for i, x in enumerate(roots) if i == x}

    items = [tuple(r) for r in spark.read.parquet(f"{folder}/benchmark.parquet").select("item_id", "text").collect()]
    hits = {r[0] for r in slow_hits([(r["doc_id"], r["text"]) for r in single], items) if r[5]}
    assert hits and {r["doc_id"] for r in pure} == {r["doc_id"] for r in single} - hits

    times = Counter(r["doc_id"] for r in mixed)
    sizes = {r["doc_id"]: len(r["text"].split()) for r in pure}
    assert set(times) <= set(sizes) and max(times.values()) <= 2
    total = sum(sizes.values())
    assert abs(sum(sizes[i] * n for i, n in times.items()) - 1.5 * total) <= 0.2 * total

    last = P.STAGES[-1][1](spark, spark.createDataFrame(mixed, docs.schema), folder).collect()
    assert Counter((r["doc_id"], r["n_tokens"], r["ids_crc32"]) for r in last) == Counter(slow_ids(mixed))


def test_run(spark, folder):
    rows = P.run(spark, folder).collect()
    assert sorted(r["start"] for r in rows)[0] == 0 and len(rows) > 100
    assert [n for n, _ in P.STAGES][0] == "toxicity" and len(P.STAGES) == 5


@pytest.mark.parametrize("name", ["op1_decontaminate", "op2_mixture", "op9_licence_scan"])
def test_same_as_sql(spark, folder, name):
    import duckdb

    con = duckdb.connect()
    for table in ("documents", "benchmark"):
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{folder}/{table}.parquet'")
    found = con.execute(entry.oracle_sql()[name])
    names = [d[0] for d in found.description]
    want = Counter(found.fetchall())
    got = entry.queries()[name](spark, folder)
    assert sorted(got.columns) == sorted(names)
    assert Counter(tuple(r) for r in got.select(*names).collect()) == want


def test_each_operator_is_registered():
    for n in range(1, 11):
        assert [q for q in entry.queries() if q.startswith(f"op{n}_")], n
