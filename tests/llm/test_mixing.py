import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from roomsight.llm import mixing as M

from llm_rows import CLASHING, frame


def shares(sizes, share=1.5, most=2):
    """Water filling step by step: hold the sources above their bound, share the rest anew."""
    names = sorted(s for s in sizes if s is not None) + [None] * (None in sizes)
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(names)}
    held, budget = {}, share * sum(sizes.values())
    while True:
        open_ = [s for s in names if s not in held]
        total = sum(weight[s] for s in open_)
        left = budget - sum(held.values())
        even = {s: weight[s] * left / total for s in open_}
        over = {s: most * sizes[s] for s in open_ if even[s] > most * sizes[s]}
        if not over:
            return {**held, **even}
        held.update(over)


@pytest.mark.parametrize("seed", range(20))
def test_targets(spark, seed):
    r = random.Random(seed)
    sizes = {f"s{i}": r.choice([0, 1, 10, 500, r.randint(1, 10_000)]) for i in range(r.randint(1, 12))}
    if seed % 2:
        sizes[None] = r.randint(0, 500)
    want = shares(sizes)
    table = spark.createDataFrame(list(sizes.items()), "source string, size long")
    found = M.targets(table).collect()
    assert {t.source for t in found} == set(sizes)
    for t in found:
        assert t.target == pytest.approx(want[t.source])
        assert t.target <= 2 * t.size
        assert t.epochs * t.size + t.rest == pytest.approx(t.target)


def rows_for(n, seed=2):
    r = random.Random(seed)
    names = ["hot"] * 4 + ["b", "c", "d", None, "é"]
    return [(i, " ".join(["w"] * r.choice([0, 1, 5, 30, 200]) + ["#|#"] * r.choice([0, 0, 3])), "en",
             r.choice(names), 0, *CLASHING) for i in range(n)]


@pytest.mark.parametrize("cells,cell_rows", [(1024, 20_000), (4, 3)])
def test_takes_come_near(spark, cells, cell_rows):
    docs = frame(spark, rows_for(600))
    rows = M.report(docs, cells=cells, cell_rows=cell_rows).collect()
    assert len(rows) == 600
    by = defaultdict(list)
    for r in rows:
        assert 0 <= r["taken"] <= 2 * r["size"] and (not r["size"] or r["taken"] % r["size"] == 0)
        by[r["source_size"], r["target"]].append(r)
    want = shares({s: sum(len(x[1].split()) for x in rows_for(600) if x[3] == s)
                   for s in {x[3] for x in rows_for(600)}})
    assert sorted(t for _, t in by) == pytest.approx(sorted(want.values()))
    for (size, target), mine in by.items():
        assert abs(sum(r["taken"] for r in mine) - target) <= max(r["size"] for r in mine) / 2
        assert sum(r["size"] for r in mine) == size


def test_cells_do_not_matter(spark):
    docs = frame(spark, rows_for(400))
    one = sorted(map(tuple, M.report(docs).collect()))
    assert one == sorted(map(tuple, M.report(docs.repartition(5), cells=4, cell_rows=2).collect()))
    assert one != sorted(map(tuple, M.report(docs, seed=12).collect()))


def test_joined_plan(spark):
    # One source is hot (4 of 9 rows), the others go the way of a shuffle.
    docs = frame(spark, rows_for(400))
    one = sorted(map(tuple, M.report(docs).collect()))
    assert one == sorted(map(tuple, M.report(docs, few_sources=3, cells=4, cell_rows=2).collect()))
    mixed = sorted(map(str, M.mix(docs).collect()))
    assert mixed == sorted(map(str, M.mix(docs, few_sources=3).collect()))


def test_any_number_of_sources(spark):
    # Names that sort as numbers do; each third source weighs 5, 2 or 1.
    n = 150_000
    docs = spark.range(n).select(
        F.col("id").alias("doc_id"), F.repeat(F.lit("w "), (F.col("id") % 7).cast("int")).alias("text"),
        F.format_string("s%06d", "id").alias("source"))
    rows = M.report(docs).collect()
    want = shares({f"s{i:06d}": i % 7 for i in range(n)})
    assert len(rows) == n and all(
        abs(r["target"] - want[f"s{r['doc_id']:06d}"]) < 1e-9 for r in rows)
    assert all(abs(r["taken"] - r["target"]) <= r["size"] / 2 for r in rows)


def test_quality_raises_the_odds(spark):
    rows = [(i, "w " * 10 + ("# " * 10 if i % 2 else "w " * 10), "en", s, 0, *CLASHING)
            for i in range(2000) for s in ("a",)]
    rows += [(5000 + i, "w " * 20, "en", "b", 0, *CLASHING) for i in range(2000)]
    taken = defaultdict(int)
    for r in M.report(frame(spark, rows), share=0.5).collect():
        if r["doc_id"] < 5000:
            taken[r["doc_id"] % 2] += r["taken"]
    assert taken[0] > 1.5 * taken[1]


def test_mix_repeats_rows(spark, messy, messy_rows):
    report = M.report(messy).collect()
    assert len(report) == len(messy_rows)
    mixed = M.mix(messy)
    assert mixed.columns == messy.columns
    words = sum(len((r["text"] or "").split()) for r in mixed.select("text").collect())
    # str.split knows more blanks than the operator; the fixture's others are in one row.
    assert abs(words - sum(r["taken"] for r in report)) <= 4


def test_empty(nothing, spark):
    assert M.report(nothing).count() == 0 and M.mix(nothing).count() == 0
    blank = frame(spark, [(1, "", "en", "a", 0, *CLASHING), (2, None, "en", None, 0, *CLASHING)])
    assert [(r["taken"], r["target"]) for r in M.report(blank).collect()] == [(0, 0.0)] * 2
