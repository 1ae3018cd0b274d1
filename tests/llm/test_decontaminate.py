import hashlib
import re

import pytest

from roomsight.llm import decontaminate as D
from roomsight.llm.common import WORD

from llm_rows import frame, invented, rows_of


def low(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")


def brute(docs, items, width=10):
    windows = {}
    for item, text in items:
        ws = re.findall(WORD, low(text))
        size = min(width, len(ws))
        for i in range(len(ws) - size + 1 if ws else 0):
            windows.setdefault(tuple(ws[i:i + size]), set()).add(item)
    out = []
    for doc_id, text in docs:
        ws = re.findall(WORD, low(text))
        hit, found = set(), set()
        for size in {len(w) for w in windows}:
            for i in range(len(ws) - size + 1):
                if tuple(ws[i:i + size]) in windows:
                    hit |= set(range(i, i + size))
                    found |= windows[tuple(ws[i:i + size])]
        names = sorted(str(i) for i in found if i is not None)
        out.append((doc_id, len(ws), len(hit), len(names),
                    hashlib.sha256(",".join(names).encode()).hexdigest(), bool(hit)))
    return sorted(out, key=str)


ITEMS = invented(6, 25, seed=5)


@pytest.fixture(scope="module")
def benchmark(spark):
    rows = [(i, t) for i, t in enumerate(ITEMS)]
    rows += [(6, ITEMS[0]), (0, ITEMS[0]), (7, "Short Item here"), (8, ""), (9, None), (None, ITEMS[1]),
             (10, "!!"), (11, "É́ x")]
    return spark.createDataFrame(rows, "item_id long, text string")


@pytest.fixture(scope="module")
def texts(messy_rows):
    w = ITEMS[0].split()
    extra = ["before " + ITEMS[0].upper() + " after", "a, b; " + ", ".join(w[3:13]) + "! c",
             " ".join(w[:9]), "x short ITEM here y short item", ITEMS[1] + " " + ITEMS[1] + " " + ITEMS[2],
             " ".join(w[:10]) + " " + " ".join(w[5:20])]
    return messy_rows + rows_of(extra, 200)


@pytest.mark.parametrize("block", [400_000, 7])
def test_brute_force(spark, texts, benchmark, block):
    got = D.report(frame(spark, texts), benchmark, block=block).collect()
    want = brute([r[:2] for r in texts], [tuple(r) for r in benchmark.collect()])
    assert sorted((tuple(r) for r in got), key=str) == want
    assert sum(r["contaminated"] for r in got) >= 5


def test_documents_go(spark, texts, benchmark):
    docs = frame(spark, texts)
    bad = {r[0] for r in brute([r[:2] for r in texts], [tuple(r) for r in benchmark.collect()]) if r[5]}
    kept = D.clean(docs, benchmark)
    assert kept.columns == docs.columns
    want = [r for r in texts if r[0] not in bad]
    assert sorted(map(str, (tuple(r) for r in kept.collect()))) == sorted(map(str, want))


def test_spans_go(spark, texts, benchmark):
    docs = frame(spark, rows_of(["One two " + ITEMS[0] + ", three.", "nothing here", None, "",
                                 "... " + ITEMS[3] + "!! End"]))
    rest = {r["doc_id"]: r["text"] for r in D.clean(docs, benchmark, "spans").collect()}
    assert rest == {0: "One two three.", 1: "nothing here", 2: None, 3: "", 4: "... End"}


def test_unknown_action(spark, texts, benchmark):
    with pytest.raises(ValueError):
        D.clean(frame(spark, texts), benchmark, "other")


def test_empty_tables(spark, nothing, messy, messy_rows, benchmark):
    assert D.report(nothing, benchmark).count() == 0
    none = benchmark.where("false")
    rows = D.report(messy, none).collect()
    assert len(rows) == len(messy_rows) and not any(r["contaminated"] for r in rows)
    assert D.clean(nothing, benchmark).count() == 0
