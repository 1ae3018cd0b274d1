import re

import pytest

from llm_rows import frame, rows_of
from roomsight.llm import licences as L
from roomsight.llm.common import WORD

NOTICE = dict(L.TEMPLATES[::-1])["bsd"]


def slow_base(text):
    ws = re.findall(WORD, "".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    places, labels = [], set()
    for label, phrase in L.BASE:
        p = phrase.split()
        for i in range(len(ws) - len(p) + 1):
            if ws[i:i + len(p)] == p:
                places.append(i)
                labels.add(label)
    return (len(ws), len(places), min(places, default=None), max(places, default=None),
            ",".join(sorted(labels)))


TEXTS = ["Licensed under the Apache License, Version 2.0.", "Released UNDER the MIT-license. under the mit license",
         "cc by nc cc by nc cc by NC 4.0", "under the mit", "apache license version 2 under the mit license x cc by nc",
         NOTICE.replace("binary", "binary very new").replace("with or", "with"), NOTICE[:60], "x " * 5000 + NOTICE,
         "This work is licensed under the GNU General Public License, version 3.", "ünder the mit license"]


@pytest.fixture(scope="module")
def rows(messy_rows):
    return messy_rows + rows_of(TEXTS, 200)


def test_base_by_brute_force(spark, rows):
    got = L.report(frame(spark, rows)).collect()
    want = sorted(((r[0], *slow_base(r[1])) for r in rows), key=str)
    assert sorted(((r["doc_id"], r["n_words"], r["n_base"], r["first_word"], r["last_word"],
                    r["base_labels"]) for r in got), key=str) == want
    for r in got:
        assert set(filter(None, r["base_labels"].split(","))) <= set(r["labels"].split(","))
        assert 0 <= r["score"] <= 1 and (r["score"] == 1 or not r["n_base"])


def test_passages_with_changes(spark, rows):
    labels = {r["doc_id"]: r["labels"] for r in L.report(frame(spark, rows)).collect()}
    assert labels[200 + 5] == "bsd" and labels[200 + 6] == "" and labels[200 + 7] == "bsd"
    assert labels[200 + 8] == "gpl-3" and labels[200 + 0] == "apache-2" and labels[200 + 3] == ""


def test_empty(spark, nothing):
    assert L.report(nothing).count() == 0


def test_short_template(spark, nothing):
    with pytest.raises(ValueError):
        L.report(nothing, templates=(("x", "two words"),))
