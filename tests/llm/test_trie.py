import hashlib
import random
import zlib
from collections import Counter, defaultdict

import pytest

from roomsight.llm import trie as T

SCHEMA = "conv_id long, turn long, role string, text string, a long, depth string, c string, place long"


def table(spark, rows):
    return spark.createDataFrame([(*r, 7, "d", "c", None) for r in rows], SCHEMA)


def slow(rows):
    """Node by node, from lists."""
    convs = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            role, text = role or "", text or ""
            digest = hashlib.md5(f"{len(role.encode())}|{role}|{text}".encode()).hexdigest()
            convs[c].append((turn is not None, turn or 0, digest, role, text))
    plain = {c: [x[3:] for x in sorted(turns)] for c, turns in convs.items()}
    made = {}
    for c, turns in plain.items():
        h = zlib.crc32(str(c).encode()) % 9
        base = c - int(c - 5 * int(c / 5))  # the remainder has the sign of c
        made[c] = plain.get(base, [])[:h] + turns[h:]
    members = defaultdict(list)
    for c, turns in sorted(made.items()):
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(c)
    children = defaultdict(list)
    for key in members:
        if key:
            children[key[:-1]].append(key)
    leaves, saved = {}, {}
    for key in sorted(members, key=len, reverse=True):
        below = children[key]
        leaves[key] = sum(leaves[k] for k in below) if below else 1
        own = (len(members[key]) - 1) * len(key[-1][1].encode()) if key else 0
        saved[key] = own + sum(saved[k] for k in below)
    return Counter((m[0], len(key), members[key[:-1]][0] if key else None, len(m), len(children[key]), leaves[key],
                    saved[key], hashlib.sha256(",".join(str(c) for c in m if len(made[c]) == len(key)).encode())
                    .hexdigest()) for key, m in members.items())


def check(spark, rows):
    got = T.report(table(spark, rows))
    assert got.columns == ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves",
                           "saved_tokens", "ends_sha256"]
    assert Counter(tuple(r) for r in got.collect()) == slow(rows)


def made(n, seed, most=9, words="abc"):
    r = random.Random(seed)
    return [(c, t, "user" if t % 2 else "assistant", r.choice(words) * (1 + t))
            for c in range(n) for t in range(r.randint(1, most))]


@pytest.mark.parametrize("seed", [1, 2])
def test_against_lists(spark, seed):
    rows = made(60, seed)
    random.Random(seed).shuffle(rows)
    check(spark, rows)


def test_messy(spark):
    rows = made(25, 3) + [
        (None, 0, "user", "lost"), (None, None, None, None), (7, None, None, None), (7, None, "user", "x"),
        (7, 0, "user", "x"), (7, 0, "user", "x"), (40, None, None, None), (-3, 1, "user", "minus"), (-3, 0, "user", ""),
        (-5, 0, "user", "minus five"), (51, 3, "user", "ñ中\U0001F600" * 5), (51, 3, "us", "er|x"), (51, 3, "us|er", "x"),
        (2 ** 62, 0, "user", "far"), (53, 1, "user", "long " * 50_000)]
    check(spark, rows)


def test_copies_and_a_wide_root(spark, monkeypatch):
    """One conversation and one first turn hold most rows."""
    monkeypatch.setattr(T, "MANY_CHILDREN", 20)
    rows = [(c, t, "user", f"same{t}") for c in range(0, 900, 5) for t in range(6)]
    rows += [(c, t, "user", "hello" if t == 0 else f"own{c}") for c in range(1000, 1300, 5) for t in range(3)]
    rows += [(c, 0, "user", f"first{c}") for c in range(2000, 2200, 5)]
    check(spark, rows)
    monkeypatch.setattr(T, "SHORT_LIST", 0)
    check(spark, rows)


def test_long_chain_in_stretches(spark, monkeypatch):
    """A conversation of most rows: cut in stretches, contracted in few rounds."""
    monkeypatch.setattr(T, "STRETCH", 16)
    rows = [(5, t, "user", f"t{t}") for t in range(300)] + [(10, t, "user", f"t{t}") for t in range(200)]
    rows += [(15, t, "user", f"t{t}" if t < 90 else "else") for t in range(120)] + made(8, 4)
    check(spark, rows)


def test_empty(spark):
    assert T.report(table(spark, [])).count() == 0
    assert T.report(table(spark, [(None, 0, "user", "x")])).count() == 0
    # crc32("1") % 9 is past its only turn, and there is no conversation 0: a root alone
    c = next(c for c in range(1, 100) if c % 5 and zlib.crc32(str(c).encode()) % 9 >= 1)
    got = T.report(table(spark, [(c, 0, "user", "x")])).collect()
    assert [tuple(r) for r in got] == [(c, 0, None, 1, 0, 1, 0, hashlib.sha256(str(c).encode()).hexdigest())]


@pytest.mark.parametrize("seed", [5, 6])
def test_subtree_totals_of_any_tree(spark, seed):
    """Chains, stars and random trees, several roots."""
    r = random.Random(seed)
    parent, depth = {0: None, 1: None}, {0: 0, 1: 0}
    for i in range(2, 400):
        p = i - 1 if i < 150 else r.choice([0, r.randrange(i), i - 1])
        parent[i], depth[i] = p, depth[p] + 1
    total = {i: i for i in parent}
    for i in sorted(parent, key=depth.get, reverse=True):
        if parent[i] is not None:
            total[parent[i]] += total[i]
    rows = [(i, -i, p, None if p is None else -p, depth[i], i) for i, p in parent.items()]
    tree = spark.createDataFrame(rows, "a long, b long, pa long, pb long, depth long, v long")
    got = T.subtree_totals(tree, ["v"]).collect()
    assert len(got) == len(rows) and {x["a"]: x["v"] for x in got} == total


def test_given_conversations(spark, folder):
    turns = spark.read.parquet(f"{folder}/conversations.parquet").select("conv_id", "turn", "role", "text")
    assert Counter(tuple(r) for r in T.report(turns).collect()) == slow([tuple(r) for r in turns.collect()])
