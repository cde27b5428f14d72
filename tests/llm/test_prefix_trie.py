import hashlib
import math
import random
from zlib import crc32

import pytest

from perigee.llm import prefix_trie as pt
from perigee.llm.prefix_trie import prefix_trie, running_sums, two_fattest

SCHEMA = "conv_id bigint, turn bigint, role string, text string, s bigint, rep string, `_key` int"


def digest(role, text):
    role, text = (role or "").encode(), (text or "").encode()
    h = hashlib.md5(b"%d:%b%b" % (len(role), role, text)).digest()
    return int.from_bytes(h[:8], "big", signed=True), int.from_bytes(h[8:], "big", signed=True)


def brute(rows):
    turns = {}
    for c, t, role, text in rows:
        if c is not None:
            turns.setdefault(c, []).append(((t is not None, t or 0), digest(role, text), (role or "", text or "")))
    turns = {c: [x[2] for x in sorted(v)] for c, v in turns.items()}
    built = {}
    for c, own in turns.items():
        h = crc32(str(c).encode()) % 4
        built[c] = tuple(turns.get(c - int(math.fmod(c, 20)), [])[:h] + own[h:])
    members, ends, children = {}, {}, {}
    for c, s in built.items():
        for d in range(len(s) + 1):
            members.setdefault(s[:d], []).append(c)
            if d:
                children.setdefault(s[: d - 1], set()).add(s[:d])
        ends.setdefault(s, []).append(c)
    leaves, saved = dict.fromkeys(members, 0), dict.fromkeys(members, 0)
    for node, cs in members.items():
        for d in range(len(node) + 1):
            leaves[node[:d]] += node not in children
            saved[node[:d]] += (len(cs) - 1) * (len(node[-1][1].encode().split()) if node else 0)
    return sorted(
        (min(cs), len(node), min(members[node[:-1]]) if node else None, len(cs), len(children.get(node, ())), leaves[node], saved[node],
         hashlib.sha256(",".join(map(str, sorted(ends.get(node, [])))).encode()).hexdigest())
        for node, cs in members.items()
    )


COLUMNS = ("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")


def result(df):
    return sorted(tuple(r[c] for c in COLUMNS) for r in df.collect())


def frame(spark, rows):
    return spark.createDataFrame([(*r, 1, "x", 2) for r in rows], SCHEMA)


def test_numbers_with_most_trailing_zeros(spark):
    rows = [(a, b) for a in range(0, 70, 3) for b in range(a + 1, 75)]
    got = spark.createDataFrame(rows, "a bigint, b bigint").select("a", "b", two_fattest("a", "b").alias("f")).collect()
    for r in got:
        assert r["f"] == max(range(r["a"] + 1, r["b"] + 1), key=lambda x: (x & -x, x))


@pytest.mark.parametrize("ranges", [1, 7])
def test_running_sums_of_a_hot_key(spark, ranges):
    rng = random.Random(3)
    rows = [(k if i % 3 else 5, i, rng.randrange(1 << 62)) for i, k in enumerate(rng.choices(range(12), k=3000))]
    spark.conf.set("spark.sql.shuffle.partitions", str(ranges))
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        got = running_sums(spark.createDataFrame(rows, "k bigint, i bigint, v bigint"), ["k"], ["i"], ["v"]).collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "8")
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    want, total = {}, {}
    for k, i, v in rows:
        total[k] = (total.get(k, 0) + v) & pt.MASK
        want[i] = (k, total[k])
    assert {r["i"]: (r["k"], r["v"]) for r in got} == want


def test_given_conversations(spark, sf):
    df = spark.read.parquet(f"{sf}/conversations.parquet")
    assert result(prefix_trie(df)) == brute([(r["conv_id"], r["turn"], r["role"], r["text"]) for r in df.collect()])


def test_comb_copies_and_long_edges(spark, monkeypatch):
    monkeypatch.setattr(pt, "EDGE", 4)
    monkeypatch.setattr(pt, "PIECE", 20)
    rng = random.Random(1)
    base = [f"t{rng.randrange(3)} w{i}" for i in range(41)]
    rows = []
    for c in range(-40, 90):
        kind = c % 5
        text = base[: c % 41] if kind == 0 else base if kind == 1 else base[: c % 37] + ["own", str(c % 3)] if kind == 2 else [str(rng.randrange(2)) for _ in range(6)]
        rows += [(c, i, "user" if i % 2 else "assistant", t) for i, t in enumerate(text)]
    assert result(prefix_trie(frame(spark, rows))) == brute(rows)


def test_odd_rows(spark):
    rows = [
        (1, None, None, None), (1, None, "a", None), (1, 0, "a", ""), (1, 0, "a", ""), (1, 3, "user", "x \x0b y z"), (2, 0, "u", "long " * 50_000),
        (None, 1, "u", "nobody"), (20, 5, "a", "b"), (20, 5, "b", "a"), (21, None, "ab", "c"), (22, 1, "a", "bc"), (23, 1, None, "x"), (24, 1, "", "x"),
        (47, 0, "a", "only"), (48, 0, "a", "only"), (49, 0, "a", "only"), (50, 0, "a", "only"), (51, 0, "a", "only"), (-3, 0, "a", "b"),
    ]
    assert result(prefix_trie(frame(spark, rows))) == brute(rows)
    assert prefix_trie(frame(spark, [])).collect() == []
