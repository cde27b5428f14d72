from pathlib import Path

import numpy as np
import pytest
import xxhash

from perigee.llm import simhash
from perigee.llm.simhash import block_masks, close_groups, link_close, op2_simhash, similar_groups
from perigee.session import shared_dir


def brute_fingerprint(text, size=3):
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    shingles = [b" ".join(words[i : i + size]) for i in range(len(words) - size + 1)] or [b" ".join(words)]
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_groups(values, radius=3):
    x = np.array(values, np.uint64)
    near = np.bitwise_count(x[:, None] ^ x[None, :]) <= radius
    label = np.arange(len(x))
    while True:
        new = np.where(near, label[None, :], len(x)).min(axis=1)
        if (new == label).all():
            return label.tolist()
        label = new


def test_fingerprints_and_groups(spark, sf, documents):
    got = {r["doc_id"]: (r["fingerprint"], r["component_id"]) for r in op2_simhash(spark, sf).collect()}
    fps = [brute_fingerprint(t) for _, t, _ in documents]
    groups = brute_groups(fps)
    for (doc, _, _), fp, group in zip(documents, fps, groups):
        assert got[doc] == (f"{fp:016x}", documents[group][0])


@pytest.mark.parametrize("run", [16, 2048])
def test_all_close_pairs_are_linked(spark, monkeypatch, run):
    """Random and crowded fingerprints; with short runs, blocks are split again and again."""
    monkeypatch.setattr(simhash, "RUN", run)
    rng = np.random.default_rng(5)
    centres = rng.integers(0, 1 << 63, 12, dtype=np.uint64)
    near = [int(c) ^ sum(1 << int(b) for b in rng.choice(64, rng.integers(0, 4), replace=False)) for c in centres for _ in range(40)]
    values = sorted({*near, *rng.integers(0, 1 << 63, 300, dtype=np.uint64).tolist(), 0, 1, 3})
    signed = [v - (1 << 64) if v >> 63 else v for v in values]
    fps = spark.createDataFrame([(v,) for v in signed], "fp bigint")
    edges = [(r["a"] % (1 << 64), r["b"] % (1 << 64)) for r in link_close(fps, 3).collect()]
    assert all((a ^ b).bit_count() <= 3 for a, b in edges)
    parent = {v: v for v in values}

    def root(v):
        while parent[v] != v:
            v = parent[v]
        return v

    for a, b in edges:
        parent[max(root(a), root(b))] = min(root(a), root(b))
    assert [root(v) for v in values] == [values[g] for g in brute_groups(values)]


def test_blocks_cover_all_bits():
    for path in [1, *[p for p, _ in block_masks(1, 4)], *[p for p, _ in block_masks(6, 4)]]:
        masks = [m for _, m in block_masks(path, 4)]
        assert np.bitwise_or.reduce(np.array(masks, np.uint64)) == np.uint64(0xFFFFFFFFFFFFFFFF)


def test_similar_texts_leave_one(spark):
    rng = np.random.default_rng(3)
    vocabulary = [f"w{i}" for i in range(3000)]
    rows, near = [], set()
    for g in range(60):
        words = rng.choice(vocabulary, 200).tolist()
        rows.append((g * 10, " ".join(words)))
        for k in range(1, 4):  # two changed words: about 0.9 of the shingles stay
            copy = list(words)
            for at in rng.choice(200, 2, replace=False):
                copy[at] = "changed"
            rows.append((g * 10 + k, " ".join(copy)))
            near.add(g * 10 + k)
        half = words[:120] + rng.choice(vocabulary, 80).tolist()
        rows.append((g * 10 + 5, " ".join(half)))
    out = similar_groups(spark.createDataFrame(rows, "doc_id bigint, text string"), ["doc_id", "text"]).collect()
    dropped = {r["doc_id"] for r in out if not r["first"]}
    assert len(out) == len(rows)
    assert len(near - dropped) <= len(near) // 20 and not dropped - near


def test_odd_rows(odd, nothing):
    rows = close_groups(odd).collect()
    assert len(rows) == odd.count()
    group = {r["doc_id"]: r["component_id"] for r in rows}
    assert group[1] == group[2] == group[3] == 1 and group[5] == group[None] == 5 and group[9] == 8
    assert close_groups(nothing).collect() == []
    stay = [r["doc_id"] for r in similar_groups(odd, ["doc_id", "_text"]).collect() if r["first"]]
    assert sorted(stay) == [1, 4, 5, 7, 8, 10]
    assert similar_groups(nothing, ["doc_id"]).collect() == []


def test_pairs_at_the_limit_are_told_exactly(spark):
    """Pairs of 0.74 to 0.86: none below 0.8 is linked, and of those from 0.8 on 0.99 are found at least."""
    rng = np.random.default_rng(11)
    rows, similar = [], {}
    for g in range(1500):
        words = [f"v{i}" for i in rng.integers(0, 1 << 30, 236)]
        copy = list(words)
        # The last k words changed are k of 232 shingles: 18 give 0.86, 25 give 0.805, 26 give 0.798, 35 give 0.74.
        k = int(rng.integers(18, 36))
        copy[236 - k :] = [f"u{i}" for i in rng.integers(0, 1 << 30, k)]
        rows += [(2 * g, " ".join(words)), (2 * g + 1, " ".join(copy))]
        a, b = ({tuple(t[i : i + 5]) for i in range(len(t) - 4)} for t in (words, copy))
        similar[2 * g + 1] = len(a & b) / len(a | b)
    out = similar_groups(spark.createDataFrame(rows, "doc_id bigint, text string"), ["doc_id"]).collect()
    dropped = {r["doc_id"] for r in out if not r["first"]}
    near = {d for d, s in similar.items() if s >= 0.8}
    limit = {d for d in near if similar[d] < 0.82}
    assert len(limit) > 150 and len(similar) - len(near) > 500
    assert dropped <= near and len(near - dropped) <= 0.01 * len(near) and len(limit - dropped) <= 0.03 * len(limit)


def test_groups_of_chained_copies_match_brute_force(spark):
    """A crowd around one text, whose members are similar to some and not to others: components of all true pairs, none other."""
    rng = np.random.default_rng(12)
    base = [f"b{i}" for i in range(204)]
    texts = [base]
    for g in range(150):
        words = list(texts[int(rng.integers(0, len(texts)))])
        for at in rng.choice(204, int(rng.integers(2, 9)), replace=False):
            words[at] = f"c{g}x{at}"
        texts.append(words)
    sets = [{tuple(t[i : i + 5]) for i in range(len(t) - 4)} for t in texts]
    label = list(range(len(texts)))

    def root(v):
        while label[v] != v:
            v = label[v]
        return v

    for i in range(len(texts)):
        for j in range(i):
            if len(sets[i] & sets[j]) / len(sets[i] | sets[j]) >= 0.8:
                label[max(root(i), root(j))] = min(root(i), root(j))
    df = spark.createDataFrame([(i, " ".join(t)) for i, t in enumerate(texts)], "doc_id bigint, text string")
    stay = {r["doc_id"] for r in similar_groups(df, ["doc_id"], recall=0.9999).collect() if r["first"]}
    assert stay == {root(i) for i in range(len(texts))} and 1 < len(stay) < len(texts) - 10


@pytest.mark.parametrize("shared, own", [(20, (2, 3)), (36, (4, 5)), (204, (25, 26)), (240, (0, 60))])
def test_fingerprints_of_similar_sets_meet_in_tables(shared, own):
    """Sets of a similarity of 0.8 differ in the bits that their angle tells, and meet with the recall asked for."""
    rng = np.random.default_rng(1)
    tables = simhash.key_tables(0.8, 0.99, 1 << 14)
    met, bits, pairs = 0, 0, 400
    for _ in range(pairs):
        h = rng.integers(0, 1 << 63, shared + sum(own), dtype=np.uint64)
        two = [simhash.fingerprint(x, simhash.WIDE // 64) for x in (h[: shared + own[0]], np.concatenate([h[:shared], h[shared + own[0] :]]))]
        a, b = (np.frombuffer(x, np.uint8)[None, :] for x in two)
        bits += int(np.bitwise_count(a ^ b).sum())
        met += bool((simhash.table_keys(a, tables, 0) == simhash.table_keys(b, tables, 0)).any())
    assert bits / pairs / simhash.WIDE <= simhash.differing(0.8) * 1.01 and met >= 0.975 * pairs


def test_small_sets_meet_by_shingles(spark):
    """All pairs of 5 to 26 shingles, where bits follow no angle, are found: those of 0.8 and more, none below."""
    rows, want = [], set()
    for n in range(4, 22):
        words = [f"s{n}x{i}" for i in range(n + 4)]
        for k in range(1, n // 4 + 2):  # k shingles more
            rows += [(1000 * n + 10 * k, " ".join(f"{w}k{k}" for w in words)), (1000 * n + 10 * k + 1, " ".join(f"{w}k{k}" for w in [*words, *"abcdefgh"[:k]]))]
            if n / (n + k) >= 0.8:
                want.add(1000 * n + 10 * k + 1)
    out = similar_groups(spark.createDataFrame(rows, "doc_id bigint, text string"), ["doc_id"]).collect()
    assert {r["doc_id"] for r in out if not r["first"]} == want


def test_texts_with_many_shingles_of_their_own_are_not_compared(spark, monkeypatch):
    """A crowd around one text, each with more of its own than a similar text may have: no pair is looked at, nor one of the crowd lost that has a copy."""
    rng = np.random.default_rng(4)
    base, rows = [f"b{i}" for i in range(150)], []
    for g in range(200):
        words = list(base)
        for at in range(int(rng.integers(0, 10)), 150, 20):
            words[at] = f"own{g}x{at}"
        rows.append((g, " ".join(words)))
    rows.append((200, rows[7][1] + " more"))
    compared, verified = [], simhash.verified

    def counted(pairs, *rest):
        compared.append(pairs.count())
        return verified(pairs, *rest)

    monkeypatch.setattr(simhash, "verified", counted)
    out = similar_groups(spark.createDataFrame(rows, "doc_id bigint, text string"), ["doc_id"]).collect()
    assert {r["doc_id"] for r in out if not r["first"]} == {200} and sum(compared) <= 5


def test_texts_of_files_are_not_stored_again(spark, tmp_path):
    """Rows are told by file and place, over many files and with repeated rows; what stays on disk are numbers."""
    rows = [(i // 2, f"{' '.join(f'w{i // 2}x{k}' for k in range(60))}") for i in range(400)]
    spark.createDataFrame(rows, "doc_id bigint, text string").repartition(7).write.parquet(f"{tmp_path}/docs")
    docs = spark.read.parquet(f"{tmp_path}/docs")
    scratch = Path(shared_dir(spark)) / "perigee"
    before = set(scratch.iterdir()) if scratch.exists() else set()
    out = similar_groups(docs, ["doc_id", "text"]).collect()
    left = [p for p in scratch.iterdir() if p not in before]
    assert {c for p in left for c in spark.read.parquet(str(p)).columns} == {"_uid", "_bucket", "_bits"}
    assert sorted((r["doc_id"], r["text"]) for r in out) == sorted(rows) and len({r["_uid"] for r in out}) == 400
    assert sorted(r["doc_id"] for r in out if r["first"]) == list(range(200))
    # Rows of a file twice can't be told by their places.
    twice = similar_groups(docs.join(spark.range(2)), ["doc_id"]).collect()
    assert len({r["_uid"] for r in twice}) == 800 and sum(r["first"] for r in twice) == 200
