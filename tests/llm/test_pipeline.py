from collections import Counter, defaultdict

import pytest

import corpus_pipeline
from perigee.llm.rules import text_stats

COLUMNS = corpus_pipeline.COLUMNS


def test_stages_in_order():
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality_rules", "near_duplicates", "repeated_passages", "source_mix", "packed_sequences"]


def test_every_stage_on_what_the_last_one_kept(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    first = {r["doc_id"]: r["text"] for r in docs.collect()}
    kept = corpus_pipeline.quality_rules(spark, docs, sf)
    ok = set()
    for doc, text in first.items():
        n, _, _, _, repeat = text_stats((text or "").encode())
        if n >= 20 and 100 * repeat <= 30 * n:
            ok.add(doc)
    assert kept.columns == COLUMNS and {r["doc_id"] for r in kept.collect()} == ok

    def shingles(doc):
        w = first[doc].encode().lower().split()
        return {tuple(w[i : i + 5]) for i in range(len(w) - 4)}

    alone = corpus_pipeline.near_duplicates(spark, kept, sf)
    left = {r["doc_id"] for r in alone.collect()}
    by_shingle = defaultdict(list)
    sets = {d: shingles(d) for d in ok}
    for d, s in sets.items():
        for x in s:
            by_shingle[x].append(d)
    shared = Counter((a, b) for at in by_shingle.values() for a in at for b in at if a < b)
    similar = {p: n / len(sets[p[0]] | sets[p[1]]) for p, n in shared.items()}
    close = [p for p, j in similar.items() if j >= 0.8]
    assert close and not any(a in left and b in left for a, b in close)
    # Exactly one row of every chain of similar texts stays: its smallest doc_id.
    root = {d: d for d in ok}

    def find(d):
        while root[d] != d:
            d = root[d]
        return d

    for a, b in close:
        a, b = sorted((find(a), find(b)))
        root[b] = a
    assert left == {d for d in ok if root[d] == d}

    cut = corpus_pipeline.repeated_passages(spark, alone, sf)
    assert cut.columns == COLUMNS
    texts = {r["doc_id"]: r for r in cut.collect()}
    words = {r["doc_id"]: (r["text"], r["text"].split()) for r in alone.collect()}
    windows = Counter(tuple(w[i : i + 35]) for _, w in words.values() for i in range(len(w) - 34))
    for doc, (text, w) in words.items():
        gone = {j for i in range(len(w) - 34) if windows[tuple(w[i : i + 35])] > 1 for j in range(i, i + 35)}
        assert texts[doc]["text"] == (" ".join(x for j, x in enumerate(w) if j not in gone) if gone else text)
    assert set(texts) == left and all(r["n_chars"] == len(r["text"]) for r in texts.values())

    mixed = corpus_pipeline.source_mix(spark, cut, sf)
    copies = Counter(r["doc_id"] for r in mixed.collect())
    assert mixed.columns == COLUMNS and max(copies.values()) <= 2
    size = {d: len(r["text"].encode().split()) for d, r in texts.items()}
    assert sum(size[d] * n for d, n in copies.items()) == pytest.approx(1.5 * sum(size.values()), rel=0.05)

    pieces = corpus_pipeline.packed_sequences(spark, mixed, sf).collect()
    assert Counter(r["doc_id"] for r in pieces if r["piece"] == 0) == copies


def test_odd_rows(spark, odd, nothing, sf):
    for docs in (odd, nothing):
        for name, stage in corpus_pipeline.STAGES:
            docs = stage(spark, docs, sf)
            if name != "packed_sequences":
                assert docs.columns == COLUMNS
        docs.collect()
    alone = corpus_pipeline.near_duplicates(spark, odd, sf)
    assert sorted(r["doc_id"] for r in alone.collect()) == [1, 4, 5, 7, 8, 10]
