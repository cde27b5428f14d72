import hashlib
import random
from collections import Counter

import pytest

from perigee.llm.repeats import cut_repeats, op7_recompression


def brute(texts, window=35):
    split = [(t or "").encode().split() for t in texts]
    seen = Counter(tuple(w[i : i + window]) for w in split for i in range(len(w) - window + 1))
    out = []
    for words in split:
        gone = [False] * len(words)
        for i in range(len(words) - window + 1):
            if seen[tuple(words[i : i + window])] > 1:
                gone[i : i + window] = [True] * window
        kept = b" ".join(w for w, g in zip(words, gone) if not g)
        out.append((len(words), sum(gone), hashlib.sha256(kept).hexdigest()))
    return out


def result(df, **kwargs):
    rows = cut_repeats(df, ["doc_id"], **kwargs).collect()
    return sorted(((r["doc_id"] is None, r["doc_id"] or 0, r["n_words"], r["n_removed"], hashlib.sha256(bytes(r["kept"])).hexdigest()) for r in rows))


def test_query(spark, sf, documents):
    got = {r["doc_id"]: (r["n_words"], r["n_removed"], r["kept_sha256"]) for r in op7_recompression(spark, sf).collect()}
    want = brute([t for _, t, _ in documents])
    assert [got[d] for d, _, _ in documents] == want
    assert sum(w[1] for w in want) > 0


@pytest.mark.parametrize("letters", [2, 3, 30])
def test_small_alphabets_and_runs(spark, letters):
    """Periods, runs and repeats at any place: the hardest cases for borders that depend on their surroundings."""
    rng = random.Random(letters)
    alphabet = [f"l{i}" for i in range(letters)]
    passages = [[rng.choice(alphabet) for _ in range(rng.randint(30, 120))] for _ in range(10)]
    texts = []
    for i in range(60):
        words = [rng.choice(alphabet) for _ in range(rng.randint(0, 60))]
        if i % 3 == 0:
            words += rng.choice(passages)[rng.randint(0, 9) :]
        if i % 5 == 0:
            words += ["l0"] * rng.randint(0, 90)
        if i % 7 == 0:
            words += ["l0", "l1"] * rng.randint(0, 50)
        if i % 11 == 0:
            words += ["l0", "l0", "l1", "l1", "l1"] * rng.randint(0, 20)
        texts.append(" ".join(words))
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    assert [r[2:] for r in result(df)] == brute(texts)


def test_long_texts_are_named_in_pieces(spark, monkeypatch):
    from perigee.llm import repeats

    rng = random.Random(1)
    passage = [f"p{i}" for i in range(80)]
    words = [f"w{rng.randint(0, 10**6)}" for _ in range(3000)]
    texts = [" ".join(words[:1500] + passage + words[1500:]), " ".join(words[100:160] + passage)]
    monkeypatch.setattr(repeats, "PIECE", 333)
    found = [row for part in repeats.pieces([t.encode() for t in texts], 35) for row in zip(part[2].tolist(), part[3].tolist())]
    assert len(found) > 9
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    assert [r[2:] for r in result(df)] == brute(texts)


def test_odd_rows(odd, nothing):
    rows = odd.select("doc_id", "text").collect()
    want = sorted((r["doc_id"] is None, r["doc_id"] or 0, *b) for r, b in zip(rows, brute([r["text"] for r in rows])))
    assert result(odd) == want
    assert result(nothing) == []
