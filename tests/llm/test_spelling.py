import re
from collections import Counter
from zlib import crc32

import pytest

from perigee.llm import spelling
from perigee.llm.spelling import Acceptor, near_words, spelling_variants, variants


def one_edit(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(b) - len(a) > 1 or a == b:
        return False
    i = next((k for k in range(len(a)) if a[k] != b[k]), len(a))
    return a[i:] == b[i + 1 :] or (len(a) == len(b) and a[i + 1 :] == b[i + 1 :])


def brute_near(words):
    return {(a, b) for a in words for b in words if one_edit(a, b)}


def brute_variants(counts):
    near = {}
    for a, b in brute_near(counts):
        near.setdefault(a, []).append(b)
    out = {}
    for w, n in counts.items():
        best = min(near.get(w, []), key=lambda v: (-counts[v], v), default=None)
        form = best if best and counts[best] >= 5 * n else None
        out[w] = (n, len(near.get(w, [])), form, counts[form] if form else None)
    roots = {}
    for w in counts:
        at = w
        while out[at][2]:
            at = out[at][2]
        roots[w] = at
    return {w: (*v, roots[w]) for w, v in out.items()}


def brute_counts(rows):
    total = Counter()
    for doc_id, text in rows:
        text = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
        for run in re.findall("[A-Za-zÀ-ÿ]+", text):
            h = crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % 199 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            total[run] += 1
    return {w: n for w, n in total.items() if len(w) >= 6 and n >= 5}


WORDS = ["", "a", "aa", "aaa", "ab", "abc", "aabc", "abd", "b", "bc", "bcd", "xbcd", "abcdef", "abcef", "éa", "éé", "abcdefg", "zbcdefg"]


def test_composition_accepts_each_pair_once():
    pairs = list(Acceptor(sorted(WORDS)).one_edit())
    assert len(pairs) == len({frozenset(p) for p in pairs})
    assert {p for a, b in pairs for p in ((a, b), (b, a))} == brute_near(WORDS)


def test_acceptor_is_minimal():
    # Two first symbols, one shared rest: a start, and one state for each of "est", "st", "t" and the end.
    assert len(Acceptor(["rest", "test"]).ways) == 5
    long = ["x" * 5000 + c for c in "abc"]
    assert len(list(Acceptor(long).one_edit())) == 3


@pytest.mark.parametrize("part", [1, 3, 8192])
def test_near_words_at_every_split(spark, part):
    words = [w for w in WORDS if w] + ["word" + c + d for c in "abcd" for d in ("", "x", "yy")] + ["prefix" * 4 + c for c in "abcde"]
    rows = near_words(spark.createDataFrame([(w, 5) for w in words], "word string, n bigint"), part).collect()
    assert len(rows) == len({(r["word"], r["near"]) for r in rows})
    assert {(r["word"], r["near"]) for r in rows} == brute_near(words)


def test_forms_and_roots(spark):
    counts = {"colours": 1000, "colors": 150, "colorz": 30, "colorzz": 6, "colourz": 200, "abcdef": 5, "abcdeg": 25, "abcdeh": 25}
    rows = variants(spark.createDataFrame(list(counts.items()), "word string, n bigint")).collect()
    assert {r["word"]: (r["n"], r["n_near"], r["form"], r["form_n"], r["root"]) for r in rows} == brute_variants(counts)


@pytest.mark.parametrize("part", [40, 8192])
def test_all_documents(spark, documents, part, monkeypatch):
    monkeypatch.setattr(spelling, "COUNTED", 500)
    monkeypatch.setattr(spelling, "PIECE", 300)
    docs = spark.createDataFrame([(d, t) for d, t, _ in documents], "doc_id bigint, text string")
    words = spelling.word_counts(docs)
    assert {r["word"]: r["n"] for r in words.collect()} == brute_counts([(d, t) for d, t, _ in documents])
    rows = variants(spelling.store(words), part=part).collect()
    want = brute_variants(brute_counts([(d, t) for d, t, _ in documents]))
    assert {r["word"]: (r["n"], r["n_near"], r["form"], r["form_n"], r["root"]) for r in rows} == want and len(rows) == len(want)


def test_odd_rows(spark, odd, nothing):
    rows = {r["word"]: r for r in spelling_variants(odd).collect()}
    assert {w: r["n"] for w, r in rows.items()} == brute_counts([(r["doc_id"], r["text"]) for r in odd.collect()])
    assert spelling_variants(nothing).collect() == []
    long = spark.createDataFrame([(1, "Ab" * 3_000_000 + " ")] * 5 + [(2, "word7 " * 400_000)], "doc_id bigint, text string")
    assert {len(r["word"]) for r in spelling.word_counts(long).collect()} <= {6_000_000, 5_999_999}
