import math
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from perigee.llm.common import one_task
from perigee.llm.packing import WordTokens, op4_complement_packing, pack, packing_plan, word_tokenizer


@pytest.fixture(scope="module")
def tokenizer():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(word_tokenizer())


def check_layout(rows, capacity):
    places = defaultdict(list)
    for r in rows:
        places[r["sequence_id"]].append((r["offset"], r["length"]))
    for spans in places.values():
        at = 0
        for offset, length in sorted(spans):
            assert offset == at
            at += length
        assert at <= capacity
    return len(places)


def test_query(spark, sf, documents, tokenizer):
    rows = op4_complement_packing(spark, sf).collect()
    got = defaultdict(list)
    for r in rows:
        got[r["doc_id"]].append((r["piece"], r["start"], r["length"], r["ids_crc32"]))
    for doc, text, _ in documents:
        ids = np.array(tokenizer.encode(text or "", add_special_tokens=False).ids + [1], "<u4")
        want = [(k, at, len(ids[at : at + 4096]), zlib.crc32(ids[at : at + 4096].tobytes())) for k, at in enumerate(range(0, len(ids), 4096))]
        assert sorted(got[doc]) == want
    used = check_layout(rows, 4096)
    assert used <= math.ceil(sum(r["length"] for r in rows) / 4096) * 1.01 + 1


@given(st.lists(st.text(alphabet="ab'sSéÉ ́\t\n 　‍Σ1٣😀<|endoftext>", max_size=60), max_size=5))
@settings(max_examples=60, deadline=None)
def test_words_one_by_one_give_the_texts_tokens(texts):
    words = WordTokens.of(word_tokenizer())
    for text in [*texts, "it's <|endoftext|>x naïve ΑΣ ΑΣ. \x1c \x85"]:
        want = words.tokenizer.encode(text, add_special_tokens=False).ids
        assert np.frombuffer(words.encode(text.encode()), "<u4").tolist() == want


@given(st.dictionaries(st.integers(1, 50), st.integers(1, 40), max_size=30))
@settings(max_examples=100, deadline=None)
def test_plan_places_every_piece_once(counts):
    plan = packing_plan(counts, 50)
    used = Counter()
    for lengths, n in plan:
        assert n > 0 and sum(lengths) <= 50
        for x in lengths:
            used[x] += n
    assert used == Counter(counts)
    half_full = sum(n for lengths, n in plan if 2 * sum(lengths) <= 50)
    assert half_full <= 1


def test_odd_rows(odd, nothing):
    rows = pack(odd, ["doc_id", "_text"], word_tokenizer(), capacity=64).collect()
    check_layout(rows, 64)
    empty = [r for r in rows if r["doc_id"] in (1, 2, 3)]
    assert [r["length"] for r in empty] == [1, 1, 1]
    assert len([r for r in rows if r["doc_id"] == 5]) == 2 * len([r for r in rows if r["doc_id"] is None])
    assert pack(nothing, ["doc_id"], word_tokenizer()).collect() == []


def test_tasks_of_other_operators_drop_the_word_cache():
    WordTokens.of(word_tokenizer()).encode(b"some words")
    list(one_task(iter, "packing", iter([])))
    assert WordTokens._shared
    list(one_task(iter, "", iter([])))
    assert not WordTokens._shared
