import pytest

from perigee.llm.rules import apply_rules, dup_lines, host_rates, repeated_words, text_stats


def brute_repeated(words, window=8):
    seen = {}
    for i in range(len(words) - window + 1):
        seen.setdefault(tuple(words[i : i + window]), []).append(i)
    return len({j for at in seen.values() if len(at) > 1 for i in at for j in range(i, i + window)})


@pytest.mark.parametrize("text", ["", "a " * 30, "a b " * 20, "a b c d e f g h i " * 3, " ".join(map(str, range(50))), "x " + "a b c d e f g h " * 2, "a b c d e f g h"])
def test_repeated_windows(text):
    words = text.encode().split()
    assert repeated_words(words) == brute_repeated(words)


def test_counts():
    assert text_stats("a é#\n\na é#\n \nb|".encode()) == (5, 8, 3, 1, 0)
    assert dup_lines("x\r\nx\nx") == 1


def test_bad_host_takes_its_documents_and_small_ones_do_not(spark):
    good, bad = " ".join(f"w{i}" for i in range(40)), "too short"
    rows = [(i, bad if i % 10 else good, "bad") for i in range(200)] + [(1000 + i, good, f"h{i % 7}") for i in range(700)]
    rows += [(5000, bad, "tiny"), (5001, good, "tiny"), (5002, good, None), (5003, bad, None)]
    out = {r["doc_id"]: r for r in apply_rules(spark.createDataFrame(rows, "doc_id bigint, text string, source string"), ["doc_id"]).collect()}
    assert len(out) == len(rows)
    assert not any(out[i]["kept"] for i in range(200)) and not out[10]["base_failed"]
    assert all(out[1000 + i]["kept"] for i in range(700))
    assert out[5001]["kept"] and out[5002]["kept"] and not out[5003]["kept"]


def test_rates_shrink(spark):
    rows = [(f"h{i}", i < 5) for i in range(40) for _ in range(20)] + [("one", True)]
    rates = {r["host"]: r["host_rate"] for r in host_rates(spark.createDataFrame(rows, "host string, failed boolean"), "host", "failed").collect()}
    assert rates["h0"] > rates["one"] > 0.126 > rates["h30"] > 0


def test_odd_rows(odd, nothing):
    rows = apply_rules(odd, ["doc_id", "source"]).collect()
    assert len(rows) == odd.count()
    assert all(r["n_words"] == 0 and not r["kept"] for r in rows if r["doc_id"] in (1, 2, 3))
    assert apply_rules(nothing, ["doc_id"]).collect() == []
