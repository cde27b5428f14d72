from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from perigee.llm import mixing
from perigee.llm.common import store
from perigee.llm.mixing import mix, op1_entropy_mix


def brute_targets(sizes, share=1.5, weights=(5, 2, 1), most=2.0):
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    target, free, left = {}, set(order), share * sum(sizes.values())
    while free:
        total = sum(weight[s] for s in free)
        full = {s for s in free if left * weight[s] / total > most * sizes[s]}
        if not full:
            return target | {s: left * weight[s] / total for s in free}
        for s in full:
            target[s] = most * sizes[s]
            left -= target[s]
        free -= full
    return target


def test_targets_and_words_taken(spark, sf, documents):
    rows = op1_entropy_mix(spark, sf).collect()
    source = {d: s for d, _, s in documents}
    sizes, taken, target, largest = defaultdict(int), defaultdict(int), {}, defaultdict(int)
    for r in rows:
        s = source[r["doc_id"]]
        sizes[s] += r["size"]
        taken[s] += r["taken"]
        largest[s] = max(largest[s], r["size"])
        target[s] = r["target"]
        assert r["taken"] <= 2 * r["size"]
        assert r["size"] == 0 or r["taken"] % r["size"] == 0
    want = brute_targets(sizes)
    for s in sizes:
        assert target[s] == pytest.approx(want[s], rel=1e-9)
        assert 0 <= target[s] - taken[s] + 1e-6 <= largest[s]
    assert sum(taken.values()) == pytest.approx(1.5 * sum(sizes.values()), rel=0.05)
    again = {(r["doc_id"], r["taken"]) for r in op1_entropy_mix(spark, sf).collect()}
    assert again == {(r["doc_id"], r["taken"]) for r in rows}


def test_base_rates_tilt_by_one_factor(spark):
    rows = [(i, " ".join(["w"] * 10), "a", 0.5 if i % 2 else 1.5) for i in range(400)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, source string, base double")
    out = mix(df, ["doc_id", "base"], share=1.2, base=F.col("base")).groupBy("base").agg(F.avg("copies").alias("m")).collect()
    mean = {r["base"]: r["m"] for r in out}
    # The limit of two copies binds for the higher base: 2 and 0.4 give 1.2 on average.
    assert mean[1.5] == pytest.approx(1.8, abs=0.15) and mean[0.5] == pytest.approx(0.6, abs=0.15)


def test_odd_rows(odd, nothing):
    rows = mix(odd, ["doc_id", "source"]).collect()
    assert len(rows) == odd.count()
    assert {r["size"] for r in rows if r["doc_id"] in (1, 2, 3)} == {0}
    assert len({(r["doc_id"], r["copies"]) for r in rows if r["doc_id"] == 5}) == 1
    assert mix(nothing, ["doc_id"]).collect() == []


def shortfalls(rows):
    """By source: what is missing of the target, and the smallest document that could still be taken once more."""
    missing, smallest = {}, {}
    for r in rows:
        g = r["source"]
        missing[g] = missing.get(g, r["target"]) - r["copies"] * r["size"]
    for r in rows:
        if 0 < r["size"] and r["copies"] < r["most"]:
            smallest[r["source"]] = min(smallest.get(r["source"], r["size"]), r["size"])
    return missing, smallest


def test_a_long_document_at_the_cut_leaves_no_need_open(spark):
    """Sources of 150 short documents and one as long as all of them: short ones behind the long one fill the target."""
    rows = [(g * 1000 + i, "w " * (4000 if i == 150 else 10 + (7 * i + g) % 31), f"s{g:02}") for g in range(12) for i in range(151)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, source string")
    out = mix(df, ["doc_id", "source"], share=0.5, weights=(1.0,)).withColumn("most", F.lit(1)).collect()
    missing, smallest = shortfalls(out)
    assert all(r["copies"] in (0, 1) for r in out)
    assert {r["source"]: r["target"] for r in out}.keys() == missing.keys()
    for g, left in missing.items():
        assert -1e-6 <= left < smallest[g]


def test_repeated_rows_fill_together_or_not(spark):
    rows = [(i // 2, "w " * (5 + (i // 2) % 40), "a") for i in range(300)] + [(1000, "w " * 3000, "a"), (2000, None, "a")]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, source string")
    out = mix(df, ["doc_id", "source"], share=0.5).collect()
    copies = defaultdict(set)
    for r in out:
        copies[r["doc_id"]].add(r["copies"])
    assert len(out) == len(rows) and all(len(c) == 1 for c in copies.values())
    left = out[0]["target"] - sum(r["size"] * r["copies"] for r in out)
    assert -1e-6 <= left < min(2 * r["size"] for r in out if r["copies"] == 0 and r["size"] and r["doc_id"] != 1000)


def test_total_within_two_hundredths(spark, sf):
    rows = op1_entropy_mix(spark, sf).collect()
    assert sum(r["taken"] for r in rows) == pytest.approx(1.5 * sum(r["size"] for r in rows), rel=0.02)


@pytest.mark.parametrize("small", [0, mixing.SMALL])
def test_tables_by_source_write_no_files(spark, odd, sf, monkeypatch, small):
    """A row per source is not worth files; beyond the limit they are stored, with the same result."""
    monkeypatch.setattr(mixing, "SMALL", small)
    stored = []
    monkeypatch.setattr(mixing, "store", lambda df: stored.append(df) or store(df))
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    copies = {r["doc_id"]: r["copies"] for r in mixing.mix(docs, ["doc_id"]).collect()}
    by_source = [df.columns for df in stored if not {"size", "_size", "key"} & set(df.columns)]
    assert not by_source if small else len(by_source) > 5
    test_tables_by_source_write_no_files.copies = getattr(test_tables_by_source_write_no_files, "copies", copies)
    assert copies == test_tables_by_source_write_no_files.copies
