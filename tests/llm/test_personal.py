import hashlib
import random
import re
import time

import pytest

from perigee.llm import personal
from perigee.llm.personal import KINDS, admitted, base_spans, candidates, expectation_maximisation, find_personal, fit, luhn, op12_personal_data, zones

EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def brute(text):
    """The base patterns as they stand."""
    out = [(0, *m.span()) for m in EMAIL.finditer(text)]
    out += [(1, *m.span()) for m in IP.finditer(text) if all(int(p) <= 255 for p in m.group().split("."))]
    for m in CARD.finditer(text):
        d = re.sub("[^0-9]", "", m.group())
        doubled = [int(c) * (1 + i % 2) for i, c in enumerate(reversed(d))]
        if 16 <= len(d) <= 19 and sum(x // 10 + x % 10 for x in doubled) % 10 == 0:
            out.append((2, *m.span()))
    out += [(3, *m.span()) for m in PHONE.finditer(text) if 8 <= len(re.sub("[^0-9]", "", m.group())) <= 15]
    return sorted(out)


PARTS = [
    "a.b+c@mail.example.com", "@", "x@y", "x@y.", "a@b.cc@d.ee", "%@-.-", "1.2.3.4", "255.255.255.256", "1.2.3.4.5.6.7.8.9", "01.002.3.4", ".", "4111 1111 1111 1111", "4111111111111111",
    "4111-1111 1111 1112", "6304000000000000000", "4111  1111", "+1 (555) 555-1234", "+", "+49 30 1234567 89", "+1", "+12345678901234567", "(", ")", "é", "\U0001f600", " ", " ", "\n", "a", "9", "0", "-", "### ", "word ",
]


def test_base_spans_on_random_text():
    rng = random.Random(5)
    for _ in range(4000):
        text = "".join(rng.choices(PARTS, k=rng.randrange(1, 14)))
        assert base_spans(text, list(zones(text))) == brute(text), text


def test_base_spans_of_documents(documents):
    for _, text, _ in documents:
        if text:
            assert base_spans(text, list(zones(text))) == brute(text)


def test_candidates_overlap_no_base_span():
    rng = random.Random(6)
    for _ in range(2000):
        text = "".join(rng.choices([*PARTS, "bob (at) mail (dot) com", "1[.]2[.]3[.]4", "(136) 555-7479", "4111.1111.1111.1111"], k=rng.randrange(1, 14)))
        found = candidates(text)
        base = [f for f in found if f[4]]
        assert [f[:3] for f in base] == brute(text)
        for f in found:
            assert f[4] or not any(f[1] < e and s < f[2] for _, s, e, *_ in base)


@pytest.mark.parametrize("text", ["a" * 2_000_000, "7" * 2_000_000, "1 " * 1_000_000, "1." * 1_000_000, "+1(" * 500_000, "a@" * 700_000, "1-- " * 500_000, "(at" + "a" * 1_000_000, "0" * 1_000_000 + ".1.1.1"])
def test_time_follows_length(text):
    start = time.time()
    candidates(text)
    assert time.time() - start < 20


def test_reliabilities_of_known_labelers():
    rng = random.Random(2)
    right = [0.95, 0.9, 0.85, 0.7, 0.6, 0.8]
    counts, truth = {}, {}
    for _ in range(20_000):
        y = rng.random() < 0.3
        code = sum((0 if rng.random() < 0.2 else 1 if (rng.random() < r) == y else 2) * 3**i for i, r in enumerate(right))
        counts[code] = counts.get(code, 0) + 1
        truth.setdefault(code, [0, 0])[y] += 1
    labels = expectation_maximisation(counts)
    assert abs(labels.share - 0.3) < 0.03
    for i, r in enumerate(right):
        assert abs(labels.table[i, 1, 1] / 0.8 - r) < 0.04 and abs(labels.table[i, 0, 2] / 0.8 - r) < 0.04


def test_exact_checks():
    assert luhn("4111111111111111") and not luhn("4111111111111112")
    assert admitted(2, "4111.1111.1111.1111") and not admitted(2, "4111.1111.1111.1112")
    assert admitted(0, "bob (at) mail (dot) com") and not admitted(0, "bob@mail")
    assert admitted(1, "1[.]2[.]3[.]4") and not admitted(1, "1[.]2[.]3[.]400")


def with_check(n):
    return next(f"{n}{d}" for d in range(10) if luhn(f"{n}{d}"))


def test_method_adds_spans_and_leaves_others(spark):
    rng = random.Random(9)
    rows = []
    for i in range(400):
        card = with_check("4" + "".join(rng.choices("0123456789", k=14)))
        bad = card[:-1] + str((int(card[-1]) + 1) % 10)
        text = f"some words {card} and {bad} then +1 (555) 555-{i % 10000:04d} with joe{i}@mail.example.com at 10.0.{i % 250}.7 end"
        rows.append((i, text if i % 3 else "only words, version 4, of 2024 and 17 more"))
    rows += [(1000, f"pay by card {with_check('411111111111111')} {with_check('455555555555555')} now"), (1001, "call +1### (136)### 555-7479### now"), (1002, "no. 4111111111111112 here")]
    found = {r["doc_id"]: r["spans"] for r in find_personal(spark.createDataFrame(rows, "doc_id bigint, text string"), ["doc_id"]).collect()}
    assert [(s["kind"], s["start"]) for s in found[1000]] == [("card", 12), ("card", 29)]
    assert [(s["kind"], s["start"], s["base"]) for s in found[1001]] == [("phone", 5, False)]
    assert found[1002] == [] and found[0] == []
    assert all(s["base"] for i in range(400) for s in found[i])


def test_query_has_the_base(spark, sf, documents):
    rows = op12_personal_data(spark, sf).collect()
    texts = {d: t or "" for d, t, _ in documents}
    assert len(rows) == len(documents)
    for r in rows:
        base = brute(texts[r["doc_id"]])
        line = ",".join(f"{KINDS[k]}:{s}:{e}" for k, s, e in base)
        assert r["base_sha256"] == hashlib.sha256(line.encode()).hexdigest()
        assert [r[f"n_{k}"] for k in KINDS] == [sum(b[0] == i for b in base) for i in range(4)]
        assert set(filter(None, line.split(","))) <= set(r["spans"].split(","))


def test_odd_rows(odd, nothing):
    rows = find_personal(odd, ["doc_id", "label"]).collect()
    assert len(rows) == odd.count() and all(r["spans"] == [] for r in rows)
    assert find_personal(nothing, ["doc_id"]).collect() == []
    assert personal.fit(nothing).labels == {}
    assert fit(odd).intercept <= 0
