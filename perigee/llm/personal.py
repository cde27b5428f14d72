"""Personal data in texts: fixed patterns, and further spans from labelers that vote, without labelled examples.

Two passes over the whole texts. The first finds candidates of every kind: what the fixed patterns match, and looser forms
(split by junk, run together with other numbers, spelled out, other separators), along with decoys of the same look. On
each candidate labelers vote for or against, or abstain: patterns of form, gazetteers, and the words around it. Expectation
maximisation over the counts of vote patterns estimates how reliable every labeler is and how likely each pattern is
personal data; a logistic regression on votes, form and context is trained on these probabilities. The second pass finds
the candidates again and adds those that the classifier accepts and an exact check admits to the spans of the patterns.

What the passes exchange is small: at most 3 ** 6 vote patterns a kind, and one weight a feature. No text or span is shuffled.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from dataclasses import dataclass
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from perigee.llm.common import arrow_map, store, table

# Kinds in the order of the results, and the limits of their base patterns.
KINDS = ("email", "ip", "card", "phone")
CARD_DIGITS, PHONE_DIGITS, IP_PART = (16, 19), (8, 15), 255
EMAIL, IP, CARD, PHONE = range(4)

LABELERS = ("pattern", "form", "check", "gazetteer", "context", "border")
FORMS, CONTEXTS = 8, 16
N_VOTES = len(KINDS) * len(LABELERS) * 3
N_FEATURES = N_VOTES + len(KINDS) * (FORMS + CONTEXTS)
EM_ROUNDS, THRESHOLD = 60, 0.5
# Code points before a span that count as its context.
AROUND = 40

# Gazetteers: common last labels of domains, country calling codes, first digits of card issuers, and cue words.
TLDS = frozenset("com org net edu gov mil int info biz io co ai app dev me de fr es it nl be ch at uk eu us ca au jp cn in br mx ru pl se no fi dk pt gr cz ie example test".split())
CALLING = frozenset(
    "1 7 20 27 30 31 32 33 34 36 39 40 41 43 44 45 46 47 48 49 51 52 53 54 55 56 57 58 60 61 62 63 64 65 66 81 82 84 86 90 91 92 93 94 95 98 "
    "212 213 216 218 234 254 351 352 353 354 355 356 357 358 359 370 371 372 380 385 386 420 421 852 886 966 971 972".split()
)
ISSUERS = re.compile(r"4|5[1-5]|2[2-7]|3[47]|6011|65|35|3[068]")
CUES = (
    re.compile(r"mail|contact|write|kontakt|correo|courriel|adresse", re.I), re.compile(r"\bip\b|host|server|address|adresse|client|login", re.I),
    re.compile(r"card|visa|master|amex|credit|karte|carte|tarjeta|pay", re.I), re.compile(r"phone|tel|call|fax|mobil|cell|ruf|sms|whats", re.I),
)
AGAINST = re.compile(r"token|version|\bv\d*$|sha\d*|md5|isbn|issn|doi|serial|order|invoice|license|licence|hash|uuid|[=#_/\\]\s*\"?$", re.I)

GAP = r"[ !-*,-/:-@\[-`{-~]"  # ASCII punctuation and space without the plus sign
ZONE = re.compile(rf"[0-9](?:{GAP}{{0,7}}[0-9])*+")
IP_CHAIN = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3,}+")
CARD_RUN = re.compile(r"[0-9](?:[ -]?[0-9]){15,}+")
PHONE_RUN = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
# Looser forms, by kind: (number of the form, pattern).
LOOSE_DIGITS = (
    (CARD, 1, re.compile(r"(?<![0-9])[0-9]{4}([ -]?)[0-9]{4}\1[0-9]{4}\1[0-9]{4}(?![0-9])")),
    (CARD, 2, re.compile(rf"(?<![0-9])[0-9]{{4}}(?:{GAP}{{1,6}}[0-9]{{4}}){{3}}(?![0-9])")),
    (CARD, 3, re.compile(r"(?<![0-9])3[47][0-9]{2}[ -]?[0-9]{6}[ -]?[0-9]{5}(?![0-9])")),
    (IP, 1, re.compile(r"(?<![0-9.])[0-9]{1,3}(?: ?(?:\[\.\]|\(\.\)|\{\.\}) ?[0-9]{1,3}){3}(?![0-9])")),
    (IP, 2, re.compile(r"(?<![0-9.])[0-9]{1,5}(?:\.[0-9]{1,5}){3}(?![0-9])")),
    (PHONE, 2, re.compile(r"(?<![0-9A-Za-z+])\([0-9]{3}\) ?[0-9]{3}[-. ][0-9]{4}(?![0-9])")),
    (PHONE, 3, re.compile(r"(?<![0-9A-Za-z+.-])0[0-9]{1,4}[ /-][0-9]{3,4}[ -]?[0-9]{3,5}(?![0-9.])")),
)
PHONE_SPLIT = re.compile(rf"\+[0-9]{{1,3}}{GAP}{{0,6}}[0-9]{{2,4}}{GAP}{{0,6}}[0-9]{{3,4}}{GAP}{{0,6}}[0-9]{{3,4}}(?![0-9])")
HIDDEN_HINTS = ("(at", "[at", "{at", "( at", "[ at", "{ at", "＠", " @", "@ ")
HIDDEN = re.compile(
    r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]{1,64}(?:\s?[\[({]\s?at\s?[\])}]\s?|＠|\s@\s?|@\s)[A-Za-z0-9-]{1,63}"
    r"(?:(?:\s?[\[({]\s?(?:dot|\.)\s?[\])}]\s?|\sdot\s|\.)[A-Za-z0-9-]{1,63}){1,5}", re.I,
)
BARE = re.compile(r"(?<![A-Za-z0-9._%+@-])[A-Za-z0-9._%+-]{1,64}@[A-Za-z0-9-]{1,63}(?![A-Za-z0-9@-]|\.[A-Za-z0-9-])")

Found = tuple[int, int, int, int, bool]  # kind, start, end, form, whether the base pattern holds


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        n = int(d) << (i & 1)
        total += n - 9 if n > 9 else n
    return total % 10 == 0


def digits_of(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def base_emails(text: str) -> Iterator[tuple[int, int]]:
    """Leftmost matches of the base pattern, found from each @ outwards, so that long runs cost no more than their length."""
    free = 0
    at = text.find("@")
    while at >= 0:
        start = at
        while start > free and text[start - 1] in LOCAL:
            start -= 1
        domain = DOMAIN.match(text, at + 1) if start < at else None
        if domain:
            yield start, domain.end()
        free = domain.end() if domain else at + 1
        at = text.find("@", free)


def zones(text: str) -> Iterator[tuple[int, int]]:
    for m in ZONE.finditer(text):
        if m.end() - m.start() > 6:
            yield m.start(), m.end()


def base_spans(text: str, numbers: list[tuple[int, int]]) -> list[tuple[int, int, int]]:
    """``(kind, start, end)`` of the base patterns; matches that fail their limits are dropped."""
    found = [(EMAIL, s, e) for s, e in base_emails(text)]
    for low, high in numbers:
        for m in IP_CHAIN.finditer(text, low, high):
            parts, at = m.group().split("."), m.start()
            for i in range(0, len(parts) - 3, 4):
                size = sum(map(len, parts[i : i + 4])) + 3
                if all(len(p := q.lstrip("0")) < 4 and int(p or 0) <= IP_PART for q in parts[i : i + 4]):
                    found.append((IP, at, at + size))
                at += size + 1
        for m in CARD_RUN.finditer(text, low, high):
            digits = digits_of(m.group()) if m.end() - m.start() < 2 * CARD_DIGITS[1] else ""
            if CARD_DIGITS[0] <= len(digits) <= CARD_DIGITS[1] and luhn(digits):
                found.append((CARD, m.start(), m.end()))
    for m in PHONE_RUN.finditer(text):
        if PHONE_DIGITS[0] <= sum("0" <= c <= "9" for c in m.group()) <= PHONE_DIGITS[1]:
            found.append((PHONE, m.start(), m.end()))
    return sorted(found)


def candidates(text: str) -> list[Found]:
    """Spans of the base patterns, and looser ones that overlap none of them nor an earlier one of their kind."""
    numbers = list(zones(text))
    base = base_spans(text, numbers)
    loose: list[Found] = []
    for low, high in numbers:
        for kind, form, pattern in LOOSE_DIGITS:
            # One more code point on both sides, as a bracket may open or close a number.
            loose.extend((kind, m.start(), m.end(), form, False) for m in pattern.finditer(text, max(low - 1, 0), high + 1))
    if "+" in text:
        loose.extend((PHONE, m.start(), m.end(), 1, False) for m in PHONE_SPLIT.finditer(text))
    if "@" in text:
        loose.extend((EMAIL, m.start(), m.end(), 2, False) for m in BARE.finditer(text))
    folded = text.lower()
    if any(h in folded for h in HIDDEN_HINTS):
        loose.extend((EMAIL, m.start(), m.end(), 1, False) for m in HIDDEN.finditer(text))
    if not loose:
        return [(k, s, e, 0, True) for k, s, e in base]
    taken = sorted((s, e) for _, s, e in base)
    free: list[Found] = []
    last = dict.fromkeys(range(len(KINDS)), 0)
    ends = np.maximum.accumulate([e for _, e in taken]) if taken else np.empty(0, int)
    starts = [s for s, _ in taken]
    for kind, start, end, form, _ in sorted(loose, key=lambda f: (f[1], f[3], f[0])):
        at = int(np.searchsorted(starts, end))  # base spans that begin before this one ends
        if (at and ends[at - 1] > start) or start < last[kind]:
            continue
        free.append((kind, start, end, form, False))
        last[kind] = end
    return sorted([(k, s, e, 0, True) for k, s, e in base] + free)


def admitted(kind: int, span: str) -> bool:
    """The exact check of an added span."""
    digits = digits_of(span)
    if kind == CARD:
        return 13 <= len(digits) <= CARD_DIGITS[1] and luhn(digits)
    if kind == IP:
        parts = re.findall("[0-9]+", span)
        return len(parts) == 4 and all(len(p) < 4 and int(p) <= IP_PART for p in parts)
    if kind == PHONE:
        return PHONE_DIGITS[0] <= len(digits) <= PHONE_DIGITS[1]
    last = re.split(r"[^A-Za-z0-9-]+", span.strip())[-1]
    return len(re.findall(r"[A-Za-z0-9-]+", span)) >= 3 and last.isalpha() and len(last) >= 2


def votes(text: str, found: Found) -> tuple[int, ...]:
    """Votes of the labelers in their order: 1 for personal data, 2 against it, 0 for neither."""
    kind, start, end, form, base = found
    span, before = text[start:end], text[max(0, start - AROUND) : start]
    digits = digits_of(span)
    if kind == EMAIL:
        listed = re.split(r"[^A-Za-z0-9-]+", span)[-1].lower() in TLDS
        gazetteer, shape = (1 if listed else 2), (1 if form < 2 else 2)
    elif kind == IP:
        first = int((re.match("[0-9]{1,9}", span) or [0])[0])
        gazetteer, shape = (2 if first in (0, 255) else 1 if first < 224 else 0), (1 if form < 2 else 2)
    elif kind == CARD:
        gazetteer, shape = (1 if ISSUERS.match(digits) else 2), (1 if len(digits) in (15, 16) else 0)
    else:
        known = any(digits[:n] in CALLING for n in (1, 2, 3))
        gazetteer, shape = (1 if known else 2) if "+" in span else 0, (1 if len(digits) in (10, 11, 12, 13) else 2)
    tail, head = text[end : end + 1], before[-1:]
    return (
        1 if base else 0, shape, 1 if admitted(kind, span) else 2, gazetteer,
        1 if CUES[kind].search(before) else 2 if AGAINST.search(before) else 0,
        2 if head.isalnum() or tail.isalnum() else 1,
    )


def features(text: str, found: Found, given: tuple[int, ...]) -> list[int]:
    """Features that are on: a vote of each labeler, the form, and the word before."""
    kind, start, _, form, _ = found
    words = text[max(0, start - AROUND) : start].split()
    word = re.sub(r"[^a-z0-9]+", "", words[-1].lower()) if words else ""
    return [
        *[(kind * len(LABELERS) + i) * 3 + v for i, v in enumerate(given)],
        N_VOTES + kind * FORMS + form, N_VOTES + len(KINDS) * FORMS + kind * CONTEXTS + crc32(word.encode()) % CONTEXTS,
    ]


def code(given: tuple[int, ...]) -> int:
    return sum(v * 3**i for i, v in enumerate(given))


@dataclass
class Labels:
    """What expectation maximisation found for one kind: share of personal data, and P(vote | class) by labeler."""

    share: float
    table: np.ndarray  # labeler, class, vote

    def posterior(self, patterns: np.ndarray) -> np.ndarray:
        logs = np.log(self.table)
        both = np.stack([math.log(1 - self.share) * np.ones(len(patterns)), math.log(self.share) * np.ones(len(patterns))], axis=1)
        for i in range(len(LABELERS)):
            both += logs[i][:, patterns[:, i]].T
        return 1 / (1 + np.exp(np.clip(both[:, 0] - both[:, 1], -500, 500)))


def expectation_maximisation(counts: dict[int, int]) -> Labels:
    """Reliabilities of the labelers from counts of vote patterns. Starts from the balance of votes; every vote has a prior
    that labelers are right more often than not, which also settles which class is personal data."""
    patterns = np.array([[c // 3**i % 3 for i in range(len(LABELERS))] for c in counts]).reshape(-1, len(LABELERS))
    n = np.array(list(counts.values()), float)
    q = 1 / (1 + np.exp(-((patterns == 1).sum(axis=1) - (patterns == 2).sum(axis=1)).astype(float)))
    prior = np.array([[2.0, 1.0, 3.0], [2.0, 3.0, 1.0]])
    labels = Labels(0.5, np.tile(prior / prior.sum(axis=1, keepdims=True), (len(LABELERS), 1, 1)))
    for _ in range(EM_ROUNDS):
        weights = np.stack([n * (1 - q), n * q])
        share = float((weights[1].sum() + 1) / (n.sum() + 2))
        rates = np.stack([
            np.stack([np.bincount(patterns[:, i], weights=w, minlength=3) for w in weights]) + prior for i in range(len(LABELERS))
        ])
        labels = Labels(share, rates / rates.sum(axis=2, keepdims=True))
        q = labels.posterior(patterns)
    return labels


@dataclass
class SpanModel:
    labels: dict[int, Labels]
    weights: np.ndarray
    intercept: float

    def probability(self, on: list[int]) -> float:
        z = self.intercept + float(self.weights[on].sum())
        return 1 / (1 + math.exp(-max(-500.0, min(500.0, z))))


def texts_of(docs: DataFrame, keep: list[str], text: str) -> DataFrame:
    return docs.select(*[F.col(f"`{c}`").alias(f"_k{i}") for i, c in enumerate(keep)], F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("_text"))


def fit(docs: DataFrame, text: str = "text") -> SpanModel:
    """Reliabilities and span classifier, from the candidates of all texts."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            kinds, codes, ons = [], [], []
            for t in b.column(0):
                t = t.as_py()
                for found in candidates(t):
                    given = votes(t, found)
                    kinds.append(found[0]), codes.append(code(given)), ons.append(features(t, found, given))
            yield pa.RecordBatch.from_arrays(
                [pa.array(kinds, pa.int32()), pa.array(codes, pa.int32()), pa.array(ons, pa.list_(pa.int32()))], names=["kind", "votes", "on"]
            )

    spark = docs.sparkSession
    # Equal candidates are one row with their number, so this table follows the variety of contexts and not the texts.
    seen = store(arrow_map(texts_of(docs, [], text), run, "kind int, votes int, on array<int>").groupBy("kind", "votes", "on").count())
    counts: dict[int, dict[int, int]] = {}
    for r in seen.groupBy("kind", "votes").agg(F.sum("count").alias("n")).orderBy("kind", "votes").collect():
        counts.setdefault(r["kind"], {})[r["votes"]] = r["n"]
    labels = {k: expectation_maximisation(c) for k, c in counts.items()}
    rows = [
        (k, c, float(q)) for k, known in counts.items()
        for c, q in zip(known, labels[k].posterior(np.array([[c // 3**i % 3 for i in range(len(LABELERS))] for c in known])))
    ]
    if not rows:
        return SpanModel({}, np.zeros(N_FEATURES), -1.0)
    truth = F.broadcast(spark.createDataFrame(rows, "kind int, votes int, q double"))  # at most 3 ** 6 rows a kind
    wide = F.transform(F.sequence(F.lit(0), F.lit(N_FEATURES - 1)), lambda i: F.array_contains("on", i).cast("double"))
    both = seen.join(truth, ["kind", "votes"]).select(
        array_to_vector(wide).alias("features"),
        F.explode(F.array(F.struct(F.lit(1.0).alias("label"), (F.col("count") * F.col("q")).alias("w")),
                          F.struct(F.lit(0.0).alias("label"), (F.col("count") * (1 - F.col("q"))).alias("w")))).alias("r"),
    ).select("features", "r.label", "r.w").filter("w > 0")
    model = LogisticRegression(weightCol="w", regParam=1e-3, maxIter=60, standardization=False).fit(both)
    return SpanModel(labels, np.asarray(model.coefficients.toArray()), float(model.intercept))


def find_personal(docs: DataFrame, keep: list[str], text: str = "text", model: SpanModel | None = None) -> DataFrame:
    """``keep`` and ``spans``: for every row the personal data of its whole text, by kind and start, in code points, end exclusive.

    Each span says whether the base pattern found it; added ones carry the classifier's probability, base ones 1. A null
    or empty text has none, repeated rows have the same ones, an empty table gives no rows. Texts are searched whole, in
    time in proportion to their length. Other columns are not read, whatever their names; ``keep`` must not hold ``spans``.
    """
    model = model or fit(docs, text)
    kind_of = pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("base", pa.bool_()), ("probability", pa.float64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = []
            for t in b.column(b.num_columns - 1):
                t = t.as_py()
                spans = []
                for found in candidates(t):
                    kind, start, end, _, base = found
                    p = 1.0 if base else model.probability(features(t, found, votes(t, found)))
                    if base or (p >= THRESHOLD and admitted(kind, t[start:end])):
                        spans.append({"kind": KINDS[kind], "start": start, "end": end, "base": base, "probability": p})
                rows.append(spans)
            columns = [*(b.column(i) for i in range(len(keep))), pa.array(rows, pa.list_(kind_of))]
            yield pa.RecordBatch.from_arrays(columns, names=[*(f"_k{i}" for i in range(len(keep))), "spans"])

    chosen = texts_of(docs, keep, text)
    fields = ", ".join([
        *(f"`{f.name}` {f.dataType.simpleString()}" for f in chosen.schema.fields[:-1]),
        "spans array<struct<kind: string, start: bigint, end: bigint, base: boolean, probability: double>>",
    ])
    return arrow_map(chosen, run, fields).select(*[F.col(f"_k{i}").alias(c) for i, c in enumerate(keep)], "spans")


def written(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def op12_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = find_personal(table(spark, sf_dir, "documents"), ["doc_id"])
    base = F.filter("spans", lambda s: s["base"])

    def count(kind: str) -> Column:
        return F.size(F.filter(base, lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    counts = [count(k) for k in KINDS]
    return found.select("doc_id", *counts, F.sha2(written(base), 256).alias("base_sha256"), written(F.col("spans")).alias("spans"))


QUERIES = {"op12_personal_data": op12_personal_data}
