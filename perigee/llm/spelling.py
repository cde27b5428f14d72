"""Spelling variants: words of a vocabulary that one edit turns into each other, found by composing automata.

The composition of the vocabulary's acceptor, a transducer of exactly one edit and the acceptor again has states
(state of the first word, edit done or not, state of the second). Before the edit both words are at the same state, so the
composition falls apart by the prefix read so far, and every prefix is an initial state from which a task can go on:

* prefixes shared by more than ``PART`` words are not entered by a task. The edits that happen right at such a prefix
  are equi-joins, as both words go on with the same rest after the edit;
* every other word belongs to its shortest prefix shared by at most ``PART`` words. A task builds the minimised acceptor
  of the words of such a prefix, composes it lazily and enumerates the accepted pairs.

An edit counts at the first place where two words differ, so every pair is accepted once.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from zlib import crc32

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from perigee.llm.common import arrow_map, batch, store, table
from perigee.session import broadcast_if_small

# The letters of a word, and one of how many of a text's words loses a letter.
LETTERS = r"A-Za-zÀ-ÿ"
DROP_ONE_OF = 199
# Code points and occurrences of a word, and how many times as frequent a form is.
MIN_LENGTH, MIN_COUNT, RATIO = 6, 5, 5
# Most words that one task composes; code points of text taken at once; distinct words counted and pairs held before they are passed on.
PART, PIECE, COUNTED, PAIRS = 8192, 1 << 20, 200_000, 1 << 15
# Lengths of prefixes that are counted in one round.
STEP = 8


def pieces(text: str, size: int) -> Iterator[str]:
    """The text in pieces of about ``size`` that don't part a run of letters."""
    gap = re.compile(f"[^{LETTERS}]")
    at = 0
    while len(text) - at > size:
        cut = gap.search(text, at + size)
        if cut is None:
            break
        yield text[at : cut.start()]
        at = cut.start()
    yield text[at:]


def misspelt(word: str, doc_id: str) -> str:
    """The word, without one letter where the checksum of text and word says so."""
    h = crc32(f"{doc_id}:{word}".encode())
    return word if h % DROP_ONE_OF else word[: h % len(word)] + word[h % len(word) + 1 :]


def word_counts(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", min_length: int = MIN_LENGTH, min_count: int = MIN_COUNT) -> DataFrame:
    """``(word, n)``: the letter runs of all texts, A-Z in lower case, some of them misspelt, with their occurrences.

    A null or empty text has no words, a null identifier is written as an empty string, and repeated rows count again.
    Long texts are taken in pieces, and counts are passed on before they outgrow a task.
    """
    lower = {c: c + 32 for c in range(65, 91)}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        find = re.compile(f"[{LETTERS}]+").findall
        total: Counter[str] = Counter()

        def flush() -> pa.RecordBatch:
            out = batch(word=pa.array(list(total), pa.string()), n=pa.array(list(total.values()), pa.int64()))
            total.clear()
            return out

        for b in batches:
            for ident, raw in zip(b.column(0), b.column(1)):
                own, raw = ident.as_py(), raw.as_py()
                for piece in pieces(raw, PIECE):
                    prefix = crc32(f"{own}:".encode())
                    for word, n in Counter(find(piece.translate(lower))).items():
                        if len(word) < min_length:
                            continue
                        if not crc32(word.encode(), prefix) % DROP_ONE_OF:
                            word = misspelt(word, own)
                            if len(word) < min_length:
                                continue
                        total[word] += n
                    if len(total) > COUNTED:
                        yield flush()
        if total:
            yield flush()

    chosen = docs.select(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).alias("_id"), F.col(text).alias("_text")).filter("_text is not null")
    return arrow_map(chosen, run, "word string, n bigint").groupBy("word").agg(F.sum("n").alias("n")).filter(F.col("n") >= min_count)


class Acceptor:
    """Minimal deterministic acceptor of words given in order: equal rests share one state. State 0 has no way on but ends a word."""

    def __init__(self, words: list[str]):
        self.ways: list[dict[str, int]] = []
        self.ends: list[bool] = []
        known: dict[tuple, int] = {}

        def settle(ends: bool, ways: dict[str, int]) -> int:
            name = (ends, tuple(ways.items()))
            if name not in known:
                known[name] = len(self.ways)
                self.ways.append(ways)
                self.ends.append(ends)
            return known[name]

        open_states: list[tuple[bool, dict[str, int]]] = [(False, {})]
        last = ""

        def settle_below(depth: int) -> None:
            while len(open_states) > depth + 1:
                state = settle(*open_states.pop())
                open_states[-1][1][last[len(open_states) - 1]] = state

        for word in words:
            shared = 0
            while shared < min(len(word), len(last)) and word[shared] == last[shared]:
                shared += 1
            settle_below(shared)
            if not word:
                open_states[0] = (True, open_states[0][1])
            open_states.extend((i == len(word) - 1, {}) for i in range(shared, len(word)))
            last = word
        settle_below(0)
        self.start = settle(*open_states[0])

    def meet(self, one: int, two: int, memo: dict[tuple[int, int], tuple | None]) -> tuple | None:
        """The trimmed state (one, edit done, two) of the composition: whether both end, and the symbols both can go on with; None if no rest is common."""
        todo = [(one, two)]
        while todo:
            pair = todo[-1]
            if pair in memo:
                todo.pop()
                continue
            a, b = self.ways[pair[0]], self.ways[pair[1]]
            both = [(c, (s, b[c])) for c, s in a.items() if c in b]
            open_pairs = [p for _, p in both if p not in memo]
            if open_pairs:
                todo.extend(open_pairs)
                continue
            ways = [(c, p) for c, p in both if memo[p] is not None]
            ends = self.ends[pair[0]] and self.ends[pair[1]]
            memo[pair] = (ends, ways) if ends or ways else None
            todo.pop()
        return memo[(one, two)]

    def rests(self, pair: tuple[int, int], memo: dict, but: str | None = None) -> Iterator[str]:
        """The common rests of two states, without those that begin with ``but``."""
        todo = [("", pair)]
        while todo:
            read, at = todo.pop()
            ends, ways = memo[at]
            if ends:
                yield read
            todo.extend((read + c, p) for c, p in ways if read or c != but)

    def one_edit(self) -> Iterator[tuple[str, str]]:
        """Pairs of accepted words at exactly one edit, each once; the longer word first."""
        memo: dict[tuple[int, int], tuple | None] = {}
        todo = [("", self.start)]
        while todo:
            read, state = todo.pop()
            ways = list(self.ways[state].items())
            for i, (c, there) in enumerate(ways):
                todo.append((read + c, there))
                for d, other in ways[:i]:
                    if self.meet(there, other, memo) is not None:
                        for rest in self.rests((there, other), memo):
                            yield read + c + rest, read + d + rest
                if self.meet(there, state, memo) is not None:
                    for rest in self.rests((there, state), memo, but=c):
                        yield read + c + rest, read + rest


def compose(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted rows (part, depth, word, n) to ``(word, near, near_n)``; parts end where the prefix changes."""
    out: tuple[list, list, list] = ([], [], [])

    def flush() -> pa.RecordBatch:
        b = batch(word=pa.array(out[0], pa.string()), near=pa.array(out[1], pa.string()), near_n=pa.array(out[2], pa.int64()))
        for c in out:
            c.clear()
        return b

    def pairs(part: str, counts: dict[str, int]) -> Iterator[pa.RecordBatch]:
        cut = len(part)
        for a, b in Acceptor([w[cut:] for w in counts]).one_edit():
            one, two = part + a, part + b
            out[0].extend((one, two)), out[1].extend((two, one)), out[2].extend((counts[two], counts[one]))
            if len(out[0]) >= PAIRS:
                yield flush()

    now, counts = None, {}
    for b in batches:
        for part, depth, word, n in zip(*[c.to_pylist() for c in b.columns]):
            if (part, depth) != now:
                if len(counts) > 1:
                    yield from pairs(now[0], counts)
                now, counts = (part, depth), {}
            counts[word] = n
    if len(counts) > 1:
        yield from pairs(now[0], counts)
    if out[0]:
        yield flush()


def crossings(words: DataFrame, part: int) -> DataFrame:
    """``(word, n, at)`` for every prefix of a word, of ``at`` symbols, that more than ``part`` words share.

    Only words whose prefixes are all shared so far go on to longer ones, so a long word costs no more than a short one.
    """
    found: DataFrame | None = None
    pending, base = words, 0
    while True:
        lengths = F.sequence(F.lit(base), F.least(F.length("word"), F.lit(base + STEP - 1)))
        prefixes = pending.filter(F.length("word") >= base).select("word", "n", F.explode(lengths).alias("at"))
        prefixes = prefixes.withColumn("prefix", F.substring(F.col("word"), F.lit(1), F.col("at")))
        heavy = store(prefixes.groupBy("prefix").count().filter(F.col("count") > part).select("prefix"))
        met = store(prefixes.join(broadcast_if_small(heavy), "prefix").select("word", "n", "at"))
        found = met if found is None else found.unionByName(met)
        pending, base = met.filter(F.col("at") == base + STEP - 1).select("word", "n"), base + STEP
        if pending.isEmpty():
            return found


def near_words(words: DataFrame, part: int = PART) -> DataFrame:
    """``(word, near, near_n)``: for distinct ``(word, n)``, all ordered pairs at one inserted, deleted or replaced code point."""
    length = F.length("word")
    crossed = crossings(words, part)

    # The edit happens at a heavy prefix: one word loses its next symbol, the other one too, or goes on as it is.
    symbol = F.substring(F.col("word"), F.col("at") + 1, F.lit(1))
    cut = crossed.filter(F.length("word") > F.col("at")).select(
        "at", F.concat(F.substring(F.col("word"), F.lit(1), F.col("at")), F.substring(F.col("word"), F.col("at") + 2, length)).alias("rest"),
        "word", "n", symbol.alias("symbol"),
    )
    whole = crossed.select("at", F.col("word").alias("rest"), F.col("word").alias("near"), F.col("n").alias("near_n"), symbol.alias("next"))
    others = cut.select("at", "rest", F.col("word").alias("near"), F.col("n").alias("near_n"))
    replaced = cut.join(others, ["at", "rest"]).filter("word != near").select("word", "near", "near_n")
    shorter = cut.join(whole, ["at", "rest"]).filter("symbol != next")
    shorter = shorter.select("word", "near", "near_n").unionByName(
        shorter.select(F.col("near").alias("word"), F.col("word").alias("near"), F.col("n").alias("near_n"))
    )

    depth = crossed.groupBy("word").agg((F.max("at") + 1).alias("depth"))
    placed = words.join(depth, "word", "left").withColumn("depth", F.coalesce("depth", F.lit(0)))
    placed = placed.select(F.substring(F.col("word"), F.lit(1), F.col("depth")).alias("part"), "depth", "word", "n")
    inside = arrow_map(
        placed.repartition("part", "depth").sortWithinPartitions("part", "depth", "word"), compose, "word string, near string, near_n bigint"
    )
    return inside.unionByName(replaced).unionByName(shorter)


def follow(links: DataFrame) -> DataFrame:
    """``(word, root)`` for ``(word, form)``, forms followed to the last. Each round doubles the steps, so rounds are few: forms grow in frequency."""
    now = store(links.select("word", F.col("form").alias("root")))
    while True:
        ahead = now.select(F.col("word").alias("root"), F.col("root").alias("ahead"))
        further = now.join(ahead, "root", "left")
        following = store(further.select("word", F.coalesce("ahead", "root").alias("root"), F.col("ahead").isNotNull().alias("moved")))
        now = following.select("word", "root")
        if following.filter("moved").isEmpty():
            return now


def variants(words: DataFrame, ratio: int = RATIO, part: int = PART) -> DataFrame:
    """Words of ``(word, n)`` with ``n_near``, their ``form`` (the most frequent near word that is ``ratio`` times as frequent, the
    first in code-point order of equals), its ``form_n``, and ``root``, the end of the chain of forms. Words must be distinct."""
    near = near_words(words, part).groupBy("word").agg(
        F.count("*").alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("less"), "near")).alias("best")
    )
    joined = words.join(near, "word", "left").withColumn("best_n", -F.col("best.less"))
    is_form: Column = F.col("best_n") >= ratio * F.col("n")
    found = store(joined.select(
        "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(is_form, F.col("best.near")).alias("form"), F.when(is_form, F.col("best_n")).alias("form_n"),
    ))
    roots = follow(found.filter("form is not null"))
    return found.join(roots, "word", "left").select("word", "n", "n_near", "form", "form_n", F.coalesce("root", "word").alias("root"))


def spelling_variants(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Words of all texts with their forms. Empty tables give no words; other columns are not read, whatever their names."""
    return variants(store(word_counts(docs, doc_id, text)))


def op11_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling_variants(table(spark, sf_dir, "documents"))


QUERIES = {"op11_spelling": op11_spelling}
ORACLES = {
    "op11_spelling": """
with recursive tab as (
  select list(v order by i) as t from (
    select i, list_reduce([i]::bigint[] || [0, 0, 0, 0, 0, 0, 0, 0]::bigint[],
      lambda c, z: case when c & 1 = 1 then xor(c >> 1, 3988292384) else c >> 1 end) as v
    from range(256) r(i))
),
runs as (
  select coalesce(doc_id::varchar, '') as id,
    unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[A-Za-zÀ-ÿ]+')) as run
  from documents where text is not null
),
counted as (select id, run, count(*) as k from runs where length(run) >= 6 group by id, run),
hashed as (
  select run, k, xor(list_reduce([4294967295]::bigint[] || flatten(list_transform(string_split(id || ':' || run, ''),
      lambda x: case when unicode(x) < 128 then [unicode(x)]::bigint[] else [195, unicode(x) - 64]::bigint[] end)),
    lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1])), 4294967295) as h
  from counted, tab
),
words as (
  select word, sum(k)::bigint as n from (
    select case when h % 199 = 0 then left(run, (h % length(run))::int) || substr(run, (h % length(run))::int + 2) else run end as word, k
    from hashed)
  where length(word) >= 6 group by word having sum(k) >= 5
),
cut as (
  select word, n, j, left(word, j::int) || substr(word, j::int + 2) as rest from (select word, n, unnest(range(length(word))) as j from words)
),
near as (
  select a.word, b.word as near, b.n as near_n from cut a join cut b on a.rest = b.rest and a.j = b.j and a.word <> b.word
  union select c.word, w.word, w.n from cut c join words w on c.rest = w.word
  union select w.word, c.word, c.n from cut c join words w on c.rest = w.word
),
best as (
  select word, near, near_n, count(*) over (partition by word) as n_near,
    row_number() over (partition by word order by near_n desc, encode(near)) as place
  from near
),
found as (
  select w.word, w.n, coalesce(b.n_near, 0)::bigint as n_near, case when b.near_n >= 5 * w.n then b.near end as form,
    case when b.near_n >= 5 * w.n then b.near_n end as form_n
  from words w left join best b on b.word = w.word and b.place = 1
),
chain as (
  select word, word as at from found
  union all select c.word, f.form from chain c join found f on f.word = c.at where f.form is not null
)
select f.word, f.n, f.n_near, f.form, f.form_n, c.at as root
from found f join chain c on c.word = f.word join found l on l.word = c.at and l.form is null
"""
}
