"""Linking of tool calls in chats, on DataFrame functions alone.

Calls and results meet by their identifier in a hash join. Calls are ordered so that each comes after those it depends
on: by turn, and where a dependency stands later in the log, behind it; rounds of joins pass such delays on until nothing
moves. Arguments are parsed once, checked against the tool's schema, and written as canonical JSON: no white space, keys
in order, which is how a parsed object holds them.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from perigee.llm.common import columns_of, store, table

# Type of an argument in a schema -> what Spark calls the type of such a JSON value.
JSON_TYPES = {"string": "STRING", "integer": "BIGINT", "number": "BIGINT|DOUBLE|DECIMAL.*", "boolean": "BOOLEAN", "object": "OBJECT.*", "array": "ARRAY.*"}
EVENT_COLUMNS = ("conv", "turn", "kind", "role", "call_id", "name", "arguments", "after", "content")
Schema = Mapping[str, tuple[str, bool]]  # argument -> (type, required)


def json_text(value: Column) -> Column:
    """A string as JSON; null as null."""
    return F.coalesce(F.to_json(value.cast("variant")), F.lit("null"))


def argument_errors(name: Column, arguments: Column, schemas: Mapping[str, Schema]) -> Column:
    """What is wrong with a call's arguments, as an array of texts; empty if nothing is."""
    parsed = F.try_parse_json(arguments)
    is_object = F.coalesce(F.schema_of_variant(parsed).startswith("OBJECT"), F.lit(False))
    keys = F.coalesce(F.json_object_keys(arguments), F.array().cast("array<string>"))
    checked = F.when(~is_object, F.array(F.lit("arguments are not an object")))
    for tool, schema in schemas.items():
        known = F.array(*[F.lit(k) for k in schema]).cast("array<string>")
        found = [F.transform(F.array_sort(F.array_except(keys, known)), lambda k: F.concat(F.lit("unknown argument "), k))]
        for key, (kind, required) in sorted(schema.items()):
            there = F.array_contains(keys, key)
            value = F.schema_of_variant(F.try_variant_get(parsed, "$['%s']" % key.replace("'", "\\'"), "variant"))
            wrong = F.when(there & ~F.coalesce(value.rlike(f"^({JSON_TYPES[kind]})$"), F.lit(False)), F.lit(f"{key} is not of type {kind}"))
            if required:
                wrong = F.when(~there, F.lit(f"{key} is missing")).otherwise(wrong)
            found.append(F.array(wrong))
        checked = checked.when(name == tool, F.array_compact(F.concat(*found)))
    return checked.otherwise(F.array(F.lit("unknown tool")))


def ordered_calls(calls: DataFrame) -> DataFrame:
    """``(conv, call_id, at, step, unmet)``: a call's place is (at, step), the largest of its own turn and, one step behind
    them, the places of the calls it depends on. A call in a cycle of dependencies counts as unmet like one whose
    dependency is missing."""
    place = F.struct(F.col("turn").alias("at"), F.lit(0).cast("long").alias("step"))
    state = store(calls.select("conv", "call_id", "turn", "after", place.alias("place")))
    links = state.select("conv", "call_id", F.explode("after").alias("dep"))
    known = state.select(F.col("conv").alias("_c"), F.col("call_id").alias("_d"))
    on = F.col("conv").eqNullSafe(F.col("_c")) & (F.col("dep") == F.col("_d"))
    links = store(links.join(known, on, "left").select("conv", "call_id", "dep", F.col("_d").isNull().alias("lost")))
    unmet = links.filter("lost").select("conv", "call_id").distinct().withColumn("lost", F.lit(True))
    links = links.filter("not lost").select("conv", "call_id", "dep")
    # Calls of a conversation; a delay of as many steps goes round in a circle.
    most = state.groupBy("conv").agg(F.count("*").alias("most"))
    same = lambda a, b: F.col(a).eqNullSafe(F.col(b))
    state = store(state.join(most.withColumnRenamed("conv", "_c"), same("conv", "_c")).select("conv", "call_id", "turn", "place", "most"))
    while True:
        sources = state.filter("place.step <= most").select(F.col("conv").alias("_c"), F.col("call_id").alias("_d"), F.col("place").alias("from"))
        behind = F.struct(F.col("from.at").alias("at"), (F.col("from.step") + 1).alias("step"))
        pushed = links.join(sources, on).groupBy("conv", "call_id").agg(F.max(behind).alias("pushed")).withColumnsRenamed({"conv": "_c", "call_id": "_d"})
        moved = state.join(pushed, same("conv", "_c") & (F.col("call_id") == F.col("_d")), "left")
        moved = store(moved.select("conv", "call_id", "turn", "most", F.greatest("place", "pushed").alias("place"), (F.col("pushed") > F.col("place")).alias("moved")))
        state = moved.drop("moved")
        if not moved.filter("moved").limit(1).count():
            break
    unmet = unmet.withColumnsRenamed({"conv": "_c", "call_id": "_d"})
    out = state.join(unmet, same("conv", "_c") & (F.col("call_id") == F.col("_d")), "left")
    return out.select("conv", "call_id", "place.at", "place.step", (F.coalesce("lost", F.lit(False)) | (F.col("place.step") >= F.col("most"))).alias("unmet"))


def link_chats(events: DataFrame, schemas: Mapping[str, Schema]) -> DataFrame:
    """One row per event of ``(conv, turn, kind, role, call_id, name, arguments, after, content)`` with its place and JSON.

    ``kind`` is message, call or result. Adds ``position`` (from 0 in a conversation), ``status`` and ``json``. Status of
    a call: duplicate (its identifier was used by an earlier turn; no result links to it), invalid (see ``errors``),
    unmet (a dependency is missing or circular), unanswered or ok; of a result: orphan or ok. Null conversations form
    one, null identifiers link with nothing, and of equal rows all stay.
    """
    events = columns_of(events, EVENT_COLUMNS)
    calls = events.filter("kind = 'call' and call_id is not null")
    first = calls.groupBy("conv", "call_id").agg(F.min(F.struct("turn", "after")).alias("x"))
    first = store(first.select("conv", "call_id", "x.turn", F.coalesce("x.after", F.array().cast("array<string>")).alias("after")))
    placed = ordered_calls(first).join(
        first.select(F.col("conv").alias("_c"), F.col("call_id").alias("_d"), F.col("turn").alias("first_turn")),
        F.col("conv").eqNullSafe(F.col("_c")) & (F.col("call_id") == F.col("_d")),
    ).drop("_c", "_d")
    answered = events.filter("kind = 'result' and call_id is not null").select("conv", "call_id").distinct().withColumn("answered", F.lit(True))
    named = answered.withColumnsRenamed({"conv": "_c", "call_id": "_d"})
    placed = placed.join(named, F.col("conv").eqNullSafe(F.col("_c")) & (F.col("call_id") == F.col("_d")), "left").drop("_c", "_d")
    placed = store(placed.withColumnsRenamed({"conv": "_c", "call_id": "_d"}))
    rows = events.join(placed, F.col("conv").eqNullSafe(F.col("_c")) & (F.col("call_id") == F.col("_d")) & (F.col("kind") != "message"), "left")
    is_call, linked = F.col("kind") == "call", F.col("_d").isNotNull()
    errors = F.when(is_call, argument_errors(F.col("name"), F.col("arguments"), schemas)).otherwise(F.array().cast("array<string>"))
    status = (
        F.when(is_call & linked & (F.col("turn") > F.col("first_turn")), "duplicate").when(is_call & (F.size("errors") > 0), "invalid")
        .when(is_call & F.coalesce("unmet", F.lit(False)), "unmet").when(is_call & F.coalesce("answered", F.lit(False)), "ok").when(is_call, "unanswered")
        .when((F.col("kind") == "result") & ~linked, "orphan").otherwise("ok")
    )
    own = F.struct(F.col("turn").alias("at"), F.lit(0).cast("long").alias("step"))
    place = F.when(linked, F.greatest(own, F.struct("at", "step"))).otherwise(own)
    ident, content = json_text(F.col("call_id")), json_text(F.col("content"))
    canonical = F.coalesce(F.to_json(F.try_parse_json("arguments")), json_text(F.col("arguments")))
    written = (
        F.when(is_call, F.concat(F.lit('{"arguments":'), canonical, F.lit(',"id":'), ident, F.lit(',"name":'), json_text(F.col("name")), F.lit(',"type":"call"}')))
        .when(F.col("kind") == "result", F.concat(F.lit('{"content":'), content, F.lit(',"id":'), ident, F.lit(',"type":"result"}')))
        .otherwise(F.concat(F.lit('{"content":'), content, F.lit(',"role":'), json_text(F.col("role")), F.lit(',"type":"message"}')))
    )
    rows = rows.withColumn("errors", errors).withColumn("place", place).withColumn("status", status).withColumn("json", written)
    order = Window.partitionBy("conv").orderBy("place", F.when(F.col("kind") == "result", 1).otherwise(0), "turn", "call_id", "json")
    return rows.withColumn("position", (F.row_number().over(order) - 1).cast("long")).select(
        "conv", "turn", "position", "kind", "call_id", "status", "errors", "json"
    )


ASK: dict[str, Schema] = {"ask": {"question": ("string", True), "turn": ("integer", True)}}


def as_tool_calls(conversations: DataFrame) -> DataFrame:
    """The events of plain conversations: a user's turn calls the tool ``ask``, an assistant's turn is the result of the
    turn before it, and each call depends on the one two turns earlier, if there are so many."""
    def ident(back: int) -> Column:
        return F.concat_ws("-", F.col("conv_id"), F.col("turn") - back)

    is_call, is_result = F.coalesce(F.col("role") == "user", F.lit(False)), F.coalesce(F.col("role") == "assistant", F.lit(False))
    none = F.array().cast("array<string>")
    return conversations.select(
        F.col("conv_id").alias("conv"), "turn", F.when(is_call, "call").when(is_result, "result").otherwise("message").alias("kind"), "role",
        F.when(is_call, ident(0)).when(is_result, ident(1)).alias("call_id"), F.when(is_call, F.lit("ask")).alias("name"),
        F.when(is_call, F.to_json(F.struct("turn", F.col("text").alias("question")))).alias("arguments"),
        F.when(is_call & (F.col("turn") >= 2), F.array(ident(2))).otherwise(none).alias("after"), F.when(~is_call, F.col("text")).alias("content"),
    )


def op6_tool_calls(spark: SparkSession, sf_dir: str) -> DataFrame:
    linked = link_chats(as_tool_calls(table(spark, sf_dir, "conversations")), ASK)
    return linked.select(F.col("conv").alias("conv_id"), "turn", "position", "kind", "call_id", "status", F.concat_ws("; ", "errors").alias("errors"), "json")


QUERIES = {"op6_tool_calls": op6_tool_calls}
ORACLES = {
    "op6_tool_calls": """
with u as (select conv_id, turn, conv_id || '-' || turn as id, text from conversations where role = 'user'),
a as (select conv_id, turn, conv_id || '-' || (turn - 1) as id, text from conversations where role = 'assistant'),
rows as (
  select u.conv_id, u.turn, 'call' as kind, u.id as call_id,
         case when u.text is null then 'invalid'
              when u.turn >= 2 and not exists (select 1 from u p where p.conv_id = u.conv_id and p.turn = u.turn - 2) then 'unmet'
              when not exists (select 1 from a where a.conv_id = u.conv_id and a.turn = u.turn + 1) then 'unanswered' else 'ok' end as status,
         case when u.text is null then 'question is missing' else '' end as errors,
         '{"arguments":{"question":' || to_json(u.text)::varchar || ',"turn":' || u.turn || '},"id":' || to_json(u.id)::varchar || ',"name":"ask","type":"call"}' as json
  from u
  union all
  select a.conv_id, a.turn, 'result', a.id,
         case when exists (select 1 from u where u.conv_id = a.conv_id and u.turn = a.turn - 1) then 'ok' else 'orphan' end, '',
         '{"content":' || to_json(a.text)::varchar || ',"id":' || to_json(a.id)::varchar || ',"type":"result"}'
  from a
  union all
  select conv_id, turn, 'message', null, 'ok', '',
         '{"content":' || to_json(text)::varchar || ',"role":' || to_json(role)::varchar || ',"type":"message"}'
  from conversations where role not in ('user', 'assistant')
)
select conv_id, turn, (row_number() over (partition by conv_id order by turn) - 1)::bigint as position, kind, call_id, status, errors, json
from rows
"""
}
