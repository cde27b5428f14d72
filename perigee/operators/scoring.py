"""Request validation and routing, rule flags, batch scoring and the prediction log."""

from __future__ import annotations

import logging
from collections.abc import Mapping, Sequence

from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from perigee.functions.text import explain_column, rule_met
from perigee.operators.resolve import fetch_records, resolve
from perigee.session import cut_lineage
from perigee.spec import EXP2_FEATURES, REQUEST_RULES, FeatureSpec

log = logging.getLogger(__name__)


def validate(df: DataFrame, rules: Mapping[str, str] = REQUEST_RULES) -> DataFrame:
    """Adds ``errors``, the names of violated rules. A null value violates its rule."""
    broken = [F.when(~F.coalesce(F.expr(rule), F.lit(False)), F.lit(name)) for name, rule in rules.items()]
    return df.withColumn("errors", F.array_compact(F.array(*broken)))


def split_valid(df: DataFrame, rules: Mapping[str, str] = REQUEST_RULES) -> tuple[DataFrame, DataFrame]:
    """Accepted and rejected requests."""
    checked = validate(df, rules)
    return checked.filter(F.size("errors") == 0).drop("errors"), checked.filter(F.size("errors") > 0)


def route_requests(df: DataFrame, features: Sequence[str] = EXP2_FEATURES) -> DataFrame:
    """Adds ``route``: ``lookup`` with an identifier, ``values`` with all features, else ``error`` and a message."""
    complete = F.lit(True)
    for c in features:
        complete = complete & F.col(c).isNotNull()
    named = F.coalesce(F.col("identifier") != "", F.lit(False))
    route = F.when(named, F.lit("lookup")).when(complete, F.lit("values")).otherwise(F.lit("error"))
    # Fixed value: the error text.
    message = F.lit(f"Provide either `identifier`, or all six of {', '.join(features)}.")
    return df.withColumn("route", route).withColumn("error", F.when(F.col("route") == "error", message))


def rule_flags(df: DataFrame, pred: str = "is_pha", moid: str = "moid", h: str = "H") -> DataFrame:
    """The two rule conditions, the rule itself and whether the prediction agrees with it."""
    met = rule_met(F.col(moid), F.col(h))
    return df.withColumns({"rule_met": met, "rule_agrees": met == F.col(pred).cast("boolean")})


def positive_probability(scored: DataFrame) -> Column:
    """Probability of the positive class; the mean over the probability columns of an averaged ensemble."""
    cols = [c for c in scored.columns if c == "probability" or c.startswith("probability_")]
    if not cols:
        raise ValueError("the model produced no probability column")
    total = sum((vector_to_array(F.col(c))[1] for c in cols[1:]), vector_to_array(F.col(cols[0]))[1])
    return total / len(cols)


def apply_model(df: DataFrame, model, spec: FeatureSpec) -> DataFrame:
    """Adds ``prob`` and ``pred``; missing features are an error, extra columns pass through."""
    missing = [c for c in spec.features if c not in df.columns]
    if missing:
        raise ValueError(f"missing feature columns: {missing}")
    scored = model.transform(df)
    prob = positive_probability(scored)
    return scored.select(*[F.col(c) for c in df.columns], prob.alias("prob"), (prob > 0.5).cast("int").alias("pred"))


def score(df: DataFrame, model, spec: FeatureSpec, moid: str = "moid", h: str = "H") -> DataFrame:
    """Batch prediction: ``is_pha``, ``probability`` and ``explanation``. Rows with a null feature keep nulls."""
    complete = F.lit(True)
    for c in spec.features:
        complete = complete & F.col(c).isNotNull()
    out = apply_model(
        df.withColumn("_complete", complete).withColumns({
            f"_in_{c}": F.coalesce(F.col(c).cast("double"), F.lit(0.0)) for c in spec.features
        }).select(*[F.col(c).alias(f"_out_{c}") for c in df.columns], "_complete",
                  *[F.col(f"_in_{c}").alias(c) for c in spec.features]),
        model, spec,
    )
    probability = F.when(F.col("_complete"), F.col("prob"))
    flagged = F.when(F.col("_complete"), F.col("pred") == 1)
    return out.select(
        *[F.col(f"_out_{c}").alias(c) for c in df.columns], flagged.alias("is_pha"), probability.alias("probability"),
        explain_column(F.col(f"_out_{moid}"), F.col(f"_out_{h}"), flagged, probability).alias("explanation"),
    )


def predict(requests: DataFrame, model, fact: DataFrame, names: DataFrame, spec: FeatureSpec, **options) -> DataFrame:
    """Requests by identifier or by values: the requests' other columns with route, key, decision, explanation and error.

    An identifier is resolved to a record of ``fact`` (``options`` go to the resolver), values are checked; whatever is
    left is scored in one pass. Requests that cannot be answered stay, with the reason as ``error``.
    """
    extra = [c for c in requests.columns if c not in (spec.id, "identifier", *spec.features)]
    routed = cut_lineage(route_requests(requests, spec.features))
    named = routed.filter("route = 'lookup'").select(*extra, "route", "identifier")
    asked = cut_lineage(named.select("identifier").distinct())
    records = fetch_records(resolve(asked, names, spec.id, **options), fact, names, spec.id)
    record = records.select(F.col("identifier").alias("_asked"), spec.id, *spec.features)
    looked_up = named.join(record, F.col("identifier") == F.col("_asked"), "left").drop("_asked").withColumn(
        "error", F.when(F.col(spec.id).isNull(), F.lit("not found"))
    )
    given = validate(routed.filter("route <> 'lookup'").withColumn(spec.id, F.lit(None).cast(fact.schema[spec.id].dataType)))
    broken = F.when((F.col("route") == "values") & (F.size("errors") > 0), F.concat(F.lit("invalid: "), F.array_join("errors", ",")))
    given = given.withColumn("error", F.coalesce("error", broken))
    columns = [*extra, "route", "identifier", spec.id, *spec.features, "error"]
    together = looked_up.select(*columns).unionByName(given.select(*columns))
    # A request with an error has no features, so it gets no decision.
    blanked = together.withColumns({c: F.when(F.col("error").isNull(), F.col(c)) for c in spec.features})
    return score(blanked, model, spec).select(*extra, "route", "identifier", spec.id, "is_pha", "probability", "explanation", "error")


def prediction_log(scored: DataFrame, features: Sequence[str] = EXP2_FEATURES) -> DataFrame:
    """Log rows: request id, epoch second, features as text, decision and probability as text."""
    pairs = [part for c in features for part in (F.lit(c), F.col(c).cast("string"))]
    return scored.filter(F.col("probability").isNotNull()).select(
        F.expr("uuid()").alias("request_id"), F.unix_timestamp().alias("timestamp"), F.create_map(*pairs).alias("features"),
        "is_pha", F.col("probability").cast("string").alias("probability"),
    )


def log_predictions(scored: DataFrame, path: str, features: Sequence[str] = EXP2_FEATURES) -> bool:
    """Appends to the prediction log. A failure is reported and never breaks scoring."""
    try:
        prediction_log(scored, features).write.mode("append").parquet(path)
        return True
    except Exception as exc:  # noqa: BLE001 - logging must not break a prediction
        log.warning("prediction log failed: %s", exc)
        return False
