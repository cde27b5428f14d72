"""Text similarity and explanation columns."""

from __future__ import annotations

from difflib import SequenceMatcher

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from perigee.spec import H_LIMIT, MOID_LIMIT


def _swapped(text: Column, i: Column) -> Column:
    """``text`` with the characters at 1-based positions i and i+1 exchanged."""
    return F.concat(
        F.substring(text, F.lit(1), i - 1), F.substring(text, i + 1, F.lit(1)), F.substring(text, i, F.lit(1)),
        F.substring(text, i + 2, F.length(text)),
    )


def edit_budget(token: Column) -> Column:
    """Edits allowed for a token: 0 up to two characters, 1 up to five, 2 beyond."""
    size = F.length(token)
    return F.when(size <= 2, 0).when(size <= 5, 1).otherwise(2)


def edits(a: Column, b: Column) -> Column:
    """Edit distance up to 2 with a swap of neighbours as one edit; larger distances come out as 3 or more.

    A swap saves one edit at most, so swaps are tried for plain distances of two to four only.
    """
    plain = F.levenshtein(a, b)
    places = F.when(F.length(a) > 1, F.sequence(F.lit(1), F.length(a) - 1)).otherwise(F.array().cast("array<int>"))
    one_swap = F.coalesce(F.array_min(F.transform(places, lambda i: F.levenshtein(_swapped(a, i), b))) + 1, F.lit(3))
    two_swaps = F.exists(
        places, lambda i: F.exists(places, lambda j: (j > i + 1) & (_swapped(_swapped(a, i), j) == b))
    )
    swapped = F.least(plain, one_swap, F.when(two_swaps, 2).otherwise(3))
    return F.when(plain <= 1, plain).when(plain > 4, F.lit(3)).otherwise(swapped)


def edit_similarity(a: Column, b: Column) -> Column:
    """1 - distance / longer length, on trimmed lower-case text."""
    x, y = F.lower(F.trim(a)), F.lower(F.trim(b))
    longest = F.greatest(F.length(x), F.length(y))
    return F.when(longest > 0, 1 - F.levenshtein(x, y) / longest).otherwise(F.lit(1.0))


@F.pandas_udf(T.DoubleType())
def block_similarity(a: pd.Series, b: pd.Series) -> pd.Series:
    """Matching-block ratio of trimmed lower-case text; null when a side is missing."""
    return pd.Series([
        None if x is None or y is None else SequenceMatcher(None, x.strip().lower(), y.strip().lower()).ratio()
        for x, y in zip(a, b)
    ], dtype="float64")


def rule_met(moid: Column, h: Column) -> Column:
    return (moid <= F.lit(MOID_LIMIT)) & (h <= F.lit(H_LIMIT))


# Wording and number formats of the explanation.
EXPLANATION = (
    "Model prediction: %s (probability=%.3f). NASA's PHA definition requires MOID <= 0.05 AU AND H <= 22.0. "
    "This object has MOID = %.4f AU (%s 0.05 AU, condition %s) and H = %.2f (%s 22.0, condition %s). "
    "The model's prediction is %s NASA's two-condition rule applied directly to this object's MOID and H."
)


def explain_column(moid: Column, h: Column, is_pha: Column, probability: Column) -> Column:
    """Explanation built only from the values and the two-condition rule; null when an input is null.

    Values are rounded before they are formatted, so that exact ties print alike in every engine.
    """
    def met(condition: Column) -> Column:
        return F.when(condition, F.lit("met")).otherwise(F.lit("not met"))

    def sign(condition: Column) -> Column:
        return F.when(condition, F.lit("<=")).otherwise(F.lit(">"))

    moid_ok, h_ok = moid <= F.lit(MOID_LIMIT), h <= F.lit(H_LIMIT)
    text = F.format_string(
        EXPLANATION,
        F.when(is_pha, F.lit("potentially hazardous")).otherwise(F.lit("not potentially hazardous")),
        F.round(probability, 3), F.round(moid, 4), sign(moid_ok), met(moid_ok), F.round(h, 2), sign(h_ok), met(h_ok),
        F.when((moid_ok & h_ok) == is_pha, F.lit("consistent with")).otherwise(F.lit("in tension with")),
    )
    complete = moid.isNotNull() & h.isNotNull() & is_pha.isNotNull() & probability.isNotNull()
    return F.when(complete, text)
