"""Column roles and the small-body catalogue configuration."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T


@dataclass(frozen=True)
class FeatureSpec:
    """Keeps key, target and features apart, so that neither key nor target can become a feature."""

    id: str
    target: str
    features: tuple[str, ...]
    nominal: tuple[str, ...] = ()

    def __post_init__(self):
        object.__setattr__(self, "features", tuple(self.features))
        object.__setattr__(self, "nominal", tuple(self.nominal))
        leaked = {self.id, self.target} & set(self.features)
        if leaked:
            raise ValueError(f"key or target listed as a feature: {sorted(leaked)}")
        if not set(self.nominal) <= set(self.features):
            raise ValueError("nominal columns must be features")

    @property
    def columns(self) -> list[str]:
        return [self.id, self.target, *self.features]


# The two feature sets, the clustering features and the column roles of the catalogue.
EXP1_FEATURES = ("e", "q", "H", "is_neo", "class_code")
EXP2_FEATURES = ("e", "q", "H", "is_neo", "class_code", "moid")
CLUSTER_FEATURES = ("a", "e", "i", "moid", "H")
ELEMENTS = ("H", "e", "a", "q", "i", "om", "w", "ma", "ad", "n", "per", "per_y", "moid", "rms")
CAPPED = ("a", "q", "moid", "i")
MART_COLUMNS = ("spkid", "is_pha", "is_neo", "class", "class_code", "H", "e", "a", "q", "i", "per", "moid")
NAME_COLUMNS = ("full_name", "name", "pdes")

WITHOUT_MOID = FeatureSpec("spkid", "is_pha", EXP1_FEATURES, ("is_neo", "class_code"))
WITH_MOID = FeatureSpec("spkid", "is_pha", EXP2_FEATURES, ("is_neo", "class_code"))
FEATURE_SETS = {"exp1_moid_excluded": WITHOUT_MOID, "exp2_moid_included": WITH_MOID}

# Raw catalogue columns by type.
_TEXT = ("id", "full_name", "pdes", "name", "prefix", "neo", "pha", "orbit_id", "equinox", "epoch_cal", "tp_cal", "class")
_NUMERIC = (
    "H", "diameter", "albedo", "diameter_sigma", "epoch", "epoch_mjd", "e", "a", "q", "i", "om", "w", "ma", "ad", "n",
    "tp", "per", "per_y", "moid", "moid_ld", "rms", "sigma_e", "sigma_a", "sigma_q", "sigma_i", "sigma_om", "sigma_w",
    "sigma_ma", "sigma_ad", "sigma_n", "sigma_tp", "sigma_per",
)
RAW_SCHEMA = T.StructType(
    [T.StructField("spkid", T.LongType())]
    + [T.StructField(c, T.StringType()) for c in _TEXT]
    + [T.StructField(c, T.DoubleType()) for c in _NUMERIC]
)

CLASS_SEED_SCHEMA = T.StructType([
    T.StructField("class_code", T.IntegerType()),
    T.StructField("class_abbr", T.StringType()),
    T.StructField("class_name", T.StringType()),
])

# The two-condition hazard rule and the expected share of positives.
MOID_LIMIT = 0.05
H_LIMIT = 22.0
RATIO_BAND = (0.0020, 0.0025)
EXPECTED_RAW_ROWS = 958_524

# Bounds of a scoring request, as SQL predicates named after the field they guard.
REQUEST_RULES = {
    "e": "e >= 0 AND e < 1",
    "q": "q > 0",
    "H": "H > -5 AND H < 40",
    "is_neo": "is_neo IS NOT NULL",
    "class_code": "class_code BETWEEN 0 AND 12",
    "moid": "moid >= 0",
}
