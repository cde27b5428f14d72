import pytest

from perigee.sources import tables
from pyspark.sql import functions as F

from perigee.operators import quality as dq
from perigee.operators import staging
from perigee.session import broadcast_if_small
from perigee.sources.tables import (
    class_seed, export_csv, load_mart, load_seed, missing_columns, read_csv_lenient, row_count_check, write_table, SEEDS,
)
from perigee.spec import CLASS_SEED_SCHEMA, ELEMENTS, RAW_SCHEMA, WITH_MOID, FeatureSpec

HEADER = ["spkid", "full_name", "pha", "neo", "class", *ELEMENTS]


def line(key, pha="N", neo="N", cls="MBA", name="Plain", **values):
    base = {c: "1.5" for c in ELEMENTS} | {k: str(v) for k, v in values.items()}
    return ",".join([str(key), name, pha, neo, cls, *[base[c] for c in ELEMENTS]])


@pytest.fixture(scope="module")
def raw(spark, tmp_path_factory):
    path = tmp_path_factory.mktemp("raw") / "bodies.csv"
    rows = [
        line(1, "Y", "Y", "APO"), line(2, pha=""), line(3, neo=""), line(4, neo="", cls="HYA"), line(5, cls="XXX"),
        line(6, moid=""), line(7, name='Mid"field'), line(8, a=900, q=901, i=902, moid=903), line(9, e=1.4),
        line(10, a="not-a-number"),
    ]
    path.write_text("\n".join([",".join(HEADER), *rows]) + "\n", "utf-8")
    return read_csv_lenient(spark, str(path), RAW_SCHEMA)


def test_raw_schema_has_45_columns(raw):
    assert len(RAW_SCHEMA) == 45
    assert "sigma_per" in missing_columns(raw.select("spkid"), RAW_SCHEMA)


def test_lenient_scan_keeps_lines_and_marks_bad_ones(raw):
    rows = {r["spkid"]: r for r in raw.select("spkid", "full_name", "a", "sigma_e", "_corrupt").collect()}
    assert len(rows) == 10
    assert rows[7]["full_name"] == 'Mid"field'
    assert rows[10]["a"] is None and rows[10]["_corrupt"].startswith("10,")
    assert rows[1]["sigma_e"] is None and rows[1]["_corrupt"] is None


def test_staging_drops_unknown_flags_classes_and_incomplete_rows(spark, raw):
    staged = staging.stage_bodies(raw, class_seed(spark), ELEMENTS)
    rows = {r["spkid"]: r for r in staged.collect()}
    assert sorted(rows) == [1, 7, 8, 9]
    assert rows[1]["is_pha"] and rows[1]["is_neo"] and rows[1]["class_code"] == 1
    assert rows[7]["is_pha"] is False and rows[7]["class_code"] == 8
    assert staging.orbital_features(staged).filter("spkid = 9").first()["tisserand_J"] is None


def test_caps_bound_the_population_and_tolerate_an_empty_one(spark, raw):
    staged = staging.stage_bodies(raw, class_seed(spark), ELEMENTS)
    caps = staging.feature_caps(staged, ["a", "moid"])
    assert caps.columns == ["a_p99", "moid_p99"]
    assert staging.cap_upper(staged, caps, ["a", "moid"]).agg(F.max("a")).first()[0] == pytest.approx(caps.first()["a_p99"])
    empty = staged.filter("spkid < 0")
    none = staging.feature_caps(empty, ["a"])
    assert none.first()["a_p99"] is None
    assert staging.cap_upper(staged, none, ["a"]).agg(F.max("a")).first()[0] == 900
    approx = staging.feature_caps(staged, ["a"], mode="approx")
    assert approx.first()["a_p99"] == 900


def test_seed_file_and_frame_agree(spark):
    stored = load_seed(spark, str(SEEDS / "body_classes.csv"), CLASS_SEED_SCHEMA)
    assert sorted(map(tuple, stored.collect())) == sorted(map(tuple, class_seed(spark).collect()))
    report = dq.run_checks(spark, {"seed": stored}, [dq.contiguous_codes("seed", "class_code", 13)])
    assert report.first()["passed"]


def test_mart_round_trip_and_csv_export(spark, raw, tmp_path):
    staged = staging.stage_bodies(raw, class_seed(spark), ELEMENTS)
    write_table(staged, str(tmp_path / "mart"))
    mart = load_mart(spark, str(tmp_path / "mart"), WITH_MOID)
    assert mart.columns == ["spkid", "is_pha", "e", "q", "H", "is_neo", "class_code", "moid"]
    assert dict(mart.dtypes)["is_pha"] == "int"
    export_csv(mart, str(tmp_path / "csv"))
    assert spark.read.option("header", True).csv(str(tmp_path / "csv")).count() == 4
    check = row_count_check(mart, 5).first()
    assert (check["actual"], check["ok"]) == (4, False)


def test_feature_spec_refuses_leaks():
    with pytest.raises(ValueError):
        FeatureSpec("id", "y", ("a", "y"))


def test_quality_checks_fail_on_bad_data(spark):
    df = spark.createDataFrame([(1, 5, True), (1, 99, False), (None, None, False)], "k int, c int, f boolean")
    parent = spark.createDataFrame([(5,)], "c int")
    report = dq.run_checks(spark, {"t": df, "p": parent}, [
        dq.unique("t", "k"), dq.not_null("t", "k"), dq.accepted_values("t", "c", range(13)),
        dq.relationships("t", "c", "p", "c"), dq.ratio_band("t", "f", 0.002, 0.0025), dq.row_count("t", 3),
    ])
    got = {r["check"]: (r["failing_rows"], r["passed"]) for r in report.collect()}
    assert got == {"unique": (1, False), "not_null": (1, False), "accepted_values": (1, False),
                   "relationships": (1, False), "ratio_band": (1, False), "row_count": (0, True)}


def test_broadcast_hint_only_below_the_limit(spark):
    hinted = broadcast_if_small(spark.range(10), 10)._jdf.queryExecution().logical().toString()
    plain = broadcast_if_small(spark.range(11), 10)._jdf.queryExecution().logical().toString()
    assert "Hint" in hinted and "Hint" not in plain


def test_files_with_another_header_fail_or_are_grouped(spark, tmp_path):
    from pyspark.sql import types as T

    schema = T.StructType([T.StructField("x", T.IntegerType()), T.StructField("y", T.StringType())])
    for name, text in (("a", "x,y\n1,one\n"), ("b", "Y,X\ntwo,2\n"), ("c", "x,y\nbad,three\n")):
        (tmp_path / f"{name}.csv").write_text(text)
    with pytest.raises(Exception, match="header"):
        tables.read_csv_lenient(spark, str(tmp_path), schema).collect()
    rows = tables.read_csv_lenient(spark, str(tmp_path), schema, mixed_headers=True).collect()
    assert sorted((r["x"] or 0, r["y"], r[tables.CORRUPT]) for r in rows) == [(0, "three", "bad,three"), (1, "one", None), (2, "two", None)]
