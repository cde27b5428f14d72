import pytest
from pyspark.sql import functions as F

from perigee.functions.text import explain_column
from perigee.operators import scoring

COLUMNS = "e double, q double, H double, is_neo boolean, class_code int, moid double"


@pytest.fixture(scope="module")
def requests(spark):
    return spark.createDataFrame([
        (0.3, 0.9, 18.0, True, 1, 0.02), (0.1, 2.5, 10.0, False, 8, 0.5), (1.5, 0.9, 18.0, True, 1, 0.02),
        (0.3, 0.9, 18.0, True, 99, 0.02), (None, -1.0, 40.0, None, 0, -0.1), (0.0, 0.1, -4.9, True, 0, 0.0),
    ], COLUMNS)


def test_bounds(requests):
    assert [r["errors"] for r in scoring.validate(requests).collect()] == [
        [], [], ["e"], ["class_code"], ["e", "q", "H", "is_neo", "moid"], [],
    ]
    good, bad = scoring.split_valid(requests)
    assert (good.count(), bad.count()) == (3, 3)


def test_explanation_text(spark):
    df = spark.createDataFrame([(0.02, 18.0, True, 0.98765), (0.5, 10.0, True, 0.125), (None, 1.0, True, 0.5)],
                               "moid double, H double, y boolean, p double")
    rows = [r[0] for r in df.select(explain_column(F.col("moid"), F.col("H"), F.col("y"), F.col("p"))).collect()]
    assert rows[0] == (
        "Model prediction: potentially hazardous (probability=0.988). NASA's PHA definition requires MOID <= 0.05 AU AND "
        "H <= 22.0. This object has MOID = 0.0200 AU (<= 0.05 AU, condition met) and H = 18.00 (<= 22.0, condition met). "
        "The model's prediction is consistent with NASA's two-condition rule applied directly to this object's MOID and H."
    )
    assert "> 0.05 AU, condition not met" in rows[1] and "in tension with" in rows[1]
    assert rows[2] is None


def test_routes(spark, requests):
    df = requests.withColumn("identifier", F.when(F.col("H") == 10.0, F.lit("Eros")).when(F.col("e") == 1.5, F.lit("")))
    rows = scoring.route_requests(df).collect()
    assert [r["route"] for r in rows] == ["values", "lookup", "values", "values", "error", "values"]
    assert rows[4]["error"].startswith("Provide either `identifier`") and rows[0]["error"] is None


def test_log_failure_does_not_break_scoring(spark, requests, tmp_path):
    scored = requests.withColumns({"is_pha": F.lit(True), "probability": F.lit(0.5)})
    assert scoring.log_predictions(scored, str(tmp_path / "log"))
    stored = spark.read.parquet(str(tmp_path / "log"))
    assert stored.count() == 6 and stored.first()["probability"] == "0.5"
    blocked = tmp_path / "file"
    blocked.write_text("x")
    assert not scoring.log_predictions(scored, str(blocked / "log"))
