import pytest
from pyspark.sql import functions as F

from perigee.operators.models import make_pipeline
from perigee.spec import WITH_MOID
from perigee.streaming import scoring_stream as st


@pytest.fixture(scope="module")
def world(spark):
    rows = [(i, i % 2 == 0, 0.3, 0.9, 18.0, True, 1, 0.02 if i % 2 == 0 else 0.9) for i in range(40)]
    fact = spark.createDataFrame(
        rows, "spkid bigint, is_pha boolean, e double, q double, H double, is_neo boolean, class_code int, moid double"
    )
    names = fact.select("spkid", F.format_string("Body %d", "spkid").alias("name"),
                        F.format_string("%d Body %d (X)", "spkid", "spkid").alias("full_name"), F.format_string("P%d", "spkid").alias("pdes"))
    numeric = fact.withColumns({c: F.col(c).cast("double") for c in ("is_pha", *WITH_MOID.features)})
    return fact, names, make_pipeline("decision_tree", WITH_MOID).fit(numeric)


def test_each_request_is_scored_once(spark, world, tmp_path):
    fact, names, model = world
    base = str(tmp_path)

    def drain():
        run = st.score_stream(spark, f"{base}/in", f"{base}/out", f"{base}/dead", f"{base}/cp", model,
                              fact.drop("is_pha"), names, log_dir=f"{base}/log")
        run.awaitTermination()
        return st.read_results(spark, f"{base}/out").collect()

    first = spark.createDataFrame([("Body 4",), ("7",), ("Body 4",), ("gone",), ("P9",)], "identifier string")
    st.submit(first, f"{base}/in")
    spark.createDataFrame([("{broken",), ("[]",), ('{"other": 1}',)], "value string").write.mode("append").text(f"{base}/in")
    rows = drain()
    assert sorted((r["identifier"], r["spkid"], r["is_pha"], r["error"]) for r in rows if r["spkid"] is not None) == [
        ("7", 7, False, None), ("Body 4", 4, True, None), ("Body 4", 4, True, None), ("P9", 9, False, None),
    ]
    assert [(r["identifier"], r["error"], r["probability"]) for r in rows if r["spkid"] is None] == [("gone", "not found", None)]
    assert all(r["scored_at"] > 1e9 for r in rows)
    assert {r["value"] for r in spark.read.text(f"{base}/dead").collect()} == {"{broken", "[]", '{"other": 1}'}
    assert len(drain()) == 5
    st.submit(spark.createDataFrame([("Body 5",)], "identifier string"), f"{base}/in")
    assert len(drain()) == 6
    assert spark.read.parquet(f"{base}/log").count() == 5


def test_requests_by_identifier_or_values(spark, world):
    from perigee.operators.scoring import predict

    fact, names, model = world
    values = (0.3, 0.9, 18.0, True, 1, 0.02)
    rows = [
        (1, "body 4", None, None, None, None, None, None), (2, None, *values), (3, "", *values), (4, None, 1.5, *values[1:]), (5, "zzqqxx", *values),
        (6, None, None, *values[1:]), (7, "body 4", 1.5, *values[1:]), (8, "7", *values),
    ]
    schema = "request_id int, identifier string, e double, q double, H double, is_neo boolean, class_code int, moid double"
    out = {r["request_id"]: r for r in predict(spark.createDataFrame(rows, schema), model, fact.drop("is_pha"), names, WITH_MOID).collect()}
    assert {k: (r["route"], r["spkid"], r["is_pha"]) for k, r in out.items() if r["error"] is None} == {
        1: ("lookup", 4, True), 2: ("values", None, True), 3: ("values", None, True), 7: ("lookup", 4, True), 8: ("lookup", 7, False),
    }
    assert out[4]["error"] == "invalid: e" and out[5]["error"] == "not found" and out[6]["error"].startswith("Provide either")
    assert all(out[k]["is_pha"] is None and out[k]["probability"] is None and out[k]["explanation"] is None for k in (4, 5, 6))
