from pathlib import Path

import duckdb
import pytest

from perigee.session import scratch_path
from perigee.sources import typed_csv

NAMES = {"BIGINT": "bigint", "HUGEINT": "double", "DOUBLE": "double", "VARCHAR": "string", "BOOLEAN": "boolean", "DATE": "date", "TIMESTAMP": "timestamp"}
COLUMNS = {
    "whole": ["1", "-2", "", "4000000000"], "fraction": ["1", "2.5", "", "1e3"], "late": ["", "", "", "7.25"], "none": ["", "", "", ""],
    "day": ["2020-01-31", "1999-12-01", "", "2024-02-29"], "moment": ["2020-01-31 10:00:00", "2020-01-31 10:00:01.5", "", "2021-01-01 00:00:00"],
    "both": ["2020-01-31", "2020-01-31 10:00:00", "", ""], "bad_day": ["2020-02-30", "2020-01-01", "", ""], "flag": ["true", "false", "", "true"],
    "word": ["1", "2", "x", ""], "quoted": ['a "b", c', "d", "", "e"], "large": ["9223372036854775808", "1", "", "2"], "signed": ["+1", "2", "", "3"],
}


def write(tmp, columns):
    lines = [",".join(columns)]
    for row in zip(*columns.values()):
        lines.append(",".join('"' + v.replace('"', '""') + '"' if "," in v or '"' in v else v for v in row))
    Path(tmp).write_text("\n".join(lines) + "\n")


def test_types_and_values_match_a_whole_file_sniffer(spark, tmp_path):
    path = str(tmp_path / "x.csv")
    write(path, COLUMNS)
    con = duckdb.connect()
    sniffed = con.execute(f"select * from read_csv('{path}', header = true, sample_size = -1, strict_mode = false)")
    want = {d[0]: NAMES[str(d[1])] for d in sniffed.description}
    got = typed_csv.infer_types(spark.read.option("header", True).option("escape", '"').csv(path))
    assert got == {**want, "signed": "bigint"}
    read = typed_csv.read_csv_typed(spark, path)
    same = [c for c in COLUMNS if want[c] == got[c]]
    rows = con.execute(f"select {', '.join(f'"{c}"' for c in same)} from read_csv('{path}', header = true, sample_size = -1, strict_mode = false)").fetchall()
    assert [tuple(r) for r in read.select(*same).collect()] == rows


def test_one_late_value_in_many_rows(spark):
    path = scratch_path(spark, "late")
    spark.range(50_000).selectExpr("id", "CASE WHEN id = 49999 THEN 'x' WHEN id % 10000 = 1 THEN '5' END AS late").write.csv(path, header=True)
    assert typed_csv.infer_types(spark.read.csv(path, header=True)) == {"id": "bigint", "late": "string"}


@pytest.mark.parametrize("rows", [0, 1])
def test_empty_files(spark, tmp_path, rows):
    path = tmp_path / "e.csv"
    path.write_text("a,b\n" + ",\n" * rows)
    df = typed_csv.read_csv_typed(spark, str(path))
    assert df.dtypes == [("a", "string"), ("b", "string")] and df.count() == rows
