from pathlib import Path

import pytest

from perigee.session import cut_lineage, scratch_path, scratch_scope, shared_dir


def tables(spark):
    return {p.name for p in Path(shared_dir(spark), "perigee").glob("**/_SUCCESS")} | {str(p.parent) for p in Path(shared_dir(spark), "perigee").glob("**/_SUCCESS")}


def test_tables_of_a_scope_go_with_it(spark):
    outside = scratch_path(spark, "kept")
    before = tables(spark)
    with scratch_scope(spark):
        stored = cut_lineage(spark.range(10))
        assert len(tables(spark)) > len(before)
        with scratch_scope(spark):
            cut_lineage(spark.range(3))
        assert stored.count() == 10
        stored.write.parquet(outside)
    assert tables(spark) - before == {outside, "_SUCCESS"} - before
    assert spark.read.parquet(outside).count() == 10


def test_a_failing_scope_is_cleared(spark):
    before = tables(spark)
    with pytest.raises(ZeroDivisionError), scratch_scope(spark):
        cut_lineage(spark.range(10))
        1 / 0
    assert tables(spark) == before
    assert "scope" not in scratch_path(spark, "x")
