import os

import pytest
from pyspark.sql import functions as F

from rankflow.session import cut, scratch, shared_dir


def folders(spark):
    return {name for name in os.listdir(shared_dir(spark).removeprefix("file://")) if name.startswith("rankflow-")}


def test_scope_deletes_what_no_result_reads(spark):
    before = folders(spark)
    with scratch(spark) as own:
        first = cut(spark.range(10).toDF("id"), "first")
        second = cut(first.filter("id > 3"), "second")
        cut(second, "third")
        result = own.result(second.withColumn("twice", F.col("id") * 2))
    assert len(folders(spark) - before) == 1
    assert result.agg(F.sum("twice")).first()[0] == 78


def test_nested_scopes_hand_on_what_they_keep(spark):
    before = folders(spark)
    with scratch(spark) as outer:
        with scratch(spark) as inner:
            kept = inner.result(cut(spark.range(5).toDF("id"), "kept"))
            cut(kept, "gone")
        assert len(folders(spark) - before) == 1
        total = cut(kept.agg(F.sum("id").alias("total")), "total")
        outer.drop(kept)
        assert len(folders(spark) - before) == 1
        result = outer.result(total)
    assert result.first()["total"] == 10 and len(folders(spark) - before) == 1


def test_failure_deletes_everything(spark):
    before = folders(spark)
    with pytest.raises(ValueError):
        with scratch(spark) as own:
            own.result(cut(spark.range(5).toDF("id"), "kept"))
            raise ValueError
    assert folders(spark) == before
