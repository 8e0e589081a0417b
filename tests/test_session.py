"""Scratch tables of a scope."""

import os
import time

import pytest
from pyspark.sql import functions as F

from riskloom.session import fresh_dir, note_scratch, scratch, settle


def place(df):
    return os.path.dirname(df.inputFiles()[0].removeprefix("file:").replace("///", "/"))


def test_scratch_deletes_its_own(spark):
    outside = settle(spark.range(3).toDF("x"), "outside")
    with scratch(spark):
        inner = settle(spark.range(5).toDF("x"), "inner")
        with scratch(spark):
            deeper = place(settle(spark.range(2).toDF("x"), "deeper"))
        assert not os.path.exists(deeper)
        path, result = fresh_dir(spark, "table"), fresh_dir(spark, "result")
        note_scratch(path, "scratch_case")
        inner.write.option("path", path).saveAsTable("scratch_case")
        inner.groupBy().sum("x").write.parquet(result)
        gone = place(inner)
        assert os.path.exists(gone) and spark.catalog.tableExists("scratch_case")
    assert not os.path.exists(gone) and not spark.catalog.tableExists("scratch_case")
    assert os.path.exists(place(outside)) and outside.count() == 3
    assert spark.read.parquet(result).first()[0] == 10


def test_scratch_deletes_after_a_failure(spark):
    with pytest.raises(ValueError), scratch(spark):
        gone = place(settle(spark.range(5).toDF("x"), "inner"))
        raise ValueError("stop")
    assert not os.path.exists(gone)


def test_settle_leaves_no_shuffle_files(spark):
    """They go with the write, not when the driver happens to collect its garbage."""
    disk = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()

    def files():
        every, out = disk.getAllFiles(), set()
        for i in range(every.size()):
            name = every.apply(i).getName()
            if name.startswith("shuffle_"):
                out.add(name)
        return out

    before = files()
    df = spark.range(100).groupBy((F.col("id") % 7).alias("b")).count()
    kept = settle(df, "tidy")
    until = time.time() + 20
    while (left := files() - before) and time.time() < until:
        time.sleep(0.1)
    assert not left
    # what was settled, and what it was settled from, can be read again
    assert sorted(kept.collect()) == sorted(df.collect()) == sorted(df.collect()) and kept.count() == 7
