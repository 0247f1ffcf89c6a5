"""Models that refer to each other; table defaults."""

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wattline.plans.models import Model, build_all
from wattline.sources import catalog


def test_unknown_and_circular_references(spark, tmp_dir):
    with pytest.raises(ValueError, match="aren't models"):
        build_all(spark, {"a": Model(lambda b: b, ["b"])}, tmp_dir)
    with pytest.raises(ValueError, match="cycle"):
        build_all(spark, {"a": Model(lambda b: b, ["b"]), "b": Model(lambda a: a, ["a"])}, tmp_dir)


def test_a_warning_skips_nothing(spark, tmp_dir):
    some = {"bad": lambda d: d}
    built = build_all(spark, {"low": Model(lambda top: top.where("id > 0"), ["top"], "table"),
                              "top": Model(lambda: spark.range(3), tests=some, severity="warn")}, tmp_dir, "warned_")
    assert [b.status for b in built.values()] == ["built", "built"] and built["low"].data.count() == 2
    assert spark.table("warned_low").count() == 2


def test_defaults(spark, tmp_dir):
    schema = T.StructType([T.StructField("a", T.LongType()), T.StructField("came", T.TimestampNTZType()), T.StructField("n", T.LongType())])
    with pytest.raises(ValueError, match="aren't there"):
        catalog.create_table_if_absent(spark, "wattline_defaults", schema, tmp_dir, defaults={"b": "1"})
    catalog.create_table_if_absent(spark, "wattline_defaults", schema, tmp_dir, defaults={"came": "localtimestamp()", "n": "7"})
    catalog.insert_rows(spark, "wattline_defaults", spark.range(2).select(F.col("id").alias("a")))
    catalog.insert_rows(spark, "wattline_defaults", spark.range(1).select(F.lit(5).cast("long").alias("a"), F.lit(None).cast("timestamp_ntz").alias("came")))
    rows = spark.table("wattline_defaults").orderBy("a").collect()
    assert [(r.a, r.came is None, r.n) for r in rows] == [(0, False, 7), (1, False, 7), (5, True, 7)]
    catalog.drop_table(spark, "wattline_defaults")
    assert not spark.catalog.tableExists("wattline_defaults")
