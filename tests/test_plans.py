"""Physical plans: what must and must not be in them."""

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from postmill.operators import fields, geo
from postmill.operators.joins import first_per_key, lookup_by_key, skip_known
from postmill.plans import fixtures as fx


def plan(df) -> str:
    return df._jdf.queryExecution().explainString(
        df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("simple")
    )


WRITING = {"table_scan", "score_log", "upsert", "export_csv", "metric_history", "stream_incremental", "load_postings", "vector_cosine"}


@pytest.mark.parametrize("name", sorted(set(entry.queries()) - WRITING))
def test_no_pairs_are_made(spark, sf_dir, name):
    text = plan(entry.queries()[name](spark, sf_dir))
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text
    assert "BatchEvalPython" not in text


def test_only_needed_columns_are_read(spark, sf_dir):
    text = plan(entry.queries()["postings_by_portal"](spark, sf_dir))
    assert "o_orderpriority" not in text and "o_orderdate" not in text and "c_mktsegment" not in text


def test_hot_keys_shrink_before_the_shuffle(spark):
    df = spark.range(100).withColumns({"k": F.col("id") % 3, "_id": F.col("id").cast("string")})
    for text in (plan(first_per_key(df, ["k"], ["id"])), plan(skip_known(df, df.select("_id"), ["id"]))):
        assert text.count("WindowGroupLimit") == 2
        shuffle = text.index("Exchange hashpartitioning")
        assert text.index("WindowGroupLimit") < shuffle < text.rindex("WindowGroupLimit")


def test_skip_known_shuffles_the_rows_once(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        df = spark.range(100).withColumns({"_id": F.col("id").cast("string"), "text": F.lit("x")})
        text = plan(skip_known(df, spark.range(5).select(F.col("id").cast("string").alias("x")), ["id"]))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "SortMergeJoin" in text and text.count("Exchange hashpartitioning") == 2


def test_explode_infers_no_filter(spark, sf_dir):
    p = geo.explode_places(geo.place_names(fields.company_and_location(fx.postings(spark, sf_dir))))
    assert "Filter (size(" not in plan(p) and "Filter ((size(" not in plan(p)


def test_only_hot_keys_are_broadcast_by_hint(spark):
    facts = spark.range(1000).withColumn("k", (F.col("id") % 7).cast("string"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        found = lookup_by_key(facts, "k", lambda keys: keys.withColumn("v", F.upper("k")), ["id"], rows_per_task=50)
        text = plan(found)
        assert text.count("BroadcastHashJoin") == 1 and text.count("SortMergeJoin") == 1
        assert "> 50" in text and found.where("v IS NULL").count() == 0 and found.count() == 1000
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
