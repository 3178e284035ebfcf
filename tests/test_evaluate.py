import pytest
from pyspark.sql import functions as F

from postmill.operators import evaluate

SCHEMA = "`Job URL` string, Unternehmen string, Boni double, `13. Gehalt` int, Stadt string, Land string, row_no int"


def counts(spark, left, right):
    v, e = spark.createDataFrame(left, SCHEMA), spark.createDataFrame(right, SCHEMA.replace(", Land string", "")) if right and len(right[0]) == 6 else spark.createDataFrame(right, SCHEMA)
    return {(r.scope, r.column_name): r for r in evaluate.compare(v, e).collect()}


def test_cells(spark):
    rows = [(None, None), (None, 1.0), (1.0, None), (0.0, 0.0), (0.0, 1.0), (1.9, 1.0)]
    left = [(f"u{n}?a", "c", v, None, " x ", "l", n) for n, (v, _) in enumerate(rows)]
    right = [(f"u{n}?b", "c", e, None, "x", None, n) for n, (_, e) in enumerate(rows)]
    boni = counts(spark, left, right)["incentive", "Boni"]
    assert (boni.tp, boni.fp, boni.fn, boni.tn) == (2, 2, 2, 1)
    result = counts(spark, left, right)
    stadt, land, gehalt = result["non_incentive", "Stadt"], result["non_incentive", "Land"], result["incentive", "13._Gehalt"]
    assert (stadt.tp, stadt.fp, stadt.fn, stadt.tn) == (6, 0, 0, 0)
    assert (land.tp, land.fp, land.fn, land.tn) == (0, 0, 6, 0)
    assert (gehalt.tn, gehalt.accuracy, gehalt.recall) == (6, 1.0, 1.0)
    everything = result["all", "all"]
    assert everything.tp == 8 and everything.accuracy == pytest.approx(15 / 25) and everything.recall == pytest.approx(8 / 16)


def test_one_sided_rows_and_first_rows(spark):
    left = [("u1", "c", 1.0, None, "a", None, 1), ("u1", "c", 0.0, 1, "b", None, 2), ("u2", None, 1.0, 1, "a", None, 3)]
    right = [("u9", "c", 1.0, None, "z", "l", 1)]
    result = counts(spark, left, right)
    boni, gehalt = result["incentive", "Boni"], result.get(("incentive", "13._Gehalt"))
    assert (boni.tp, boni.fp, boni.fn, boni.tn) == (0, 1, 1, 0)
    assert gehalt is None
    data = evaluate.dataset_counts(spark.createDataFrame(left, SCHEMA), spark.createDataFrame(right, SCHEMA)).first()
    assert tuple(data) == (3, 1, 1, 1, 0, 1, 1)


def test_column_known_to_one_side_only(spark):
    schema = "Job_URL string, Unternehmen string, `Aktienoptionen/Gewinnbeteiligung` int, row_no int"
    left = spark.createDataFrame([("u1", "c", 1, 1), ("u2", "c", 0, 2), ("u3", "c", None, 3)], schema)
    right = spark.createDataFrame([("u1", "c", 1, 1)], schema.replace("/", "_"))
    rows = {(r.scope, r.column_name): r for r in evaluate.compare(left, right).collect()}
    shares = rows["incentive", "Aktienoptionen/Gewinnbeteiligung"]
    assert (shares.tp, shares.fp, shares.fn, shares.tn) == (0, 0, 1, 0)


def test_nothing_to_compare(spark):
    rows = evaluate.with_scores(spark.createDataFrame([(0, 0, 0, 0), (0, 1, 0, 1)], "tp int, fp int, fn int, tn int")).collect()
    assert [(r.accuracy, r.recall) for r in rows] == [(1.0, 1.0), (0.5, 1.0)]


def test_missing_and_unlike_cells(spark):
    """NaN is missing and never overflows; a number and a text are different flags."""
    left = spark.createDataFrame([(1, float("nan"), 1, 1.0), (2, 1.0, 0, float("inf")), (3, None, None, 2.0)], "k int, a double, b int, c double")
    right = spark.createDataFrame([(1, float("nan"), "1", 1.0), (2, 1.0, None, 1.0), (3, float("nan"), None, 2.0)], "k int, a double, b string, c double")
    cells = evaluate.cell_counts(evaluate.reconcile(left, right, ["k"]), ["a", "b", "c"], [])
    found = {r.column_name: (r.tp, r.fp, r.fn, r.tn) for r in cells.collect()}
    assert found == {"a": (1, 0, 0, 2), "b": (0, 1, 2, 1), "c": (2, 1, 1, 0)}


def test_key_sketches(spark):
    keys = spark.range(60_000).select((F.col("id") % 2).alias("side"), (F.shiftright("id", 1) % 25_000 + (F.col("id") % 2) * 5_000).cast("string").alias("key"))
    few = spark.createDataFrame([(0, ""), (0, "a"), (0, "a"), (0, None), (1, "a"), (1, "b")], "side long, key string")
    for rows, want, exact in ((few, (2, 2, 1, 3), True), (keys, (25_000, 25_000, 20_000, 30_000), False)):
        parts = rows.withColumn("part", F.xxhash64("key") % 3).withColumn("portal", F.lit("p"))
        sketches = evaluate.merge_sketches(evaluate.key_sketches(parts, ["portal", "side", "part"], "key"), ["portal", "side"])
        told = evaluate.sketch_overlap(sketches.where("side = 0"), sketches.where("side = 1"), "portal").first()
        got = (told.estimate_a, told.estimate_b, told.estimate_both, told.estimate_either)
        assert all(abs(x - y) <= told.bound for x, y in zip(got, want, strict=True)) and (told.bound == 0) == exact
    one = evaluate.key_sketches(few.withColumn("portal", F.lit("p")), ["portal"], "key")
    alone = evaluate.sketch_overlap(one, one.where("portal = 'q'"), "portal").first()
    assert (alone.estimate_a, alone.estimate_b, alone.estimate_both, alone.estimate_either) == (3, 0, 0, 3)
