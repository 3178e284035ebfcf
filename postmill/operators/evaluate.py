"""Comparing an export with a labelled table, cell by cell."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from postmill import fixed_values as fv
from postmill.functions.names import named
from postmill.functions import text as tx
from postmill.operators.joins import first_per_key
from postmill.sources.tables import underscore_names

KEY = ["Unternehmen", "url_key"]
FLAGS, TEXTS = "incentive", "non_incentive"
COUNTERS = ["tp", "fp", "fn", "tn"]


def with_url_key(df: DataFrame, url: str = "Job_URL", out: str = "url_key") -> DataFrame:
    return df.withColumn(out, tx.url_key(F.col(url)))


def first_rows(df: DataFrame, key: Sequence[str] = KEY, row_no: str = "row_no") -> DataFrame:
    """The first row, in file order, of every key; rows with a NULL in the key are left out."""
    whole = df.dropna(subset=list(key))
    return first_per_key(whole, key, [row_no])


def reconcile(left: DataFrame, right: DataFrame, key: Sequence[str] = KEY) -> DataFrame:
    """Full join of two tables with one row per key.

    Values become the structs ``l`` and ``r``; the struct of an absent side is NULL.
    """
    a = left.select(*key, F.struct(*[named(c) for c in left.columns if c not in key]).alias("l"))
    b = right.select(*key, F.struct(*[named(c) for c in right.columns if c not in key]).alias("r"))
    return a.join(b, list(key), "full_outer")


def keys_in_both(left: DataFrame, right: DataFrame, key: Sequence[str] = KEY) -> DataFrame:
    """Distinct keys of both tables. Both sides lose their repeats before the shuffle."""
    return left.select(*key).distinct().intersect(right.select(*key).distinct())


def keys_only_left(left: DataFrame, right: DataFrame, key: Sequence[str] = KEY) -> DataFrame:
    return left.select(*key).distinct().subtract(right.select(*key).distinct())


def _same_flag(a: Column, b: Column, numbers: bool) -> Column:
    return a.try_cast("bigint") == b.try_cast("bigint") if numbers else a.cast("string") == b.cast("string")


def _filled(value: Column, kind: T.DataType) -> Column:
    """A cell, NULL where it is missing: NaN is missing, too."""
    return F.when(~F.isnan(value), value) if isinstance(kind, (T.FloatType, T.DoubleType)) else value


def _same_text(a: Column, b: Column) -> Column:
    a, b = a.cast("string"), b.cast("string")
    return (a == b) | (tx.strip(a) == tx.strip(b))


def cell_counts(
    pairs: DataFrame, flags: Sequence[str] = fv.EVALUATED_FLAGS, texts: Sequence[str] = fv.EVALUATED_TEXTS
) -> DataFrame:
    """``(scope, column_name, tp, fp, fn, tn)`` over the rows of ``reconcile``.

    All cells are counted by one aggregation over the joined rows, without
    unpivoting them; only its single row is turned into one row per column.
    """
    left = {f.name: f.dataType for f in pairs.schema["l"].dataType.fields}
    right = {f.name: f.dataType for f in pairs.schema["r"].dataType.fields}
    here, there = F.col("l").isNotNull(), F.col("r").isNotNull()
    columns = [(FLAGS, c) for c in flags if c in left or c in right]
    columns += [(TEXTS, c) for c in texts if c in left or c in right]
    sums = []
    for n, (scope, name) in enumerate(columns):
        a = _filled(F.col("l")[name], left[name]) if name in left else None
        b = _filled(F.col("r")[name], right[name]) if name in right else None
        tp = fp = fn = tn = F.lit(False)
        if a is not None and b is not None:
            numbers = [isinstance(side[name], T.NumericType) for side in (left, right)]
            if scope == TEXTS:
                same = _same_text(a, b)
            elif numbers[0] == numbers[1]:
                same = _same_flag(a, b, numbers[0])
            else:
                same = F.lit(False)  # a number and a text are different flags
            same = F.coalesce(same, F.lit(False))
            tp = same
            tn = here & there & a.isNull() & b.isNull()
            fp = b.isNotNull() & ~same
            fn = a.isNotNull() & ~same
        elif a is not None:
            fn = a.isNotNull() & ~there
        else:
            fp = b.isNotNull() & ~here
        sums += [F.count_if(test).alias(f"{c}{n}") for c, test in zip(COUNTERS, (tp, fp, fn, tn))]
    cells = F.array(
        *[
            F.struct(
                F.lit(scope).alias("scope"), F.lit(name).alias("column_name"), *[F.col(f"{c}{n}").alias(c) for c in COUNTERS]
            )
            for n, (scope, name) in enumerate(columns)
        ]
    )
    return pairs.agg(*sums).select(F.explode(cells).alias("c")).select("c.*")


def roll_up(cells: DataFrame) -> DataFrame:
    """Counters for everything, per scope and per column, in one pass.

    Totals have ``all`` in place of the name they run over. Columns which never
    counted anything are left out.
    """
    rolled = cells.rollup("scope", "column_name").agg(*[F.sum(c).alias(c) for c in COUNTERS])
    named = rolled.select(
        F.coalesce("scope", F.lit("all")).alias("scope"), F.coalesce("column_name", F.lit("all")).alias("column_name"), *COUNTERS
    )
    total = F.col("tp") + F.col("fp") + F.col("fn") + F.col("tn")
    return named.where((total > 0) | (F.col("column_name") == "all"))


def with_scores(counts: DataFrame) -> DataFrame:
    """Adds accuracy and recall; 1.0 where there is nothing to divide by."""
    everything = F.col("tp") + F.col("fp") + F.col("fn") + F.col("tn")
    relevant = F.col("tp") + F.col("fn")
    return counts.withColumns(
        {
            "accuracy": F.when(everything > 0, (F.col("tp") + F.col("tn")) / everything).otherwise(F.lit(1.0)),
            "recall": F.when(relevant > 0, F.col("tp") / relevant).otherwise(F.lit(1.0)),
        }
    )


def prepare(df: DataFrame) -> DataFrame:
    """Column names and URL key as the comparison needs them."""
    return with_url_key(underscore_names(df))


def compare(
    validation: DataFrame,
    export: DataFrame,
    flags: Sequence[str] = fv.EVALUATED_FLAGS,
    texts: Sequence[str] = fv.EVALUATED_TEXTS,
    row_no: str = "row_no",
) -> DataFrame:
    """Counters with accuracy and recall of an export against the labelled rows."""
    wanted = [*KEY, *flags, *texts, row_no]

    def side(df: DataFrame) -> DataFrame:
        df = prepare(df)
        return first_rows(df.select(*[named(c) for c in df.columns if c in wanted]), KEY, row_no)

    return with_scores(roll_up(cell_counts(reconcile(side(validation), side(export)), flags, texts)))


def dataset_counts(validation: DataFrame, export: DataFrame) -> DataFrame:
    """Rows and distinct keys of both tables, and how their keys overlap, as one row."""
    v, e = prepare(validation).select(*KEY), prepare(export).select(*KEY)
    zero = F.lit(0)

    def marks(df: DataFrame, is_export: int) -> DataFrame:
        return df.select(*KEY, F.lit(1 - is_export).alias("v"), F.lit(is_export).alias("e"))

    per_key = (
        marks(v, 0).unionAll(marks(e, 1)).groupBy(*KEY).agg(F.sum("v").alias("v"), F.sum("e").alias("e"))
    )
    whole = F.col("Unternehmen").isNotNull() & F.col("url_key").isNotNull()
    in_v, in_e = whole & (F.col("v") > 0), whole & (F.col("e") > 0)
    return per_key.agg(
        F.coalesce(F.sum("v"), zero).cast("bigint").alias("validation_rows"),
        F.coalesce(F.sum("e"), zero).cast("bigint").alias("export_rows"),
        F.count_if(in_v).alias("validation_keys"),
        F.count_if(in_e).alias("export_keys"),
        F.count_if(in_v & in_e).alias("common_keys"),
        F.count_if(in_v & ~in_e).alias("validation_only"),
        F.count_if(in_e & ~in_v).alias("export_only"),
    )


def history_rows(scores: DataFrame, run_ts: str | Column) -> DataFrame:
    """Scores as ``(run_ts, scope, column_name, metric, value)``."""
    stamp = F.lit(run_ts) if isinstance(run_ts, str) else run_ts
    metrics = F.array(*[F.struct(F.lit(m).alias("metric"), F.col(m).alias("value")) for m in ("accuracy", "recall")])
    return scores.select(stamp.alias("run_ts"), "scope", "column_name", F.explode(metrics).alias("m")).select(
        "run_ts", "scope", "column_name", "m.metric", "m.value"
    )


def history_wide(
    history: DataFrame, flags: Sequence[str] = fv.EVALUATED_FLAGS, texts: Sequence[str] = fv.EVALUATED_TEXTS
) -> DataFrame:
    """One row per run with a column per figure; figures a run lacks are NULL.

    Figures of the given columns come first, then those of any other column in the history, in order of name.
    """
    names = [f"{n}_{m}" for n in ("overall", FLAGS, TEXTS, *flags, *texts) for m in ("accuracy", "recall")]
    name = F.when(F.col("scope") == "all", F.lit("overall")).when(
        F.col("column_name") == "all", F.col("scope")
    ).otherwise(F.col("column_name"))
    figures = history.select("run_ts", F.concat_ws("_", name, "metric").alias("figure"), "value")
    others = figures.select("figure").where(~F.col("figure").isin(names)).distinct().orderBy("figure").collect()
    return figures.groupBy("run_ts").pivot("figure", [*names, *[r.figure for r in others]]).agg(F.max("value"))


SKETCH_BITS = 12


def key_sketches(rows: DataFrame, by: Sequence[str], key: str) -> DataFrame:
    """A Theta sketch of the distinct keys of every group: at most ``2 ** SKETCH_BITS`` hashes each, whatever the number of keys.

    Sketches of further runs or portals are merged with ``merge_sketches``, without the keys.
    """
    # a sketch takes no notice of empty texts, so each key gets a mark
    marked = F.concat(F.lit("="), F.col(key).cast("string"))
    return rows.where(F.col(key).isNotNull()).groupBy(*by).agg(F.theta_sketch_agg(marked, SKETCH_BITS).alias("sketch"))


def merge_sketches(sketches: DataFrame, by: Sequence[str]) -> DataFrame:
    """One sketch per group from those of its parts: the keys in any of them."""
    return sketches.groupBy(*by).agg(F.theta_union_agg("sketch", SKETCH_BITS).alias("sketch"))


def sketch_overlap(a: DataFrame, b: DataFrame, on: str) -> DataFrame:
    """Estimates of the keys of both sides, of those in both and in either, with a bound on the error.

    A sketch of up to ``2 ** SKETCH_BITS`` keys is exact. Beyond, the bound is four standard errors of the union: ``4 n / sqrt(2 ** SKETCH_BITS - 1)``.
    """
    met = a.select(F.col(on), F.col("sketch").alias("_a")).join(b.select(F.col(on), F.col("sketch").alias("_b")), on, "full")
    estimate = lambda s: F.coalesce(F.theta_sketch_estimate(s), F.lit(0)).cast("long")
    either = F.coalesce(estimate(F.theta_union(F.col("_a"), F.col("_b"), F.lit(SKETCH_BITS))), F.lit(0))
    told = met.select(
        on, estimate(F.col("_a")).alias("estimate_a"), estimate(F.col("_b")).alias("estimate_b"),
        estimate(F.theta_intersection(F.col("_a"), F.col("_b"))).alias("estimate_both"),
        F.greatest(either, estimate(F.col("_a")), estimate(F.col("_b"))).alias("estimate_either"),
    )
    size = 2**SKETCH_BITS
    bound = F.when(F.col("estimate_either") < size, F.lit(0.0)).otherwise(4 * F.col("estimate_either") / F.lit(float(size - 1) ** 0.5))
    return told.withColumn("bound", bound)
