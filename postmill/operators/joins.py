"""Look-ups which hold up under hot keys, and key-wise selection of rows."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

ROWS_PER_TASK = 1_000_000
NULL_SPREAD = 4096
BROADCAST_ROWS = 1_000_000


def lookup_by_key(
    facts: DataFrame,
    key: str,
    answer: Callable[[DataFrame], DataFrame],
    spread_by: Sequence[str],
    counted: DataFrame | None = None,
    rows_per_task: int = ROWS_PER_TASK,
) -> DataFrame:
    """Left-join ``facts`` with an answer worked out once per distinct key.

    ``answer`` gets one row per distinct key and must keep all columns it is
    given; it adds the looked-up columns. Counting the keys, with a partial
    aggregation before its shuffle, gives both the distinct keys and the exact
    size of every key. Keys with more than ``rows_per_task`` rows are split over
    as many salts as they need. Only those keys are broadcast, and there can be
    no more of them than rows / ``rows_per_task``. The salt is a hash of columns
    which tell rows apart, so a retried task deals its rows out the same way.

    ``counted`` may name a cheaper table with the same keys to count.
    """
    counts = (
        (facts if counted is None else counted)
        .where(F.col(key).isNotNull())
        .groupBy(key)
        .agg(F.count(F.lit(1)).alias("_rows"))
    )
    salts = F.ceil(F.col("_rows") / F.lit(rows_per_task)).cast("int")
    hot = counts.where(F.col("_rows") > rows_per_task).select(F.col(key).alias("_hot_key"), salts.alias("_salts"))
    answers = (
        answer(counts)
        .withColumn("_salt", F.explode(F.sequence(F.lit(0), salts - 1)))
        .drop("_rows")
        .withColumnRenamed(key, "_answer_key")
    )
    spread = F.xxhash64(*spread_by)
    salt = (
        F.when(F.col(key).isNull(), F.pmod(spread, F.lit(NULL_SPREAD)).cast("int"))
        .when(F.col("_salts").isNull(), F.lit(0))
        .otherwise(F.pmod(spread, F.col("_salts")).cast("int"))
    )
    dealt = facts.join(F.broadcast(hot), F.col(key) == F.col("_hot_key"), "left").withColumn("_fact_salt", salt)
    joined = dealt.join(
        answers, (F.col(key) == F.col("_answer_key")) & (F.col("_fact_salt") == F.col("_salt")), "left"
    )
    return joined.drop("_hot_key", "_salts", "_fact_salt", "_salt", "_answer_key")


def join_small(
    facts: DataFrame, small: DataFrame, on: str | Sequence[str], max_rows: int = BROADCAST_ROWS, how: str = "left"
) -> DataFrame:
    """Join with a side which is usually small: broadcast after its rows were counted, else a plain join.

    ``small`` should be a written table, since it is read for the count and for the join.
    """
    fits = small.limit(max_rows + 1).count() <= max_rows
    return facts.join(F.broadcast(small) if fits else small, on if isinstance(on, str) else list(on), how)


def first_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column | str], k: int = 1) -> DataFrame:
    """The first ``k`` rows of every key.

    A row number which is filtered at once lets Spark keep only ``k`` rows per
    key and map task before the shuffle, so that a hot key shrinks to as many
    rows as there are map tasks.
    """
    ranked = df.withColumn("_rn", F.row_number().over(Window.partitionBy(*keys).orderBy(*order)))
    return ranked.where(F.col("_rn") <= k).drop("_rn")


def skip_known(df: DataFrame, known_ids: DataFrame, order: Sequence[str], id_col: str = "_id") -> DataFrame:
    """Rows whose id is new; of repeats of an id only the first.

    Rows without an id are always kept: each gets a key of its own from the
    ``order`` columns, which must tell rows apart, so they neither meet nor pile up
    in one task. The repeats go first, so that the look-up in the known ids uses
    the same shuffle and sees every id once.
    """
    known_col = known_ids.columns[0]
    has_id = F.coalesce(F.col(id_col), F.lit("")) != ""
    own = F.concat_ws("\u0001", F.lit("row"), *[F.col(c).cast("string") for c in order])
    keyed = df.withColumn("_key", F.when(has_id, F.concat_ws("\u0001", F.lit("id"), id_col)).otherwise(own))
    fresh = first_per_key(keyed, ["_key"], list(order))
    known = known_ids.select(F.concat_ws("\u0001", F.lit("id"), F.col(known_col)).alias("_key")).distinct()
    return fresh.join(known, "_key", "left_anti").drop("_key")


def run_counters(scanned: DataFrame, fresh: DataFrame) -> DataFrame:
    """Documents scanned, processed and skipped, as one row."""
    both = scanned.select(F.lit(1).alias("scanned"), F.lit(0).alias("new")).unionAll(
        fresh.select(F.lit(0).alias("scanned"), F.lit(1).alias("new"))
    )
    return both.agg(
        F.coalesce(F.sum("scanned"), F.lit(0)).cast("bigint").alias("total_jobs"),
        F.coalesce(F.sum("new"), F.lit(0)).cast("bigint").alias("new_jobs"),
    ).withColumn("skipped_jobs", F.col("total_jobs") - F.col("new_jobs"))
