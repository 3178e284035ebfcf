"""Keeping the first row of every id of a stream, with what was seen held as keyed state."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from contextlib import contextmanager

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
PROVIDER = "spark.sql.streaming.stateStore.providerClass"


class _FirstRow(StatefulProcessor):
    """Hands on the first row of a key by ``order``, unless an earlier batch had the key. Rows pass in batches, one is held."""

    def __init__(self, order: Sequence[str], columns: Sequence[str], expiry_ms: int | None):
        self.order, self.columns, self.expiry_ms = list(order), list(columns), expiry_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.seen = handle.getValueState("seen", "seen boolean", self.expiry_ms)

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        best = None
        for batch in rows:
            first = batch.sort_values(self.order, kind="stable").iloc[:1]
            best = first if best is None else pd.concat([best, first]).sort_values(self.order, kind="stable").iloc[:1]
        if not self.seen.exists():
            self.seen.update((True,))
            if best is not None:
                yield best[self.columns]

    def close(self) -> None:
        pass


@contextmanager
def _state_on_disk(spark: SparkSession):
    """State in RocksDB while a query starts and runs; the session's own setting afterwards."""
    before = spark.conf.get(PROVIDER, None)
    spark.conf.set(PROVIDER, ROCKSDB)
    try:
        yield
    finally:
        spark.conf.set(PROVIDER, before) if before else spark.conf.unset(PROVIDER)


def first_rows(stream: DataFrame, id_col: str, order: Sequence[str], expiry_ms: int | None = None) -> DataFrame:
    """The stream without rows whose id came before: in an earlier batch, or in the same one and earlier by ``order``.

    Ids are forgotten ``expiry_ms`` after they came, or never. Rows without an id all stay. Work and memory of a batch follow its own rows, not the ids
    ever seen.
    """
    has_id = F.coalesce(F.col(id_col).cast("string"), F.lit("")) != ""
    kept = stream.where(has_id).groupBy(id_col).transformWithStateInPandas(
        _FirstRow(order, stream.columns, expiry_ms), stream.schema, "Append", "ProcessingTime" if expiry_ms else "None"
    )
    return kept.unionByName(stream.where(~has_id))


def keep_first(stream: DataFrame, id_col: str, order: Sequence[str], target: str, checkpoint: str, expiry_ms: int | None = None) -> list[dict]:
    """Append the first row of every new id to a Parquet table of runs, one per batch; returns the progress of the batches.

    The checkpoint holds the state, so that the next call goes on where this one ends. A batch which is repeated writes its run again.
    """

    def batch(rows: DataFrame, batch_id: int) -> None:
        rows.write.mode("overwrite").parquet(f"{target}/run={batch_id}")

    with _state_on_disk(stream.sparkSession):
        query = (
            first_rows(stream, id_col, order, expiry_ms).writeStream.foreachBatch(batch).outputMode("append")
            .option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
        )
        query.awaitTermination()
    return list(query.recentProgress)
