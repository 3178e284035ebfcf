"""The load job over a stream of landed files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from postmill.operators.joins import skip_known
from postmill.plans.load import LoadInputs, load
from postmill.sinks.result_table import create


def read_landed(spark: SparkSession, folder: str, collection: str, max_files: int | None = None) -> DataFrame:
    """A stream of JSON lines from a folder which files keep arriving in."""
    reader = spark.readStream
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.text(folder).select(F.col("value").alias("doc"), F.lit(collection).alias("collection"))


def load_available(
    stream: DataFrame, table: str, checkpoint: str, inputs: LoadInputs, first_run: int = 1, log_path: str | None = None
) -> None:
    """Load everything that has arrived since the last call, then stop.

    The checkpoint holds which files are done; a batch which is repeated after a
    failure writes its own run again, so the table does not change. A new checkpoint
    counts batches from 0 again: give it a ``first_run`` above the runs of the table.
    """
    create(stream.sparkSession, table)

    def batch(documents: DataFrame, batch_id: int) -> None:
        load(documents.sparkSession, documents, table, first_run + batch_id, inputs, log_path)

    query = (
        stream.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    )
    query.awaitTermination()


def keep_new(stream: DataFrame, id_col: str, order: list[str], target: str, checkpoint: str) -> None:
    """Append the first row of every id not seen in any earlier batch; unbounded horizon.

    ``target`` is a Parquet table of runs, one per batch; rows without an id are always kept.
    """

    def batch(rows: DataFrame, batch_id: int) -> None:
        spark = rows.sparkSession
        schema = T.StructType(rows.schema.fields + [T.StructField("run", T.LongType())])
        spark.createDataFrame([], rows.schema).write.mode("ignore").parquet(f"{target}/run=-1")
        done = spark.read.schema(schema).parquet(target).where(F.col("run") < batch_id)
        fresh = skip_known(rows, done.select(id_col), order, id_col)
        fresh.write.mode("overwrite").parquet(f"{target}/run={batch_id}")

    query = (
        stream.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    )
    query.awaitTermination()


def keep_new_within(stream: DataFrame, id_col: str, time_col: str, delay: str) -> DataFrame:
    """Bounded form: repeats are dropped only while the watermark still holds their id."""
    return stream.withWatermark(time_col, delay).dropDuplicatesWithinWatermark([id_col])
