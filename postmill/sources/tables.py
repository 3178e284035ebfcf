"""Existence checks, small files and scans of written tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _file_system(spark: SparkSession, path: str):
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()), where


def table_exists(spark: SparkSession, path: str) -> bool:
    """True if there is such a path: one call of its file system, nothing is read."""
    files, where = _file_system(spark, path)
    return files.exists(where)


def list_names(spark: SparkSession, path: str) -> list[str]:
    """Names in a folder, none if there is no such folder."""
    files, where = _file_system(spark, path)
    return sorted(s.getPath().getName() for s in files.listStatus(where)) if files.exists(where) else []


def delete_path(spark: SparkSession, path: str) -> None:
    """Remove a file, or a folder with all in it; its name must be the job's own."""
    files, where = _file_system(spark, path)
    files.delete(where, True)


def read_text(spark: SparkSession, path: str) -> str:
    """A small file as text."""
    files, where = _file_system(spark, path)
    stream = files.open(where)
    try:
        return bytes(stream.readAllBytes()).decode()
    finally:
        stream.close()


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """Write a small file."""
    files, where = _file_system(spark, path)
    stream = files.create(where, True)
    try:
        stream.write(bytearray(text.encode()))
    finally:
        stream.close()


def rename_path(spark: SparkSession, source: str, target: str) -> None:
    """Give a file its name; a file of that name is replaced."""
    files, where = _file_system(spark, source)
    to = _file_system(spark, target)[1]
    context = spark._jvm.org.apache.hadoop.fs.FileContext.getFileContext(where.getFileSystem(spark._jsc.hadoopConfiguration()).getUri(), spark._jsc.hadoopConfiguration())
    replace = spark.sparkContext._gateway.new_array(spark._jvm.org.apache.hadoop.fs.Options.Rename, 1)
    replace[0] = spark._jvm.org.apache.hadoop.fs.Options.Rename.OVERWRITE
    context.rename(files.makeQualified(where), files.makeQualified(to), replace)


def spread(df: DataFrame) -> DataFrame:
    """Deal the rows of a small scan out over all cores; a scan of many splits is left as it is.

    Only the number of splits is asked for; nothing is read. A large table has
    more splits than there are cores and so never pays for this shuffle.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores // 2 else df


def read_csv(spark: SparkSession, path: str, schema: T.StructType | str | None = None) -> DataFrame:
    """CSV with a header line; types are inferred only when no schema is given.

    An empty cell is missing, whether it was NULL or an empty text when written.
    """
    reader = spark.read.option("header", True).option("multiLine", True).option("escape", '"')
    return reader.schema(schema).csv(path) if schema else reader.option("inferSchema", True).csv(path)


def with_row_no(df: DataFrame, out: str = "row_no") -> DataFrame:
    """Number rows of a scan in file order, with gaps; no shuffle and no single task."""
    return df.withColumn(out, F.monotonically_increasing_id())


def underscore_names(df: DataFrame) -> DataFrame:
    """Blanks in column names become underscores."""
    return df.toDF(*[c.replace(" ", "_") for c in df.columns])
