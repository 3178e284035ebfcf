"""Nested country → state → city lookup data as a flat table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

NESTED = "name string, states array<struct<name:string, cities:array<struct<name:string>>>>"


def read_nested(spark: SparkSession, path: str) -> DataFrame:
    """Countries of a JSON file which holds one array; ``country_ord`` is the file order."""
    countries = spark.read.schema(NESTED).option("multiLine", True).json(path)
    return countries.withColumn("country_ord", F.monotonically_increasing_id())


def flatten(nested: DataFrame) -> DataFrame:
    """``(city, state, country, ord)`` where ``ord`` orders rows as the nested data does."""
    states = nested.select(
        F.col("name").alias("country"), "country_ord", F.posexplode("states").alias("state_ord", "s")
    )
    cities = states.select(
        "country", "country_ord", "state_ord", F.col("s.name").alias("state"), F.posexplode("s.cities").alias("city_ord", "c")
    )
    return cities.select(
        F.col("c.name").alias("city"),
        "state",
        "country",
        F.struct("country_ord", "state_ord", "city_ord").alias("ord"),
    )
