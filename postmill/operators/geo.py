"""Place names: cleaning, splitting, and resolution against a gazetteer."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from postmill import fixed_values as fv
from postmill.functions import text as tx
from postmill.operators.fields import drop_postal_code
from postmill.operators.joins import ROWS_PER_TASK, first_per_key, lookup_by_key

PLACE_VALUES = ["state", "country"]


def normalise_places(text: Column) -> Column:
    """Separators become commas; remarks and brackets go; blanks around commas are set right."""
    text = F.regexp_replace(text, fv.PLACE_SEPARATORS, ", ")
    text = F.regexp_replace(text, fv.PLACE_REMARK, "")
    text = F.regexp_replace(text, fv.PLACE_BRACKETS, "")
    return tx.strip(F.regexp_replace(text, fv.PLACE_COMMA, ", "))


def split_places(text: Column) -> Column:
    """Split at commas outside brackets; the empty text gives one empty name."""
    return F.split(text, fv.PLACE_SPLIT, -1)


def place_names(df: DataFrame, location: str = "location", out: str = "places") -> DataFrame:
    """The clean single names of a location text, in order."""
    names = split_places(normalise_places(F.col(location)))
    return df.withColumn(out, F.transform(names, lambda n: drop_postal_code(tx.squeeze(n))))


def translation_table(translations: DataFrame) -> DataFrame:
    """``(src, dst, lang_pair)`` with one row per source text and direction."""
    return translations.groupBy("src", "lang_pair").agg(F.min("dst").alias("dst"))


def translate(df: DataFrame, column: str, translations: DataFrame, lang_pair: str, out: str) -> DataFrame:
    """Dictionary translation; a text without an entry stays as it is."""
    table = translations.where(F.col("lang_pair") == lang_pair).select(F.col("src").alias("_src"), F.col("dst").alias("_dst"))
    return (
        df.join(table, F.col(column) == F.col("_src"), "left")
        .withColumn(out, F.coalesce("_dst", column))
        .drop("_src", "_dst")
    )


def gazetteer_index(
    gazetteer: DataFrame,
    translations: DataFrame,
    home: str = fv.HOME_COUNTRY,
    home_label: str = fv.HOME_COUNTRY_LABEL,
    state_names: Mapping[str, str] = fv.STATE_NAMES,
) -> DataFrame:
    """One row per lower-case city: home country first, then file order.

    Holds the names to show for a direct hit (``state``, ``country``) and for a
    hit by a translated city (``state_2``, ``country_2``), which are translated
    once more. All naming is done here, once per gazetteer, not per posting.
    """
    translations = translation_table(translations)
    best = first_per_key(
        gazetteer.withColumns({"city_key": F.lower("city"), "_away": F.col("country") != home}), ["city_key"], ["_away", "ord"]
    ).select("city_key", "_away", F.col("state").alias("raw_state"), F.col("country").alias("raw_country"))
    named = translate(best, "raw_state", translations, "en>de", "_state")
    named = translate(named, "raw_country", translations, "en>de", "_country")
    named = named.withColumns(
        {
            "state": F.coalesce(tx.lookup(state_names, F.col("raw_state")), F.col("_state")),
            "country": F.when(F.col("_away"), F.col("_country")).otherwise(F.lit(home_label)),
        }
    )
    named = translate(named, "state", translations, "en>de", "state_2")
    named = translate(named, "country", translations, "en>de", "country_2")
    return named.select("city_key", "state", "country", "state_2", "country_2")


def resolve_names(names: DataFrame, index: DataFrame, translations: DataFrame, name: str = "place") -> DataFrame:
    """State and country for distinct place names: as written, else translated, else unresolved."""
    direct = index.select("city_key", F.col("state").alias("_s1"), F.col("country").alias("_c1"))
    second = index.select(
        F.col("city_key").alias("_city_key_2"), F.col("state").alias("_hit"),
        F.col("state_2").alias("_s2"), F.col("country_2").alias("_c2"),
    )
    found = names.join(direct, F.lower(name) == F.col("city_key"), "left")
    found = translate(found, name, translation_table(translations), "de>en", "_english")
    found = found.join(second, F.lower("_english") == F.col("_city_key_2"), "left")
    hit_1 = F.coalesce(F.col("_s1") != fv.UNKNOWN_PLACE, F.lit(False))
    hit_2 = F.coalesce(F.col("_hit") != fv.UNKNOWN_PLACE, F.lit(False))
    nation_wide = F.lower(name) == fv.NATION_WIDE

    def pick(whole: str, first: str, other: str) -> Column:
        return (
            F.when(nation_wide, F.lit(whole)).when(hit_1, F.col(first)).when(hit_2, F.col(other))
            .otherwise(F.lit(fv.UNRESOLVED_PLACE))
        )

    return found.withColumns(
        {"state": pick(fv.NATION_WIDE, "_s1", "_s2"), "country": pick(fv.NATION_WIDE_COUNTRY, "_c1", "_c2")}
    ).drop("city_key", "_city_key_2", "_s1", "_c1", "_s2", "_c2", "_hit", "_english")


def resolve_places(
    rows: DataFrame,
    index: DataFrame,
    translations: DataFrame,
    spread_by: Sequence[str],
    place: str = "place",
    counted: DataFrame | None = None,
    rows_per_task: int = ROWS_PER_TASK,
) -> DataFrame:
    """Adds state and country to rows with one place each; every distinct name is resolved once."""
    return lookup_by_key(
        rows, place, lambda names: resolve_names(names, index, translations, place), spread_by, counted, rows_per_task
    )


def explode_places(df: DataFrame, places: str = "places") -> DataFrame:
    """One row per place of a posting, with its position.

    The outer form: the plain one makes Spark infer a filter on the array, which
    it pushes below and works the whole place text out once more. A place array
    is never empty, so the rows are the same.
    """
    return df.select("*", F.posexplode_outer(places).alias("place_pos", "place")).drop(places)


def known_cities(names: DataFrame, gazetteer: DataFrame, name: str = "place") -> DataFrame:
    """Rows whose name is a city of the gazetteer, without regard to case and accents."""
    cities = gazetteer.select(tx.fold(F.col("city")).alias("_city")).distinct()
    return names.join(cities, tx.fold(F.col(name)) == F.col("_city"), "left_semi")


def distinct_values(resolved: DataFrame, by: Sequence[str]) -> DataFrame:
    """Distinct states and countries per posting, sorted and joined."""
    return resolved.groupBy(*by).agg(
        *[F.array_join(F.array_sort(F.collect_set(c)), ", ").alias(f"{c}_list") for c in PLACE_VALUES]
    )
