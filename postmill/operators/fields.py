"""Fields derived from canonical postings by rules, as column expressions.

Each function takes and returns a DataFrame and adds the column named in its
``out`` argument. Inputs default to the canonical schema.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from postmill import fixed_values as fv
from postmill.functions import text as tx

NO_TEXTS = "array<string>"
LINES, PARAGRAPHS = "_list_lines", "_paragraph_texts"


def _none() -> Column:
    return F.array().cast(NO_TEXTS)


def item_text(item: Column) -> Column:
    """A list item as text; nested lists in list notation."""
    return F.when(item["is_list"], tx.python_list_text(item["items"])).otherwise(F.get(item["items"], F.lit(0)))


def named_list(name: str) -> Column:
    return F.try_element_at("lists", F.lit(name))


def _lines(df: DataFrame) -> Column:
    """One text per non-empty list, its items joined by blanks; taken from ``with_texts`` where that ran."""
    if LINES in df.columns:
        return F.col(LINES)
    filled = F.filter(F.map_values("lists"), lambda items: F.size(items) > 0)
    return F.transform(filled, lambda items: F.array_join(F.transform(items, item_text), " "))


def _paragraph_texts(df: DataFrame) -> Column:
    """List paragraphs in full; of named sections only those which are lists."""
    if PARAGRAPHS in df.columns:
        return F.col(PARAGRAPHS)
    return (
        F.when(F.col("paragraphs_kind") == "list", F.transform("paragraphs", item_text))
        .when(F.col("paragraphs_kind") == "dict", F.flatten(F.filter("paragraphs", lambda s: s["is_list"])["items"]))
        .otherwise(_none())
    )


def with_texts(df: DataFrame) -> DataFrame:
    """Render lists and paragraphs once, for the readers of both that follow."""
    return df.withColumns({LINES: _lines(df), PARAGRAPHS: _paragraph_texts(df)})


def benefits_text(df: DataFrame, out: str = "benefits_text") -> DataFrame:
    """The benefits list when it holds something, else all paragraphs, one item per line."""
    listed = named_list(fv.BENEFITS_LIST)
    paragraphs = (
        F.when(F.col("paragraphs_kind") == "list", _paragraph_texts(df))
        .when(F.col("paragraphs_kind") == "dict", F.flatten(F.col("paragraphs")["items"]))
        .otherwise(_none())
    )
    return df.withColumn(
        out,
        F.when(F.size(listed) > 0, F.array_join(F.transform(listed, item_text), "\n")).otherwise(
            F.array_join(paragraphs, "\n")
        ),
    )


def direct_benefits(df: DataFrame, out: str = "direct_benefits", benefits: str = "benefits") -> DataFrame:
    """Listed benefits without blanks and placeholders; order and repeats stay."""
    kept = F.filter(benefits, lambda b: (b != "") & (F.lower(b) != fv.NOT_FOUND_BENEFIT))
    return df.withColumn(out, F.coalesce(kept, _none()))


def description(df: DataFrame, out: str = "description") -> DataFrame:
    """Paragraphs, then all lists, joined by blanks."""
    return df.withColumn(out, F.array_join(F.concat(_paragraph_texts(df), _lines(df)), " "))


def search_text(df: DataFrame, out: str = "search_text") -> DataFrame:
    """All lists, then paragraphs, joined by blanks, in lower case."""
    return df.withColumn(out, F.lower(F.array_join(F.concat(_lines(df), _paragraph_texts(df)), " ")))


def job_title(df: DataFrame, out: str = "job_title", title: str = "title") -> DataFrame:
    return df.withColumn(out, tx.or_default(tx.strip(F.col(title)), fv.DEFAULT_TITLE))


def company_items() -> Column:
    """The company list with nested lists opened by one level."""
    return F.flatten(named_list(fv.COMPANY_LIST)["items"])


def company_and_location(df: DataFrame, company: str = "company", location: str = "location") -> DataFrame:
    """Company and place text from either layout; an explicit place text wins."""
    named = F.coalesce(F.col("company_name"), F.lit("")) != ""
    items = company_items()
    place_text = F.col("job_location_text")
    return df.withColumns(
        {
            company: F.when(named, F.col("company_name")).otherwise(F.coalesce(F.get(items, F.lit(0)), F.lit(""))),
            location: F.when(place_text.isNotNull(), drop_postal_code(place_text))
            .when(named, F.lit(""))
            .otherwise(F.coalesce(F.get(items, F.lit(1)), F.lit(""))),
        }
    )


def drop_postal_code(text: Column) -> Column:
    return F.regexp_replace(text, r"(?U)^\d+\s*", "")


def time_models(
    df: DataFrame,
    out: str = "time_models",
    text: str = "search_text",
    synonyms: Mapping[str, Iterable[str]] = fv.TIME_MODELS,
    default: str = fv.DEFAULT_TIME_MODEL,
) -> DataFrame:
    """All labels with a synonym anywhere in the text, sorted; the default when there is none."""
    # arrays put together, not filtered: a filter has its array worked out by the interpreter
    labels = F.concat(
        _none(), *[F.when(tx.contains_any(F.col(text), words), F.array(F.lit(label))).otherwise(_none()) for label, words in sorted(synonyms.items())]
    )
    found = df.withColumn(out, labels)
    return found.withColumn(out, F.when(F.size(out) > 0, F.col(out)).otherwise(F.array(F.lit(default))))


def position(
    df: DataFrame,
    out: str = "position",
    text: str = "search_text",
    synonyms: Mapping[str, Iterable[str]] = fv.POSITIONS,
    default: str = fv.DEFAULT_POSITION,
) -> DataFrame:
    """The first label, in dictionary order, with a synonym as a whole word."""
    label = F.coalesce(
        *[F.when(tx.whole_word_any(F.col(text), words), F.lit(label)) for label, words in synonyms.items()],
        F.lit(default),
    )
    return df.withColumn(out, label)


def employment(
    df: DataFrame,
    out: str = "employment",
    text: str = "search_text",
    synonyms: Iterable[str] = fv.PERMANENT_SYNONYMS,
) -> DataFrame:
    """Permanent when the company entry or the text says so."""
    unnamed = F.coalesce(F.col("company_name"), F.lit("")) == ""
    third = F.get(company_items(), F.lit(2))
    stated = unnamed & F.coalesce(F.contains(third, F.lit(fv.PERMANENT_EMPLOYMENT)), F.lit(False))
    permanent = stated | tx.whole_word_any(F.col(text), synonyms)
    return df.withColumn(out, F.when(permanent, fv.PERMANENT_EMPLOYMENT).otherwise(fv.DEFAULT_EMPLOYMENT))


def remote_flag(df: DataFrame, out: str = "remote") -> DataFrame:
    """1 if the paragraphs or a list, the company entry among them, offer remote work.

    Of named sections only the names are looked at.
    """
    paragraphs = (
        F.when(F.col("paragraphs_kind") == "list", _paragraph_texts(df))
        .when(F.col("paragraphs_kind") == "dict", F.col("paragraphs")["section"])
        .otherwise(_none())
    )
    everything = F.lower(F.concat(F.array_join(paragraphs, " "), F.array_join(_lines(df), "")))
    return df.withColumn(out, F.contains(everything, F.lit(fv.REMOTE_PHRASE)).cast("int"))


def company_size_raw(df: DataFrame, out: str = "size_raw") -> DataFrame:
    """Last entry of the first company-info list which ends in a text."""
    usable = F.filter(
        named_list(fv.COMPANY_INFO_LIST), lambda item: item["is_list"] & item["ends_in_text"] & (F.size(item["items"]) > 0)
    )
    value = F.try_element_at(F.get(usable, F.lit(0))["items"], F.lit(-1))
    return df.withColumn(out, F.coalesce(value, F.lit(fv.DEFAULT_SIZE)))


def size_bucket(df: DataFrame, out: str = "size_bucket", size: str = "size_raw", thousands: str = ",") -> DataFrame:
    """Bucket of the largest number in the text.

    ``thousands`` lists the marks dropped from inside numbers. A full stop is not
    among them by default, so ``10.000`` reads as 10 and 0.
    """
    text = F.translate(F.col(size), thousands, "")
    runs = F.regexp_extract_all(text, F.lit("0*([0-9]+)"), F.lit(1))
    too_long = F.lit("9" * 38).cast("decimal(38,0)")
    numbers = F.transform(runs, lambda r: F.coalesce(r.try_cast("decimal(38,0)"), too_long))
    with_number = df.withColumn("_largest", F.array_max(numbers))
    largest = F.col("_largest")
    bucket = F.lit(fv.DEFAULT_SIZE)
    for low, high, label in reversed(fv.SIZE_BUCKETS):
        inside = largest > low if high is None else (largest > low) & (largest <= high)
        bucket = F.when(inside, F.lit(label)).otherwise(bucket)
    return with_number.withColumn(out, bucket).drop("_largest")


def portal(df: DataFrame, out: str = "portal", url: str = "url") -> DataFrame:
    """Name of the site a URL points to."""
    by_www, by_com = fv.PORTAL_BY_WWW, fv.PORTAL_BY_COM
    u = F.col(url)
    return df.withColumn(
        out,
        F.when(u.rlike(by_www), F.regexp_extract(u, by_www, 1))
        .when(u.rlike(by_com), F.regexp_extract(u, by_com, 1))
        .otherwise(F.lit(fv.UNKNOWN_PORTAL)),
    )


_CLOCK = r"(?:[01]\d|2[0-3])(?::[0-5]\d(?::[0-5]\d(?:\.\d{3}(?:\d{3})?)?)?)?"
_OFFSET = r"[+-](?:[01]\d|2[0-3]):[0-5]\d(?::[0-5]\d(?:\.\d{6})?)?"
ISO_DATE_TIME = rf"^(?!0000)\d{{4}}-\d{{2}}-\d{{2}}(?:.{_CLOCK}(?:{_OFFSET})?)?$"


def posting_date(
    df: DataFrame, as_of: str | Column | None = None, out: str = "posting_date", date: str = "date_posted"
) -> DataFrame:
    """``dd.MM.yyyy`` in the text's own offset; the day ``as_of`` when it is no ISO date.

    No session time zone is involved.
    """
    if as_of is None:
        as_of = F.current_date()
    fallback = F.date_format(F.lit(as_of).cast("date") if isinstance(as_of, str) else as_of, "dd.MM.yyyy")
    text = F.replace(F.col(date), F.lit("Z"), F.lit("+00:00"))
    day = F.substring(text, 1, 10)
    valid = text.rlike(ISO_DATE_TIME) & day.try_cast("date").isNotNull()
    shown = F.concat_ws(".", F.substring(text, 9, 2), F.substring(text, 6, 2), F.substring(text, 1, 4))
    return df.withColumn(out, F.when(F.coalesce(valid, F.lit(False)), shown).otherwise(fallback))


def either_flag(a: Column, b: Column) -> Column:
    """1 if one of two flags is set."""
    return F.greatest(F.coalesce(a, F.lit(0)), F.coalesce(b, F.lit(0)))


def rule_fields(df: DataFrame, as_of: str | Column | None = None) -> DataFrame:
    """All fields which need nothing but the posting itself."""
    rendered = LINES in df.columns
    df = df if rendered else with_texts(df)
    for step in (search_text, job_title, company_and_location, time_models, position, employment, remote_flag,
                 company_size_raw, size_bucket, portal):
        df = step(df)
    df = posting_date(df, as_of)
    return df if rendered else df.drop(LINES, PARAGRAPHS)
