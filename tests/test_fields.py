"""Literal edge cases of the field rules."""

import pytest
from pyspark.sql import functions as F

from postmill import fixed_values as fv
from postmill.functions import text as tx
from postmill.operators import fields, prompts
from postmill.sources.collections import canonical


def texts(spark, *values):
    return spark.createDataFrame([(n, v) for n, v in enumerate(values)], "n int, t string").coalesce(1).orderBy("n")


def column(df, name):
    return [row[name] for row in df.orderBy("n").select(name).collect()]


def test_size_bucket(spark):
    df = texts(spark, "51-250", "1,000", "10.000", "0", "k. A.", "10001", "9" * 45, "0" * 45 + "7", "2500", "2501")
    assert column(fields.size_bucket(df, size="t"), "size_bucket") == [
        "51-250", "501-1000", "0-10", "Keine Angaben", "Keine Angaben", "10000+", "10000+", "0-10", "1001-2500", "2501-10000",
    ]
    assert column(fields.size_bucket(df, size="t", thousands=".,"), "size_bucket")[2] == "2501-10000"


def test_portal(spark):
    df = texts(
        spark, "https://www.example.com/jobs", "https://subdomain.indeed.com/job/123", "https://x.org/a",
        "https://a.com.b.com/x", "www..x", "",
    )
    assert column(fields.portal(df, url="t"), "portal") == ["example", "indeed", "Unknown", "b", "", "Unknown"]


def test_posting_date(spark):
    df = texts(
        spark, "2025-04-15T00:30:00+02:00", "2025-04-15T23:15:00Z", "gestern", "2025", None, "", "2025-02-30", "2025-04-15",
        "2025-4-5", "2025-04-15 10", "2025-04-15T24:00", "2025-04-15T10:00:00.123", "2025-04-15T10:00:00.12", "12:30",
    )
    day, today = "15.04.2025", "05.05.2025"
    assert column(fields.posting_date(df, "2025-05-05", date="t"), "posting_date") == [
        day, day, today, today, today, today, today, day, today, day, today, day, today, today,
    ]


def test_time_models(spark):
    df = texts(spark, "teilzeitstelle", "full time", "voll- und teilzeit", "", "part-time", "40 stunden", "reduzierte stunden")
    assert column(fields.time_models(df, text="t"), "time_models") == [
        ["Teilzeit"], ["Vollzeit"], ["Teilzeit", "Vollzeit"], ["Vollzeit"], ["Vollzeit"], ["Vollzeit"], ["Teilzeit"],
    ]
    separated = fields.time_models(df, text="t", synonyms=fv.TIME_MODELS_SEPARATED)
    assert column(separated, "time_models")[4] == ["Teilzeit"]


def test_position(spark):
    df = texts(spark, "praktikantin und werkstudent", "volontärin", "trainee", "wir: werkstudent.", "überpraktikant", "volontär")
    assert column(fields.position(df, text="t"), "position") == [
        "Praktikant", "Normaler Angestellter", "Praktikant", "Werkstudent", "Normaler Angestellter", "Praktikant",
    ]


def test_employment(spark):
    df = texts(spark, "unbefristet", "öpermanent", "full-time", "feste anstellung", "temporary").withColumns(
        {"company_name": F.lit("X"), "lists": F.create_map().cast("map<string,array<struct<is_list:boolean,items:array<string>>>>")}
    )
    assert column(fields.employment(df, text="t"), "employment") == [
        "Feste Anstellung", "befristet", "Feste Anstellung", "befristet", "befristet",
    ]


def documents(spark, *docs):
    rows = [(doc, "c") for doc in docs]
    return canonical(spark.createDataFrame(rows, "doc string, collection string"))


def first(df):
    return df.first()


def test_remote_flag_of_both_layouts(spark):
    named = documents(spark, '{"paragraphs": {"Profil": "Homeoffice möglich"}}')
    keyed = documents(spark, '{"paragraphs": {"Homeoffice Möglich": "x"}}')
    listed = documents(spark, '{"paragraphs": ["Homeoffice möglich"]}')
    company = documents(spark, '{"lists": {"company": [["A", "Homeoffice möglich"]]}}')
    flags = [first(fields.remote_flag(d)).remote for d in (named, keyed, listed, company)]
    assert flags == [0, 1, 1, 1]


def test_direct_benefits(spark):
    df = documents(spark, '{"benefits": ["A", "", "nicht GEFUNDEN", "A"]}', '{"benefits": "A"}', "{}")
    assert sorted(r.direct_benefits for r in fields.direct_benefits(df).collect()) == [[], [], ["A", "A"]]


def test_company_and_location(spark):
    def both(doc):
        row = first(fields.company_and_location(documents(spark, doc)))
        return row.company, row.location

    assert both('{"Company Name": "N", "lists": {"company": [["A", "B"]]}}') == ("N", "")
    assert both('{"lists": {"company": ["A", ["B", "C"]]}}') == ("A", "B")
    assert both('{"lists": {"company": ["A"]}}') == ("A", "")
    assert both('{"lists": {"company": [["A", "B"]]}, "jobLocationText": ""}') == ("A", "")
    assert both('{"jobLocationText": "12345 Ulm"}') == ("", "Ulm")


def test_sections_which_are_texts_count_in_one_reader_only(spark):
    df = documents(spark, '{"paragraphs": {"a": ["x", "y"], "b": "z", "c": 5}, "lists": {"l": [["p", "q\'s"], "r"]}}')
    row = first(fields.search_text(fields.description(fields.benefits_text(df))))
    assert row.benefits_text == "x\ny\nz"
    assert row.description == "x y ['p', \"q's\"] r"
    assert row.search_text == "['p', \"q's\"] r x y"


def test_benefits_list_first(spark):
    filled = documents(spark, '{"lists": {"content/benefits": ["A", ["B"]]}, "paragraphs": ["x"]}')
    empty = documents(spark, '{"lists": {"content/benefits": []}, "paragraphs": ["x", "y"]}')
    assert first(fields.benefits_text(filled)).benefits_text == "A\n['B']"
    assert first(fields.benefits_text(empty)).benefits_text == "x\ny"
    assert first(fields.benefits_text(documents(spark, "{}"))).benefits_text == ""


def test_company_size_is_last_text_of_a_list(spark):
    def size(info):
        return first(fields.company_size_raw(documents(spark, '{"lists": {"CompanyInfo": %s}}' % info))).size_raw

    assert size('["x", ["a", 5], [], ["Größe", "51-250"], ["b", "c"]]') == "51-250"
    assert size('["x"]') == "Keine Angaben"


def test_title(spark):
    df = texts(spark, "   Koch ", "", "  ", None)
    assert column(fields.job_title(df, title="t"), "job_title") == ["Koch", "Kein Titel", "Kein Titel", "Kein Titel"]


def test_fold(spark):
    df = texts(spark, "Köln", "KOLN", "Gießen", "Gieen", "Ĳssel", "Łódź", "ﬁ").withColumn("f", tx.fold(F.col("t")))
    assert column(df, "f") == ["koln", "koln", "gieen", "gieen", "ijssel", "odz", "fi"]


def test_url_key(spark):
    df = texts(spark, "a?b?c", "a", "", None).withColumn("u", tx.url_key(F.col("t")))
    assert column(df, "u") == ["a", "a", "", None]


@pytest.mark.parametrize("template", [fv.EXPERIENCE_PROMPT, fv.BENEFITS_PROMPT, fv.BRANCH_PROMPT])
def test_prompt_keeps_whole_text(spark, template):
    long = "wort " * 5000
    text = texts(spark, long).select(prompts.fill(template, F.col("t"), 4).alias("p")).first().p
    assert long in text
    assert text.replace("\n    ", "\n").replace(long, "{value}") == template


def test_strict_prompt_keeps_the_title(spark):
    df = texts(spark, "x" * 2000).withColumnRenamed("t", "job_title")
    assert "x" * 2000 in prompts.strict_branch_prompt(df).first().branch_prompt
    cut = prompts.strict_branch_prompt(df, max_chars=1500).first().branch_prompt
    assert "x" * 1500 in cut and "x" * 1501 not in cut
