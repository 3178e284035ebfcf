"""Postings and their companions, derived from the given star-schema tables.

Every order becomes one posting; customers add places to the gazetteer and
embeddings add phrases, so all of these grow with the tables.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from postmill.operators import classify
from postmill.operators.joins import first_per_key
from postmill.plans.load import LoadInputs, answers_from_table, vectors_from_table
from postmill.sources.tables import spread

AS_OF = "2025-05-05"
THRESHOLD = 0.25
HOME, HOME_LABEL = "EUROPE", "Europa"
STATE_MAP = {"Staat_1": "Mapped_1"}
EXAMPLES_PER_LABEL = 5
PHRASES = [
    "Urlaub extra", "Dienstrad", "Bahnkarte", "Essensgeld", "Fitnesskurs", "Altersrente", "Bonus jährlich", "Gleitzeit",
    "Tage daheim", "Laptop neu", "Kita Platz", "Sommerfest",
]
TEXTS = [
    "Stelle in Vollzeit", "Teilzeitstelle mit 20 Stunden", "Voll- und Teilzeit", "Wir suchen eine Praktikantin",
    "Werkstudent gesucht", "unbefristet", "temporary role", "Homeoffice möglich", "part-time", "öpermanent",
]
ANSWERS = {
    "experience_response": [
        '{"Experience_Required": 1}', '{"Experience_Required": 0} text', "Ja", '{"Experience_Required": 1',
        'x {"Experience_Required": "1"}', '{"a": {"b": 1}}', "", '{"Other": 1}',
    ],
    "benefits_response": [
        '{"benefits": ["A","B","A"]}', '[{"benefit": "A"}, {"benefit": "B"}]', 'Text {"benefits": ["A"]} Ende',
        '{"benefits": ["A", "B', "- A\n* B\n1. C\n 2. D", '{"benefits": ["A\\xfc", "B"]}', "nichts", '{"benefits": []}',
    ],
    "branch_response": [
        '{"Kategorie": "IT"}', '{"Kategorie": "it"}', '{"Kategorie": "Bildung&Forschung"}',
        '{"Kategorie": "IT"} {"Kategorie": "Recht"}', '{"Kategorie": "Sport"}', "IT", '{"Kategorie":', '{"Typ": "IT"}',
    ],
}
CATEGORIES = [
    "Gehalt_anhand_von_Tarifklassen", "Überstundenvergütung", "Gehaltserhöhungen", "Aktienoptionen_Gewinnbeteiligung",
    "Boni", "Sonderzahlungen", "13. Gehalt", "Betriebliche_Altersvorsorge", "Homeoffice", "non_incentive",
]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A given table."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def pick(values: list[str], index: Column) -> Column:
    """Element of a constant list by a 0-based index."""
    return F.get(F.array(*[F.lit(v) for v in values]), index.cast("int"))


def _sql_list(values: list[str]) -> str:
    return "array(" + ", ".join("'" + v.replace("'", "\\'") + "'" for v in values) + ")"


def base(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per order with all ingredients of a posting."""
    joined = (
        spread(table(spark, sf_dir, "orders"))
        .join(table(spark, sf_dir, "customer"), F.col("o_custkey") == F.col("c_custkey"))
        .join(table(spark, sf_dir, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
    )
    rows = joined.selectExpr(
        "o_orderkey AS k", "o_custkey", "c_name", "c_mktsegment", "o_orderpriority", "o_totalprice",
        "date_format(o_orderdate, 'yyyy-MM-dd') AS day", "n_name AS n1",
        "'NATION_' || (c_nationkey + 7) % 25 AS n2", "'NATION_' || (c_nationkey + 11) % 25 AS n3",
        "o_orderkey % 2 = 0 AS is_a",
    )
    ph, tx = _sql_list(PHRASES), _sql_list(TEXTS)
    return rows.selectExpr(
        "k", "is_a", "c_name", "'p' || k AS doc_id", "if(is_a, 'stepstone', 'indeed') AS collection",
        """CASE WHEN k % 97 = 0 THEN ''
                WHEN is_a THEN 'https://www.stepstone.de/jobs/' || o_custkey || '?k=' || k % 3
                ELSE 'https://de.indeed.com/viewjob/' || k END AS url""",
        "CASE WHEN k % 194 = 97 THEN 'https://jobs.example.org/' || k END AS url_alt",
        "if(k % 31 = 0, '', ' ' || o_orderpriority || ' ' || c_mktsegment || ' ') AS title",
        "if(k % 62 = 0, k, NULL) AS job_id",
        "if(k % 62 = 31, k, NULL) AS job_no",
        "if(is_a, NULL, c_name) AS company_name",
        """CASE k % 7 WHEN 0 THEN if(k % 14 = 0, n1, 'Ort_' || o_custkey)
                WHEN 1 THEN n1 || ', ' || n2 WHEN 2 THEN n1 || '; ' || n2 || ' / ' || n3
                WHEN 3 THEN n1 || ' (Zentrum) und ' || n2 WHEN 4 THEN '12345 ' || n1 || ' bei ' || n2
                WHEN 5 THEN 'bundesweit' ELSE if(k % 14 = 6, 'Nirgendwo', 'Irgendwo') END AS loc""",
        "if(k % 3 = 0, 'Feste Anstellung', 'Befristet') AS contract",
        """CASE k % 8 WHEN 1 THEN '1,000 Mitarbeiter' WHEN 2 THEN '51-250' WHEN 3 THEN '10.000'
                WHEN 4 THEN 'keine Angabe' WHEN 5 THEN '0' WHEN 6 THEN cast(floor(o_totalprice) AS string)
                WHEN 7 THEN '2,501-10,000 Mitarbeiter' END AS size""",
        "k % 16 <> 1 AS size_is_list",
        f"if(k % 4 = 0, array(get({ph}, cast(k % 12 AS int)), get({ph}, cast((k + 1) % 12 AS int))), NULL) AS listed",
        f"""if(is_a, NULL, concat(array(get({ph}, cast(k % 12 AS int)), get({ph}, cast(5 * k % 12 AS int))),
                if(k % 4 = 1, array('Nicht gefunden'), array()), if(k % 6 = 1, array(''), array()),
                if(k % 3 = 0, array('Leistung ' || (15 + k % 400)), array()))) AS benefits""",
        f"get({tx}, cast(k % 10 AS int)) AS tx1",
        f"get({tx}, cast(floor(k / 10) % 10 AS int)) AS tx2",
        "CASE k % 5 WHEN 0 THEN 'dict' WHEN 1 THEN 'none' ELSE 'list' END AS para",
        """CASE WHEN k % 9 = 0 THEN NULL WHEN k % 9 = 1 THEN 'gestern'
                WHEN k % 9 <= 5 THEN day || 'T00:30:00+02:00' ELSE day || 'T23:15:00Z' END AS date_posted""",
    )


def postings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Canonical postings, built straight from columns; ``k`` is kept."""
    item = "named_struct('is_list', {0}, 'ends_in_text', true, 'items', {1})"
    section = "named_struct('section', cast({0} AS string), 'is_list', {1}, 'items', {2})"
    company = item.format("true", "array(c_name, loc, contract)")
    info = item.format("size_is_list", "if(size_is_list, array('Unternehmensgröße', size), array(size))")
    return base(spark, sf_dir).selectExpr(
        "k", "doc_id AS _id", "collection", "if(url <> '', url, coalesce(url_alt, '')) AS url", "title",
        "if(title = '', coalesce('Job ID: ' || job_id, 'Job #: ' || job_no), NULL) AS alt_title",
        "company_name", "if(is_a, NULL, '80331 ' || loc) AS job_location_text", "date_posted",
        "coalesce(benefits, cast(array() AS array<string>)) AS benefits",
        f"""map_from_entries(array_compact(array(
                if(is_a, named_struct('key', 'company', 'value', array({company})), NULL),
                if(size IS NOT NULL, named_struct('key', 'CompanyInfo', 'value', array({info})), NULL),
                if(listed IS NOT NULL, named_struct('key', 'content/benefits', 'value',
                    transform(listed, t -> {item.format("false", "array(t)")})), NULL)))) AS lists""",
        "para AS paragraphs_kind",
        f"""CASE para
                WHEN 'dict' THEN array({section.format("'Aufgaben'", "true", "array(tx1, tx2)")},
                    {section.format("'Profil'", "false", "array('Homeoffice möglich')")})
                WHEN 'list' THEN array({section.format("NULL", "false", "array(tx1)")},
                    {section.format("NULL", "false", "array(tx2)")})
                ELSE cast(array() AS array<struct<section:string,is_list:boolean,items:array<string>>>) END AS paragraphs""",
    )


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same postings as raw ``(doc, collection)`` rows of JSON text."""

    def text(value: str) -> str:
        return f"regexp_extract(to_json(array(cast({value} AS string))), '^.(.*).$', 1)"

    def field(name: str, value: str, present: str) -> str:
        return f"if({present}, '\"{name}\":' || {value}, NULL)"

    lists = ", ".join(
        [
            field("company", "to_json(array(array(c_name, loc, contract)))", "is_a"),
            field(
                "CompanyInfo",
                "if(size_is_list, to_json(array(array('Unternehmensgröße', size))), to_json(array(size)))",
                "size IS NOT NULL",
            ),
            field("content/benefits", "to_json(listed)", "listed IS NOT NULL"),
        ]
    )
    both = "to_json(array(tx1, tx2))"
    fields = ", ".join(
        [
            field("_id", text("doc_id"), "true"),
            field("url", text("url"), "true"),
            field("URL", text("url_alt"), "url_alt IS NOT NULL"),
            field("Job Title", text("title"), "true"),
            field("jobId", "job_id", "job_id IS NOT NULL"),
            field("Job #", "job_no", "job_no IS NOT NULL"),
            field("Company Name", text("company_name"), "company_name IS NOT NULL"),
            field("jobLocationText", text("'80331 ' || loc"), "NOT is_a"),
            field("datePosted", text("date_posted"), "date_posted IS NOT NULL"),
            field("benefits", "to_json(benefits)", "benefits IS NOT NULL"),
            field("lists", f"'{{' || concat_ws(',', {lists}) || '}}'", "true"),
            field(
                "paragraphs",
                f"""if(para = 'list', {both}, '{{"Aufgaben":' || {both} || ',"Profil":"Homeoffice möglich"}}')""",
                "para <> 'none'",
            ),
        ]
    )
    return base(spark, sf_dir).selectExpr("k", f"'{{' || concat_ws(',', {fields}) || '}}' AS doc", "collection")


def responses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Model answers per posting."""
    k = F.col("o_orderkey")
    return spread(table(spark, sf_dir, "orders").select("o_orderkey")).select(
        F.concat(F.lit("p"), k).alias("_id"), *[pick(texts, k % 8).alias(name) for name, texts in ANSWERS.items()]
    )


def open_generator(name: str):
    """A hook whose answer to a prompt depends on the prompt's length only."""
    return lambda **settings: lambda prompts: [ANSWERS[name][len(p) % 8] for p in prompts]


def open_letter_counter():
    """An embedding hook: how often each letter from a to z stands in a text."""
    return lambda texts: [[float(t.lower().count(c)) for c in "abcdefghijklmnopqrstuvwxyz"] for t in texts]


def open_translator(lang_pair: str):
    """A hook that knows the words of ``TRANSLATIONS`` and has no answer for others."""
    known = {src: dst for src, dst, pair in TRANSLATIONS if pair == lang_pair}
    return lambda texts: [known.get(t) for t in texts]


def repeated_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Small documents in groups of three with one id, the first of which has the largest URL."""
    k = "o_orderkey"
    doc = f"""concat('{{"_id":"g', floor({k} / 3), '","url":"https://www.p.de/', floor({k} / 3), '/', 9 - {k} % 3, '","Job Title":"t', {k}, '","Company Name":"c', {k} % 7, '"}}')"""
    return spread(table(spark, sf_dir, "orders").select(k)).selectExpr(f"{k} AS k", f"{doc} AS doc", "'c' AS collection")


def gazetteer(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(city, state, country, ord)``: nations, some of them twice, and one place per customer."""
    nations = table(spark, sf_dir, "nation").join(
        table(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey")
    )
    key = F.col("n_nationkey")
    state = lambda number: F.concat(F.lit("Staat_"), (number % 7).cast("string"))
    first = nations.select(
        F.col("n_name").alias("city"), state(key).alias("state"), F.col("r_name").alias("country"), key.cast("bigint").alias("ord")
    )
    again = nations.where(key % 4 == 0).select(
        F.col("n_name").alias("city"), F.concat(F.lit("Heim_"), (key % 3).cast("string")).alias("state"),
        F.lit(HOME).alias("country"), (100 + key).cast("bigint").alias("ord"),
    )
    places = table(spark, sf_dir, "customer").join(
        nations.select("n_nationkey", "r_name"), F.col("c_nationkey") == F.col("n_nationkey")
    ).select(
        F.concat(F.lit("Ort_"), "c_custkey").alias("city"), state(F.col("c_nationkey")).alias("state"),
        F.col("r_name").alias("country"), (1000 + F.col("c_custkey")).alias("ord"),
    )
    return first.unionAll(again).unionAll(places)


TRANSLATIONS = [("Nirgendwo", "NATION_2", "de>en"), ("Staat_2", "Land_2", "en>de"), ("ASIA", "Asien", "en>de")]


def translations(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(TRANSLATIONS, "src string, dst string, lang_pair string")


def phrase_name() -> Column:
    """Text of a vector: the first ones carry the phrases of the postings."""
    named = F.get(F.array(*[F.lit(p) for p in PHRASES + ["A", "B", "1. C"]]), F.col("vec_id").cast("int"))
    return F.coalesce(named, F.concat(F.lit("Leistung "), "vec_id"))


def phrase_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "embeddings").select(phrase_name().alias("phrase"), "embedding")


def mean_vectors(vectors: DataFrame) -> DataFrame:
    """The mean vector of every label, as wide as the widest vector."""
    width = vectors.agg(F.max(F.size("embedding"))).first()[0] or 0
    mean = F.array(*[F.avg(F.get("embedding", F.lit(i)).cast("double")) for i in range(width)])
    return vectors.groupBy("label").agg(mean.alias("mean"))


def prototype_rows(spark: SparkSession, sf_dir: str, per_label: int | None = EXAMPLES_PER_LABEL) -> DataFrame:
    """Per label: its first vectors as examples (all of them for None), and their mean as context. Ten labels, so 60 rows at any scale."""
    vectors = table(spark, sf_dir, "embeddings")
    examples = first_per_key(vectors, ["label"], ["vec_id"], per_label) if per_label else vectors
    contexts = mean_vectors(examples).withColumnRenamed("mean", "embedding")
    shaped = lambda df, kind: df.select(
        pick(CATEGORIES, F.col("label")).alias("category"), F.col("label").alias("ord"), F.lit(kind).alias("kind"),
        F.col("embedding").cast("array<double>").alias("embedding"),
    )
    return shaped(examples, "example").unionAll(shaped(contexts, "context"))


def prototypes(spark: SparkSession, sf_dir: str) -> classify.Prototypes:
    return classify.Prototypes.collect(prototype_rows(spark, sf_dir))


def untidy_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents whose lists hold texts, numbers, objects and null beside lists, and lists of mixed items."""
    lists = """concat('{"company":["ACME ', k, '","Berlin"],"note":"frei ', k % 7, '","number":', k % 5, ',"yes":true,"nothing":null,"object":{"b":1,"a":',
        k % 3, '},"mixed":["x",', k % 11, ',true,null,["y","z"]]}')"""
    doc = f"""concat('{{"_id":"p', k, '","url":"u', k, '","lists":', {lists}, ',"paragraphs":[]}}')"""
    return spread(table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("k"))).selectExpr("k", f"{doc} AS doc", "if(k % 2 = 0, 'a', 'b') AS collection")


def lines_with_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines of all orders: whole documents, broken ones, blank lines, and JSON which is no object."""
    line = """CASE WHEN k % 5 = 0 THEN concat('{"_id":"p', k, '","url":') WHEN k % 7 = 0 THEN '' WHEN k % 11 = 0 THEN concat('[', k, ']')
        ELSE concat('{"_id":"p', k, '","lists":{}}') END"""
    return spread(table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("k"))).selectExpr(f"{line} AS doc", "if(k % 2 = 0, 'a', 'b') AS collection")


def phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All vectors as phrases of small postings: eight phrases each."""
    return spread(table(spark, sf_dir, "embeddings")).select(
        F.floor(F.col("vec_id") / 8).cast("bigint").alias("posting"), F.col("vec_id").alias("pos"),
        F.concat(F.lit("v"), "vec_id").alias("phrase"), "embedding",
    )


def load_inputs(spark: SparkSession, sf_dir: str) -> LoadInputs:
    return LoadInputs(
        answer=answers_from_table(responses(spark, sf_dir)),
        embed=vectors_from_table(phrase_vectors(spark, sf_dir)),
        prototypes=prototypes(spark, sf_dir),
        gazetteer=gazetteer(spark, sf_dir),
        translations=translations(spark),
        home=HOME,
        home_label=HOME_LABEL,
        state_names=STATE_MAP,
        as_of=AS_OF,
        threshold=THRESHOLD,
    )
