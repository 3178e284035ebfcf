"""Registered queries: name → function of (session, data folder) giving a DataFrame."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from postmill import fixed_values as fv
from postmill.functions.names import named
from postmill.functions import text as tx
from postmill.functions import vectors
from postmill.operators import classify, dictionary, evaluate, fields, geo, hooks, joins, prompts, responses
from postmill.operators.joins import join_small, skip_known
from postmill.plans import fixtures as fx
from postmill.plans import load as load_plan
from postmill.session import compiled_methods, work_path, write_stage
from postmill.sinks import files, keyed_table, known_ids, result_table
from postmill.sources import dumps
from postmill.sources import gazetteer as gaz
from postmill.sources.collections import canonical, completeness, open_documents, union_collections
from postmill.sources.tables import read_csv, spread, table_exists, underscore_names
from postmill.streaming import incremental, seen

Query = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, Query] = {}


def query(build: Query) -> Query:
    REGISTRY[build.__name__] = build
    return build


def big(column: Column | str) -> Column:
    return (F.col(column) if isinstance(column, str) else column).cast("bigint")


def joined(column: str, separator: str = "|") -> Column:
    return F.array_join(column, separator)


# --- flagship ----------------------------------------------------------------


@query
def postings_by_portal(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Postings per portal, size bucket and time model."""
    p = fx.postings(spark, sf_dir)
    for step in (fields.search_text, fields.time_models, fields.company_size_raw, fields.size_bucket, fields.portal):
        p = step(p)
    return (
        p.select("portal", "size_bucket", F.explode_outer("time_models").alias("time_model"))
        .groupBy("portal", "size_bucket", "time_model")
        .agg(F.count(F.lit(1)).alias("n"))
    )


# --- sources -----------------------------------------------------------------


@query
def collections_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three collections as one table, tagged; counted per collection and filled column."""
    both = union_collections(
        {
            "documents": fx.table(spark, sf_dir, "documents").select(F.col("doc_id").alias("id"), "text", "lang"),
            "pages": fx.table(spark, sf_dir, "pages").select(F.col("page_id").alias("id"), F.col("html").alias("text"), "url"),
            "conversations": fx.table(spark, sf_dir, "conversations").select(F.col("conv_id").alias("id"), "text", "role"),
        }
    )
    return both.groupBy("collection").agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.length("text")).alias("chars"), F.sum("id").alias("id_sum"),
        F.count("lang").alias("with_lang"), F.count("url").alias("with_url"), F.count("role").alias("with_role"),
    )


@query
def canonical_untidy(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lists of untidy documents, section by section."""
    c = canonical(fx.untidy_documents(spark, sf_dir)).select("_id", "collection", F.explode("lists").alias("section", "items"))
    return c.select("_id", "collection", "section", F.array_join(F.transform("items", lambda i: F.array_join(i["items"], "+")), "|").alias("items"))


@query
def load_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines rejected by two runs, the second repeated, and how many lines each run saw."""
    path = work_path(spark, "result")
    raw = fx.lines_with_rejects(spark, sf_dir)
    for run, lines in ((1, raw.where("collection = 'a'")), (2, raw), (2, raw)):
        load_plan.write_rejects(load_plan.marked(lines), path, run)
    return load_plan.rejects(spark, path).select("run", "collection", "doc")


LINES_PER_TASK, TASK_BYTES = 500_000, 32 << 20


@query
def collection_splits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One landed file read in 1, 7 and 50 splits: each document with its position, and how many of the three readings have it there."""
    folder = work_path(spark, "dump")
    docs = fx.table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("k"), F.concat(F.lit('{"_id":"p'), "o_orderkey", F.lit('","n":"'), "o_orderpriority", F.lit('"}')).alias("value"))
    dumps.land(docs, ["k"], f"{folder}/orders.txt", work_path(spark, "drafts"), spark.sparkContext.defaultParallelism + docs.count() // LINES_PER_TASK)
    spark.dataSource.register(dumps.DumpSource)
    size = sum(dumps.list_dumps(folder).values())
    readings = [
        spark.read.format(dumps.NAME).option("path", folder).option("splitBytes", -(-size // number)).load().withColumn("splits", F.lit(number))
        for number in (1, 7, 50)
    ]
    # dealt out before they are grouped, since the task that reads the file in one split would hold a group for each of its lines
    every = readings[0].unionByName(readings[1]).unionByName(readings[2])
    every = every.repartition(spark.sparkContext.defaultParallelism + 3 * size // TASK_BYTES, "doc", "position")
    return every.groupBy("doc", "position").agg(F.count_distinct("splits").alias("readings"))


@query
def canonical_postings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """JSON documents opened and projected to the canonical schema."""
    c = canonical(fx.documents(spark, sf_dir))
    return c.select(
        "_id", "collection", "url", "title", "alt_title", "company_name", "job_location_text", "date_posted",
        joined("benefits").alias("benefits"),
        F.array_join(F.map_keys("lists"), "|").alias("list_names"),
        "paragraphs_kind",
        big(F.size("paragraphs")).alias("n_paragraphs"),
        F.array_join(F.flatten(F.transform("paragraphs", lambda s: s["items"])), "|").alias("paragraph_items"),
    )


@query
def completeness_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Missing values per raw field over all documents."""
    raw = open_documents(fx.documents(spark, sf_dir))
    named = raw.select(
        F.nullif("r_url", F.lit("")).alias("url"), F.col("r_paragraphs").alias("paragraphs"), F.col("r_lists").alias("lists"),
        F.col("r_company").alias("company_name"), F.col("r_date").alias("date_posted"), F.col("r_benefits").alias("benefits"),
    )
    return completeness(named)


@query
def gazetteer_flatten(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nested country → state → city data flattened; a nested state holds 500 cities at most."""
    flat = fx.gazetteer(spark, sf_dir)
    states = flat.groupBy("country", "state", F.floor(F.col("ord") / 500).alias("part")).agg(
        F.array_sort(F.collect_list(F.struct("ord", F.col("city").alias("name")))).alias("c")
    )
    nested = states.select(
        F.col("country").alias("name"),
        F.array(F.struct(F.col("state").alias("name"), F.transform("c", lambda c: c.dropFields("ord")).alias("cities"))).alias(
            "states"
        ),
        F.col("part").alias("country_ord"),
    )
    return gaz.flatten(nested).select("city", "state", "country")


@query
def table_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """CSV written, checked for existence and read back with a schema."""
    path = work_path(spark, "scan")
    source = fx.table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("order key"), F.col("o_orderpriority").alias("order priority"), F.col("o_totalprice").alias("total price")
    )
    before = table_exists(spark, path)
    files.write_csv(source, path)
    read = underscore_names(read_csv(spark, path, source.schema))
    return read.select(
        "order_key", "order_priority", "total_price", F.lit(before).alias("before"), F.lit(table_exists(spark, path)).alias("after")
    )


# --- posting fields ----------------------------------------------------------


@query
def portal_of_url(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fields.portal(fx.table(spark, sf_dir, "pages")).select("page_id", "portal")


@query
def url_key_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    keyed = evaluate.with_url_key(fx.table(spark, sf_dir, "pages"), "url")
    return keyed.groupBy("url_key").agg(F.count(F.lit(1)).alias("n"))


@query
def posting_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fields.posting_date(fx.postings(spark, sf_dir), fx.AS_OF).select("_id", "posting_date")


@query
def size_bucket(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = fields.size_bucket(fields.company_size_raw(fx.postings(spark, sf_dir)))
    return p.select("_id", "size_raw", "size_bucket")


@query
def size_bucket_of_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The bucket rule on another table: documents by length."""
    d = fx.table(spark, sf_dir, "documents").withColumn("size_raw", F.col("n_chars").cast("string"))
    return fields.size_bucket(d).groupBy("size_bucket").agg(F.count(F.lit(1)).alias("n"), F.sum("n_chars").alias("chars"))


@query
def benefits_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fields.benefits_text(fx.postings(spark, sf_dir)).select("_id", "benefits_text")


@query
def direct_benefits(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = fields.direct_benefits(fx.postings(spark, sf_dir))
    return p.select("_id", joined("direct_benefits").alias("direct_benefits"))


@query
def search_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = fields.search_text(fields.description(fx.postings(spark, sf_dir)))
    return p.select("_id", "description", "search_text")


@query
def time_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = fields.time_models(fields.search_text(fx.postings(spark, sf_dir)))
    return p.select("_id", joined("time_models").alias("time_models"))


@query
def time_model_separated(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Time models by the list whose wordings stand alone."""
    p = fields.time_models(fields.search_text(fx.postings(spark, sf_dir)), synonyms=fv.TIME_MODELS_SEPARATED)
    return p.select("_id", joined("time_models").alias("time_models"))


@query
def position(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fields.position(fields.search_text(fx.postings(spark, sf_dir))).select("_id", "position")


@query
def employment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fields.employment(fields.search_text(fx.postings(spark, sf_dir))).select("_id", "employment")


@query
def remote_flag(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rule flag, and the same joined with a flag from elsewhere."""
    p = fields.remote_flag(fx.postings(spark, sf_dir))
    other = (F.col("k") % 3 == 0).cast("int")
    return p.select("_id", big("remote").alias("remote"), big(fields.either_flag(F.col("remote"), other)).alias("combined"))


SYNONYMS = 5000


@query
def label_dictionary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labels of all documents by a dictionary of their 5,000 most frequent words of six letters or more, as whole words."""
    texts = fx.table(spark, sf_dir, "documents").select("doc_id", F.lower("text").alias("text"))
    words = texts.select(F.explode(F.split("text", r"[^\p{L}\p{M}\p{Nd}_]+")).alias("word")).where(F.col("word").rlike("^[a-z]{6,}$"))
    frequent = words.groupBy("word").count().orderBy(F.desc("count"), "word").limit(SYNONYMS).collect()
    labels: dict[str, list[str]] = {}
    for row in frequent:
        labels.setdefault(f"{row.word[0]}{len(row.word)}", []).append(row.word)
    return dictionary.label_texts(texts, "doc_id", "text", labels).select("doc_id", joined("labels").alias("labels"))


@query
def title_company_location(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = fields.company_and_location(fields.job_title(fx.postings(spark, sf_dir)))
    return p.select("_id", "job_title", "company", "location")


@query
def prompt_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All four prompts of every posting, as length and digest of the whole text."""
    p = fields.job_title(fields.benefits_text(fields.description(fx.postings(spark, sf_dir))))
    strict = prompts.strict_branch_prompt(prompts.prompts(p), out="strict_prompt")
    names = ("experience_prompt", "benefits_prompt", "branch_prompt", "strict_prompt")
    return strict.select(
        "_id", *[F.md5(n).alias(n) for n in names], *[big(F.length(n)).alias(f"{n}_chars") for n in names]
    )


# --- places ------------------------------------------------------------------


def _located(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = geo.place_names(fields.company_and_location(fx.postings(spark, sf_dir)))
    return geo.explode_places(p.select("_id", "places"))


def _index(spark: SparkSession, sf_dir: str) -> DataFrame:
    return geo.gazetteer_index(
        fx.gazetteer(spark, sf_dir), fx.translations(spark), fx.HOME, fx.HOME_LABEL, fx.STATE_MAP
    )


def _resolved(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Places with state and country. The index is read twice, so it is written first, which also shows its size."""
    index = write_stage(_index(spark, sf_dir), "gazetteer")
    return geo.resolve_places(_located(spark, sf_dir), index, fx.translations(spark), ["_id", "place_pos"])


@query
def location_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _located(spark, sf_dir).select("_id", big("place_pos").alias("place_pos"), "place")


@query
def gazetteer_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per city: home country first, then file order."""
    return _index(spark, sf_dir)


@query
def geo_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """State and country of every place of every posting."""
    rows = _resolved(spark, sf_dir)
    return rows.select("_id", big("place_pos").alias("place_pos"), "place", "state", "country")


@query
def city_membership(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distinct place names which the gazetteer holds, without regard to case and accents."""
    names = _located(spark, sf_dir).select(F.upper("place").alias("place")).distinct()
    accented = names.withColumn("place", F.replace("place", F.lit("O"), F.lit("Ö")))
    return geo.known_cities(accented, fx.gazetteer(spark, sf_dir))


@query
def distinct_places(spark: SparkSession, sf_dir: str) -> DataFrame:
    return geo.distinct_values(_resolved(spark, sf_dir), ["_id"])


@query
def fan_out(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Posting × place × time model × position."""
    p = fx.postings(spark, sf_dir)
    for step in (fields.search_text, fields.company_and_location, fields.time_models, fields.position, geo.place_names):
        p = step(p)
    rows = geo.explode_places(p.select("_id", "url", "time_models", "position", "places"))
    return rows.select("_id", "url", "place", F.explode_outer("time_models").alias("time_model"), "position")


# --- phrases and vectors -----------------------------------------------------


def _ranked(spark: SparkSession, sf_dir: str) -> DataFrame:
    return classify.decide(classify.score_ranked(fx.phrases(spark, sf_dir), fx.prototypes(spark, sf_dir)), fx.THRESHOLD)


@query
def vector_best_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The best category of every phrase, the prototypes cut into several blocks."""
    blocks = classify.Prototypes.blocks(fx.prototype_rows(spark, sf_dir), 10)
    decided = classify.decide(classify.score_blocks(fx.phrases(spark, sf_dir), blocks), fx.THRESHOLD)
    return decided.select("phrase", "best_category", F.round("best_score", 4).alias("best_score"), big("assigned").alias("assigned"))


@query
def vector_cosine(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cosine of every vector with the mean vector of its label, as a column expression."""
    v = fx.table(spark, sf_dir, "embeddings")
    met = join_small(v, write_stage(fx.mean_vectors(v), "means"), "label")
    return met.select("vec_id", F.round(vectors.cosine(F.col("embedding"), F.col("mean")), 4).alias("cosine"))


@query
def vector_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    scores = classify.score_all(fx.phrases(spark, sf_dir), fx.prototypes(spark, sf_dir))
    return scores.select(
        "phrase", "category", *[F.round(c, 4).alias(c) for c in ("direct", "context", "combined")]
    )


@query
def category_max(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Highest combined score per posting and category."""
    scores = classify.score_all(fx.phrases(spark, sf_dir), fx.prototypes(spark, sf_dir)).withColumn(
        "posting", F.floor(F.substring("phrase", 2, 20).cast("bigint") / 8).cast("bigint")
    )
    best = classify.max_per_category(scores, "posting", "combined")
    return best.select("posting", "category", F.round("combined", 4).alias("combined"))


@query
def vector_best(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _ranked(spark, sf_dir).select(
        "phrase", "best_category", F.round("best_score", 4).alias("best_score"), big("assigned").alias("assigned")
    )


@query
def vector_top5(spark: SparkSession, sf_dir: str) -> DataFrame:
    r = _ranked(spark, sf_dir).select("phrase", F.posexplode("ranked").alias("rank", "r"))
    return r.select("phrase", big(F.col("rank") + 1).alias("rank"), "r.category", F.round("r.score", 4).alias("score"))


@query
def prototype_best(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All benefits of the postings against the prototypes of the classifier themselves, both embedded by a hook."""
    prototypes = classify.Prototypes.collect(hooks.embed(classify.prototype_texts(spark), "text", fx.open_letter_counter))
    phrases = fx.postings(spark, sf_dir).select(F.explode("benefits").alias("phrase")).where("phrase <> ''").distinct()
    ranked = classify.score_ranked(hooks.embed(phrases, "phrase", fx.open_letter_counter), prototypes)
    return classify.decide(ranked).select(
        "phrase", "best_category", F.round("best_score", 4).alias("best_score"), big("assigned").alias("assigned"), big(F.size("ranked")).alias("ranked")
    )


MANY_PROTOTYPES = 200_000


@query
def vector_pruned(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The five best categories of every phrase with all vectors as examples; groups which cannot matter are skipped."""
    rows = fx.prototype_rows(spark, sf_dir, None)
    few = rows.count() <= MANY_PROTOTYPES
    blocks = [classify.Prototypes.collect(rows, MANY_PROTOTYPES)] if few else classify.Prototypes.blocks(rows, MANY_PROTOTYPES)
    parts = [classify.score_pruned(fx.phrases(spark, sf_dir), classify.PrototypeGroups(block)).select("phrase", "ranked") for block in blocks]
    r = (parts[0] if few else classify.merge_ranked(parts)).select("phrase", F.posexplode("ranked").alias("rank", "r"))
    return r.select("phrase", big(F.col("rank") + 1).alias("rank"), "r.category", F.round("r.score", 4).alias("score"))


@query
def key_overlap_sketch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """URL keys of the postings per portal and run as sketches: the keys of each run and of both, and whether the estimates keep their bound."""
    p = fields.portal(fx.postings(spark, sf_dir)).select("portal", tx.url_key(F.col("url")).alias("key"), F.col("k"))
    runs = p.where(F.col("k") % 3 != 0).withColumn("run", F.lit(1)).unionByName(p.where(F.col("k") % 2 == 0).withColumn("run", F.lit(2)))
    sketches = write_stage(evaluate.key_sketches(runs, ["portal", "run"], "key"), "sketches")
    told = evaluate.sketch_overlap(sketches.where("run = 1"), sketches.where("run = 2"), "portal")
    sets = runs.groupBy("portal", "key").agg(F.max((F.col("run") == 1).cast("int")).alias("one"), F.max((F.col("run") == 2).cast("int")).alias("two"))
    exact = sets.groupBy("portal").agg(F.sum("one").alias("n_1"), F.sum("two").alias("n_2"), F.sum(F.col("one") * F.col("two")).alias("n_both"))
    near = lambda e, n: F.abs(F.col(e) - F.col(n)) <= F.col("bound")
    return exact.join(told, "portal").select(
        "portal", big("n_1").alias("n_1"), big("n_2").alias("n_2"), big("n_both").alias("n_both"),
        (near("estimate_a", "n_1") & near("estimate_b", "n_2") & near("estimate_both", "n_both")).alias("within_bound"),
    )


def _flags(spark: SparkSession, sf_dir: str) -> DataFrame:
    categories = [c for c in fx.CATEGORIES if c != fv.DROPPED_CATEGORY]
    return classify.flags_and_unmatched(_ranked(spark, sf_dir), ["posting"], categories)


@query
def flag_pivot(spark: SparkSession, sf_dir: str) -> DataFrame:
    flags = _flags(spark, sf_dir)
    categories = [c for c in fx.CATEGORIES if c != fv.DROPPED_CATEGORY]
    return flags.select("posting", *[big(named(c)).alias(f"flag_{n}") for n, c in enumerate(categories)])


@query
def unmatched(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _flags(spark, sf_dir).select("posting", "others")


@query
def score_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The wide log, appended in two runs and read back."""
    path = work_path(spark, "log")
    log = write_stage(classify.score_log(_ranked(spark, sf_dir), fx.THRESHOLD), "log")
    for run in (1, 2, 2):
        files.append_log(log, path, run)
    read = spark.read.parquet(path)
    ranks = [c for n in range(1, 6) for c in (F.col(f"top_{n}_category"), F.round(f"top_{n}_score", 4).alias(f"top_{n}_score"))]
    return read.select(
        big("run").alias("run"), "incentive", *ranks, "best_category", F.round("best_score", 4).alias("best_score"), "threshold",
        big("assigned").alias("assigned"),
    )


@query
def classified_postings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Benefits of postings: each distinct phrase scored once, decisions joined back."""
    p = fields.direct_benefits(fx.postings(spark, sf_dir)).withColumn("phrases", F.array().cast("array<string>"))
    rows = classify.phrase_rows(p, ["_id"])
    decided = classify.classify_distinct(
        rows, fx.phrase_vectors(spark, sf_dir), fx.prototypes(spark, sf_dir), ["_id", "pos"], fx.THRESHOLD
    )
    return decided.select(
        "_id", big("pos").alias("pos"), "phrase", "best_category", F.round("best_score", 4).alias("best_score"),
        big("assigned").alias("assigned"),
    )


# --- model answers -----------------------------------------------------------


@query
def response_experience(spark: SparkSession, sf_dir: str) -> DataFrame:
    return responses.experience(fx.responses(spark, sf_dir)).select("_id", big("experience").alias("experience"))


@query
def response_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    r = responses.phrases(fx.responses(spark, sf_dir))
    return r.select("_id", joined("phrases").alias("phrases"), big(F.size("phrases")).alias("n"))


CUTS = ["", '", "Rad', '", ', '", "x\\', "\\u00", '"], "n', '"], "n":', '"], "n": tr', '"], "n": 12']


@query
def response_repaired(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Answers cut off in eight ways, and whole ones, closed: the JSON, what was added, where the answer ended, and the phrases read."""
    k = F.col("o_orderkey")
    text = F.concat(F.when(k % 2 == 1, "Antwort: ").otherwise(""), F.lit('{"benefits": ["Urlaub '), k.cast("string"))
    whole = F.concat(text, F.lit('", "Rad"], "n": 1} Ende'))
    answers = spread(fx.table(spark, sf_dir, "orders").select("o_orderkey")).select(
        k.alias("order_key"), F.when(k % 9 == 0, whole).otherwise(F.concat(text, fx.pick(CUTS, k % 9))).alias("benefits_response")
    )
    fixed = responses.phrases(answers.withColumn("r", responses.repaired(F.col("benefits_response"))), repair=True)
    return fixed.select("order_key", "r.json", "r.closed", big("r.stopped_at").alias("stopped_at"), joined("phrases").alias("phrases"))


@query
def response_category(spark: SparkSession, sf_dir: str) -> DataFrame:
    return responses.branch(fx.responses(spark, sf_dir)).select("_id", "branch")


@query
def response_category_strict(spark: SparkSession, sf_dir: str) -> DataFrame:
    return responses.branch(fx.responses(spark, sf_dir), strict=True).select("_id", "branch")


# --- evaluation --------------------------------------------------------------

EVAL_FLAGS = ["Boni", "13._Gehalt", "Homeoffice", "Aktienoptionen/Gewinnbeteiligung"]
EVAL_TEXTS = ["Stadt", "Position", "Datum"]


def _labelled(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Finished rows of all postings with a few flags and texts."""
    p = fx.postings(spark, sf_dir)
    for step in (fields.search_text, fields.company_and_location, fields.position, geo.place_names):
        p = step(p)
    p = fields.posting_date(p, fx.AS_OF)
    k = F.col("k")
    flag = lambda step: (k % step == 0).cast("int")
    return p.select(
        "k", F.col("url").alias("Job URL"), F.when(k % 101 != 0, F.col("company")).alias("Unternehmen"),
        flag(2).alias("Boni"), flag(3).alias("13. Gehalt"), flag(5).alias("Homeoffice"), flag(7).alias("shares"),
        F.get("places", F.lit(0)).alias("Stadt"), F.col("position").alias("Position"), F.col("posting_date").alias("Datum"),
        k.alias("row no"),
    )


def _validation(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _labelled(spark, sf_dir).withColumnRenamed("shares", "Aktienoptionen/Gewinnbeteiligung")
    return rows.where(F.col("k") % 3 != 0).drop("k")


def _export(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("k")
    rows = _labelled(spark, sf_dir).withColumnRenamed("shares", "Aktienoptionen_Gewinnbeteiligung").where((k % 5 != 0) | (k % 15 == 0))
    flips = {c: F.when(k % 11 == 0, 1 - named(c)).otherwise(named(c)) for c in ("Boni", "13. Gehalt", "Homeoffice")}
    changes = {
        c: F.when(k % 19 == 0, F.lit(None)).when(k % 17 == 0, F.concat(F.lit("~"), c)).when(k % 13 == 0, F.concat(c, F.lit(" "))).otherwise(F.col(c))
        for c in EVAL_TEXTS
    }
    return rows.withColumns({**flips, **changes}).drop("k")


def _scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return evaluate.compare(_validation(spark, sf_dir), _export(spark, sf_dir), EVAL_FLAGS, EVAL_TEXTS)


@query
def eval_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _scores(spark, sf_dir).select("scope", "column_name", *[big(c).alias(c) for c in evaluate.COUNTERS])


@query
def eval_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _scores(spark, sf_dir).select(
        "scope", "column_name", F.round("accuracy", 6).alias("accuracy"), F.round("recall", 6).alias("recall")
    )


@query
def eval_dataset_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return evaluate.dataset_counts(_validation(spark, sf_dir), _export(spark, sf_dir))


@query
def eval_label_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labels against a rule on the documents: long ones are good, and none is toxic."""
    labels = fx.table(spark, sf_dir, "labels").select("doc_id", "quality", "toxic")
    ruled = fx.table(spark, sf_dir, "documents").select(
        "doc_id", (F.col("n_chars") > 500).cast("int").alias("quality"), F.lit(0).alias("toxic")
    )
    pairs = evaluate.reconcile(labels, ruled, ["doc_id"])
    scored = evaluate.with_scores(evaluate.roll_up(evaluate.cell_counts(pairs, ["quality", "toxic"], [])))
    return scored.select(
        "scope", "column_name", *[big(c).alias(c) for c in evaluate.COUNTERS], F.round("accuracy", 6).alias("accuracy"),
        F.round("recall", 6).alias("recall"),
    )


def _keys(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    v, e = (evaluate.prepare(d).select(*evaluate.KEY).dropna() for d in (_validation(spark, sf_dir), _export(spark, sf_dir)))
    return v, e


@query
def key_intersect(spark: SparkSession, sf_dir: str) -> DataFrame:
    return evaluate.keys_in_both(*_keys(spark, sf_dir))


@query
def key_except(spark: SparkSession, sf_dir: str) -> DataFrame:
    v, e = _keys(spark, sf_dir)
    left = evaluate.keys_only_left(v, e).withColumn("side", F.lit("validation"))
    return left.unionAll(evaluate.keys_only_left(e, v).withColumn("side", F.lit("export")))


@query
def metric_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scores appended to the history in two runs; one row per run."""
    path = work_path(spark, "history")
    scores = write_stage(_scores(spark, sf_dir), "scores")
    for stamp in ("2025-05-05 10:00:00", "2025-05-05 11:00:00"):
        files.append_history(evaluate.history_rows(scores, stamp), path, stamp)
    wide = files.read_history(spark, path)
    return wide.select(
        "run_ts", *[F.round(c, 6).alias(c) for c in ("overall_accuracy", "overall_recall", "incentive_accuracy", "non_incentive_recall")],
        F.round("Boni_accuracy", 6).alias("boni_accuracy"), F.round("Stadt_recall", 6).alias("stadt_recall"),
        F.col("Verpflegung_recall").isNull().alias("verpflegung_missing"),
    )


@query
def eval_missing_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labels with NaN and NULL cells against a rule, one column of it as text."""
    k = F.col("doc_id")
    quality, toxic = F.col("quality").cast("double"), F.col("toxic").cast("double")
    labels = fx.table(spark, sf_dir, "labels").select(
        k, F.when(k % 4 == 0, F.lit(float("nan"))).when(k % 7 != 0, quality).alias("quality"), toxic.alias("toxic"), quality.cast("int").alias("kind")
    )
    ruled = fx.table(spark, sf_dir, "documents").select(
        k, F.when(k % 5 == 0, F.lit(float("nan"))).otherwise(F.lit(1.0)).alias("quality"), F.when(k % 3 != 0, F.lit(0)).alias("toxic"),
        F.lit("1").alias("kind"),
    )
    pairs = evaluate.reconcile(labels, ruled, ["doc_id"])
    cells = evaluate.cell_counts(pairs, ["quality", "toxic", "kind"], [])
    return cells.select("column_name", *[big(c).alias(c) for c in evaluate.COUNTERS])


# --- incremental work --------------------------------------------------------


def _arrivals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as arriving documents: ids repeat per customer and priority, some are empty."""
    k = F.col("o_orderkey")
    return fx.table(spark, sf_dir, "orders").select(
        F.when(k % 10 == 0, F.lit("")).otherwise(F.concat_ws("/", "o_custkey", "o_orderpriority")).alias("_id"), k.alias("ord")
    )


def _skipped(spark: SparkSession, sf_dir: str) -> DataFrame:
    loaded = _arrivals(spark, sf_dir).where((F.col("ord") % 4 == 0) & (F.col("_id") != "")).select("_id")
    return skip_known(_arrivals(spark, sf_dir), loaded, ["ord"])


@query
def incremental_skip(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _skipped(spark, sf_dir).select("_id", "ord")


@query
def skip_by_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids that neither of two runs has added, by the filters and then exactly."""
    path, arrivals = work_path(spark, "known"), _arrivals(spark, sf_dir)
    known_ids.add(arrivals.where(F.col("ord") % 4 == 0).select("_id"), path, 1)
    known_ids.add(arrivals.where(F.col("ord") % 8 == 1).select("_id"), path, 2)
    found = write_stage(known_ids.looked_up(arrivals.select("_id"), path, 3), "looked_up")
    return known_ids.new_ids(found, path, 3).select(F.col("id").alias("_id"))


@query
def run_counters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return joins.run_counters(_arrivals(spark, sf_dir), _skipped(spark, sf_dir))


def _table_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Result rows of all postings with the plain fields only."""
    p = fields.company_and_location(fields.rule_fields(fx.postings(spark, sf_dir), fx.AS_OF))
    p = geo.explode_places(geo.place_names(p).withColumns({"ord": F.col("_id"), "experience": F.lit(0), "branch": F.lit("Andere")}))
    p = p.select("*", F.posexplode_outer("time_models").alias("time_model_pos", "time_model"), F.lit("x").alias("state"), F.lit("y").alias("country"))
    return load_plan.finished(p.withColumns({c: F.lit(0) for c in fv.FLAG_COLUMNS} | {"others": F.lit("")}))


@query
def upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two runs into the result table, the second repeated; the last row of every key stays."""
    path = work_path(spark, "result")
    result_table.create(spark, path)
    rows = write_stage(_table_rows(spark, sf_dir), "rows")
    number = F.substring("MongoDB_ID", 2, 20).cast("bigint")
    result_table.merge_rows(rows.where((number % 2 == 1) | (number % 3 == 1)), path, 1)
    for _ in range(2):
        result_table.merge_rows(rows.where(number % 3 != 1), path, 2)
    now = result_table.current(spark, path)
    return now.select(*[F.col(c) for c in fv.RESULT_KEY], "MongoDB_ID", "Unternehmen", F.col("Unternehmensgröße").alias("size_bucket"))


@query
def compacted_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The runs of ``upsert`` with the first one compacted to a base before the second comes."""
    path, base = work_path(spark, "result"), work_path(spark, "base")
    result_table.create(spark, path)
    rows = write_stage(_table_rows(spark, sf_dir), "rows")
    number = F.substring("MongoDB_ID", 2, 20).cast("bigint")
    result_table.merge_rows(rows.where((number % 2 == 1) | (number % 3 == 1)), path, 1)
    result_table.compact(spark, path, base, 1)
    for _ in range(2):
        result_table.merge_rows(rows.where(number % 3 != 1), base, 2)
    now = result_table.current(spark, base)
    return now.select(*[F.col(c) for c in fv.RESULT_KEY], "MongoDB_ID", "Unternehmen", F.col("Unternehmensgröße").alias("size_bucket"))


@query
def export_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The result table exported as CSV and read back."""
    path, target = work_path(spark, "result"), work_path(spark, "csv")
    nothing = files.export_table(spark, path, target)
    result_table.create(spark, path)
    result_table.merge_rows(write_stage(_table_rows(spark, sf_dir), "rows"), path, 1)
    done = files.export_table(spark, path, target)
    read = underscore_names(read_csv(spark, target, "ID bigint, " + ", ".join(f"`{c}` string" for c in load_plan.RESULT_COLUMNS)))
    return read.groupBy("Portal_Name", "Zeitmodell", "Position").agg(
        F.count(F.lit(1)).alias("n"), F.countDistinct("Job_URL").alias("urls"), F.sum(F.length("Job_Titel")).alias("title_chars"),
        F.lit(nothing).alias("without_table"), F.lit(done).alias("with_table"),
    )


@query
def stream_incremental(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events landing in three runs; each run keeps the first row of ids not seen before."""
    landing, target, checkpoint = (work_path(spark, n) for n in ("landing", "kept", "checkpoint"))
    events = fx.table(spark, sf_dir, "events").select(
        "event_id", F.concat_ws("/", "user_id", "event_type").alias("id"), "value"
    )
    top = events.agg(F.max("event_id")).first()[0] + 1
    for part in range(3):
        slot = F.floor(F.col("event_id") * 3 / top)
        events.where(slot == part).write.mode("append").parquet(landing)
        stream = spark.readStream.schema(events.schema).parquet(landing)
        incremental.keep_new(stream, "id", ["event_id"], target, checkpoint)
    return spark.read.parquet(target).select("event_id", "id", "value")


@query
def stream_state_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events landing in three parts, the stream stopped and started again between them; what was seen is keyed state."""
    landing, target, checkpoint = (work_path(spark, n) for n in ("landing", "kept", "checkpoint"))
    events = fx.table(spark, sf_dir, "events").select("event_id", F.concat_ws("/", "user_id", "event_type").alias("id"), "value")
    top = events.agg(F.max("event_id")).first()[0] + 1
    for part in range(3):
        events.where(F.floor(F.col("event_id") * 3 / top) == part).write.mode("append").parquet(landing)
        seen.keep_first(spark.readStream.schema(events.schema).parquet(landing), "id", ["event_id"], target, checkpoint)
    return spark.read.parquet(target).select("event_id", "id", "value")


@query
def load_postings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole load job on JSON documents: two runs, the second meets all documents of the first again."""
    path = work_path(spark, "result")
    raw = fx.documents(spark, sf_dir)
    inputs = fx.load_inputs(spark, sf_dir)
    load_plan.load(spark, raw.where(F.col("k") % 2 == 0).drop("k"), path, 1, inputs)
    load_plan.load(spark, raw.drop("k"), path, 2, inputs)
    return _loaded(spark, path)


@query
def load_with_hooks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The load with models: prompts to a generator, its answers read, names translated. A second load of all documents finds every answer in the store."""
    path, store = work_path(spark, "result"), work_path(spark, "answers")
    raw, inputs = fx.documents(spark, sf_dir), fx.load_inputs(spark, sf_dir)
    inputs.answer = load_plan.answers_from_models(*[fx.open_generator(n) for n in fx.ANSWERS], store=store, model="fixed")
    inputs.translations, inputs.translate = inputs.translations.limit(0), load_plan.names_from_model(fx.open_translator, store, "fixed")
    load_plan.load(spark, raw.where(F.col("k") % 2 == 0).drop("k"), path, 1, inputs)
    load_plan.load(spark, raw.drop("k"), path, 2, inputs)
    return _loaded(spark, path)


@query
def load_repeated_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents whose ids repeat, in two runs: of each id the first scanned one counts, not the one with the smallest URL."""
    path = work_path(spark, "result")
    # the documents of an id lie in one file, as files are scanned in an order of their own
    raw = write_stage(fx.repeated_documents(spark, sf_dir).repartitionByRange(4, F.floor(F.col("k") / 3)).sortWithinPartitions("k"), "landed")
    inputs = fx.load_inputs(spark, sf_dir)
    load_plan.load(spark, raw.where(F.col("k") % 4 < 2).drop("k"), path, 1, inputs)
    load_plan.load(spark, raw.drop("k"), path, 2, inputs)
    now = result_table.current(spark, path)
    return now.select("MongoDB_ID", "Job_URL", "Job_Titel", "Unternehmen")


def _loaded(spark: SparkSession, path: str) -> DataFrame:
    """The current result table with plain column names."""
    now = result_table.current(spark, path)
    flags = [big(named(c)).alias(f"flag_{n}") for n, c in enumerate(fv.FLAG_COLUMNS)]
    texts = [F.col(c).alias(c.replace("ö", "oe").replace("ß", "ss").replace("ä", "ae")) for c in fv.RESULT_TEXT_COLUMNS]
    return now.select(*texts, big(fv.EXPERIENCE_COLUMN).alias("experience"), fv.BRANCH_COLUMN, *flags, "others")


@query
def stream_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The load job over landed files: two landings, the second brings all documents of the first again."""
    path, checkpoint, log = (work_path(spark, n) for n in ("result", "checkpoint", "log"))
    raw, inputs = fx.documents(spark, sf_dir), fx.load_inputs(spark, sf_dir)
    folders = {c: work_path(spark, c) for c in ("stepstone", "indeed")}
    for landing in (raw.where(F.col("k") % 2 == 0), raw):
        with compiled_methods(spark):
            for collection, folder in folders.items():
                landing.where(F.col("collection") == collection).select("doc").write.mode("append").text(folder)
        streams = [incremental.read_landed(spark, folder, collection) for collection, folder in folders.items()]
        incremental.load_available(streams[0].unionByName(streams[1]), path, checkpoint, inputs, log_path=log)
    return _loaded(spark, path)
