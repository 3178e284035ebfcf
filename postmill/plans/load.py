"""The load job: raw documents to rows of the result table.

Mark each line in one scan, find new documents by their ids alone, open only those, derive fields, stage the
narrow result, classify distinct phrases, resolve distinct places, fan out, merge into the table.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass, field
from functools import partial

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from postmill import fixed_values as fv
from postmill.functions.names import named
from postmill.operators import classify, fields, geo, hooks, prompts, responses
from postmill.operators.joins import BROADCAST_ROWS, ROWS_PER_TASK, first_per_key, join_small, lookup_by_key
from postmill.schemas import RESULT_COLUMNS
from postmill.session import job, write_stage
from postmill.sinks import answers, files, result_table
from postmill.sources.collections import canonical, is_document, with_ids, with_order

RESPONSE_COLUMNS = ["experience_response", "benefits_response", "branch_response"]


@dataclass
class LoadInputs:
    """What a load needs besides the documents.

    ``answer`` takes postings with ``ord`` and the prompt inputs and returns
    them with the three response columns; ``embed`` takes distinct phrases and
    returns them with ``embedding``. Both may be table joins or model hooks. ``translate``
    takes names ``(src, lang_pair)`` which the table of translations lacks, and returns them with ``dst``.
    """

    answer: Callable[[DataFrame], DataFrame]
    embed: Callable[[DataFrame], DataFrame]
    prototypes: classify.Prototypes
    gazetteer: DataFrame
    translations: DataFrame
    translate: Callable[[DataFrame], DataFrame] | None = None
    home: str = fv.HOME_COUNTRY
    home_label: str = fv.HOME_COUNTRY_LABEL
    state_names: dict[str, str] = field(default_factory=lambda: dict(fv.STATE_NAMES))
    as_of: str | Column | None = None
    threshold: float = fv.THRESHOLD
    rows_per_task: int = ROWS_PER_TASK
    broadcast_rows: int = BROADCAST_ROWS


def answers_from_table(table: DataFrame) -> Callable[[DataFrame], DataFrame]:
    """Responses by document id, one row each. Documents without an id have keys of their own in ``ord`` and meet nothing."""
    keyed = table.select(F.col("_id").alias("ord"), *RESPONSE_COLUMNS)
    return lambda postings: postings.join(keyed, "ord", "left")


def answers_from_models(
    open_experience, open_benefits, open_branch, settings: Mapping[str, Mapping] = fv.GENERATOR_SETTINGS, batch_size: int = hooks.BATCH_SIZE,
    store: str | None = None, model: str = "",
) -> Callable[[DataFrame], DataFrame]:
    """Responses by three generator hooks, opened once per partition each with their settings as keywords.

    Only the key and the prompts cross to Python, once for all three. With ``store``, a path, answers are kept there under the ``model``'s name, and
    only prompts without an answer are asked.
    """
    openers = {"experience": open_experience, "benefits": open_benefits, "branch": open_branch}
    asked = {f"{n}_response": (f"{n}_prompt", partial(hook, **settings.get(n, {}))) for n, hook in openers.items()}

    def answer(postings: DataFrame) -> DataFrame:
        if store:
            # derived once; the prompts are put together again for each use, which costs less than to write and read them
            postings = write_stage(postings, "read")
        prompted = prompts.prompts(postings).select("ord", *[text for text, _ in asked.values()])
        if store:
            own = {name: settings.get(name.removesuffix("_response"), {}) for name in asked}
            keyed = prompted.select("ord", *[answers.digest(F.col(text), model, own[name]).alias(f"_{name}") for name, (text, _) in asked.items()])
            for name, (text, hook) in asked.items():
                found = answers.ask(prompted, text, hook, store, model, own[name], batch_size=batch_size)
                keyed = answers.with_answers(keyed, f"_{name}", name, found)
            return postings.join(keyed, "ord", "left")
        return postings.join(hooks.add_by_models(prompted, asked, T.StringType(), batch_size), "ord", "left")

    return answer


def vectors_from_table(table: DataFrame) -> Callable[[DataFrame], DataFrame]:
    """Vectors by phrase, one row each; a phrase without a vector stays unmatched."""
    return lambda distinct: distinct.join(table.select("phrase", "embedding"), "phrase", "left")


def vectors_from_model(open_embedder) -> Callable[[DataFrame], DataFrame]:
    """Vectors by an embedding hook, opened once per partition."""
    return lambda distinct: hooks.embed(distinct, "phrase", open_embedder)


def marked(raw: DataFrame) -> DataFrame:
    """The lines of ``raw`` with ``is_document``, ``_id``, ``scan`` and ``ord``; written as a stage, this is the only look at raw text."""
    return with_order(with_ids(raw.select("collection", "doc", is_document().alias("is_document"))))


def names_from_model(open_translator: Callable[[str], Callable], store: str, model: str = "") -> Callable[[DataFrame], DataFrame]:
    """Translations by a hook for each direction (``open_translator(lang_pair)`` opens one), kept in a store of answers."""

    def translated(names: DataFrame) -> DataFrame:
        parts = []
        for lang_pair in ("de>en", "en>de"):
            own = names.where(F.col("lang_pair") == lang_pair).select("src").distinct()
            found = answers.answered(own, "src", "dst", partial(open_translator, lang_pair), store, model, {"lang_pair": lang_pair})
            parts.append(found.select("src", F.coalesce("dst", "src").alias("dst"), F.lit(lang_pair).alias("lang_pair")))
        return parts[0].unionByName(parts[1])

    return translated


def all_translations(places: DataFrame, inputs: LoadInputs) -> DataFrame:
    """The table of translations, with what the model says of names it lacks.

    Asked are place names that are no city of the gazetteer, its states and countries, and what these are called after the first
    translation, as a hit by a translated city is named twice.
    """
    given = inputs.translations.select("src", "dst", "lang_pair")
    if not inputs.translate:
        return given

    def model(names: DataFrame, lang_pair: str, known: DataFrame) -> DataFrame:
        lacking = names.toDF("src").where("src <> ''").distinct().withColumn("lang_pair", F.lit(lang_pair))
        return write_stage(inputs.translate(lacking.join(known, ["src", "lang_pair"], "left_anti")).select("src", "dst", "lang_pair"), "translated")

    cities = inputs.gazetteer.select(F.lower("city").alias("_city")).distinct()
    unknown = places.join(cities, F.lower("place") == F.col("_city"), "left_anti").select("place")
    regions = inputs.gazetteer.select(F.explode(F.array("state", "country")).alias("src"))
    both = given.unionByName(model(unknown, "de>en", given)).unionByName(model(regions, "en>de", given))
    shown = both.where("lang_pair = 'en>de'").select("dst").unionByName(
        inputs.gazetteer.sparkSession.createDataFrame([(n,) for n in [*inputs.state_names.values(), inputs.home_label]], "dst string")
    )
    return both.unionByName(model(shown, "en>de", both))


def new_documents(lines: DataFrame, table: str, run: int, broadcast_rows: int = BROADCAST_ROWS) -> DataFrame:
    """Documents of marked ``lines`` whose id no earlier run holds, unopened, with ``scan`` and ``ord``.

    The new ids are worked out from the ids alone, against the filters of the known ones first. Most are known in a
    regular run, so the new ids are few and their checked set is broadcast. Long texts are shuffled only when a run brings
    more new ids than that. Documents without an id match no id and are kept.
    """
    documents = lines.where("is_document").drop("is_document")
    if not result_table.has_ids(lines.sparkSession, table, run):
        return documents.drop("_id")
    looked_up = write_stage(result_table.looked_up_ids(documents.select("_id"), table, run), "looked_up")
    fresh = write_stage(result_table.unknown_ids(looked_up, table, run).select(F.col("id").alias("_id"), F.lit(True).alias("_new")), "new_ids")
    met = join_small(documents, fresh, "_id", broadcast_rows)
    return met.where(F.col("_new") | (F.col("_id") == "")).drop("_new", "_id")


def derive(documents: DataFrame, inputs: LoadInputs) -> DataFrame:
    """Narrow derived rows, one per document."""
    postings = fields.rule_fields(fields.with_texts(canonical(documents)), inputs.as_of)
    postings = fields.direct_benefits(fields.benefits_text(fields.description(postings)))
    # Of documents with the same id the first one of the scan counts. Most of their columns are
    # not read below, so that narrow rows are compared, and each task drops its
    # repeats before the shuffle, which the join with the answers then uses as well.
    once = first_per_key(
        postings.drop("lists", "paragraphs", fields.LINES, fields.PARAGRAPHS),
        ["ord"], ["scan"],
    )
    read = inputs.answer(once)
    read = responses.branch(responses.phrases(responses.experience(read)))
    return geo.place_names(read).select(
        "ord", "collection", "_id", "url", "job_title", "portal", "posting_date", "company", "size_bucket",
        "time_models", "position", "employment", "experience", "branch", "remote", "places", "direct_benefits",
        "phrases",
    )


def decide_phrases(staged: DataFrame, inputs: LoadInputs) -> DataFrame:
    """Every phrase of every posting with its decision; each distinct phrase is embedded and scored once."""

    def answer(distinct: DataFrame) -> DataFrame:
        ranked = classify.score_ranked(inputs.embed(distinct), inputs.prototypes)
        return classify.decide(ranked, inputs.threshold)

    occurrences = classify.phrase_rows(staged, ["ord"])
    return lookup_by_key(occurrences, "phrase", answer, ["ord", "pos"], rows_per_task=inputs.rows_per_task)


def result_rows(staged: DataFrame, decided: DataFrame, inputs: LoadInputs) -> DataFrame:
    """Result rows: posting × place × time model, with their order of writing."""
    flags = classify.flags_and_unmatched(decided, ["ord"])
    places = geo.explode_places(staged.select("ord", "places"))
    translations = all_translations(places.select("place").distinct(), inputs)
    index = write_stage(
        geo.gazetteer_index(
            inputs.gazetteer, translations, inputs.home, inputs.home_label, inputs.state_names
        ),
        "gazetteer",
    )
    rows = geo.resolve_places(
        geo.explode_places(staged.join(flags, "ord", "left")),
        index,
        translations,
        ["ord", "place_pos"],
        counted=places,
        rows_per_task=inputs.rows_per_task,
    )
    rows = rows.select("*", F.posexplode_outer("time_models").alias("time_model_pos", "time_model"))
    return finished(rows)


def finished(rows: DataFrame) -> DataFrame:
    """The result columns, in order, from derived ones; defaults filled in."""
    source = {
        "MongoDB_ID": "_id", "Job_URL": "url", "Job_Titel": "job_title", "Portal_Name": "portal", "Datum": "posting_date",
        "Stadt": "place", "Bundesland": "state", "Land": "country", "Unternehmen": "company",
        "Unternehmensgröße": "size_bucket", "Zeitmodell": "time_model", "Position": "position",
        "Beschäftigungsart": "employment", fv.EXPERIENCE_COLUMN: "experience", fv.BRANCH_COLUMN: "branch",
    }

    def column(name: str) -> Column:
        if name in source:
            return F.col(source[name])
        if name == fv.REMOTE_CATEGORY:
            return fields.either_flag(F.col("remote"), F.col(name))
        if name in fv.FLAG_COLUMNS:
            return F.coalesce(named(name), F.lit(0))
        return F.coalesce(F.col(name), F.lit(""))

    seq = F.struct("collection", "ord", "place_pos", "time_model_pos").alias("seq")
    return rows.select(*[column(c).alias(c) for c in RESULT_COLUMNS], seq)


def load(
    spark: SparkSession, raw: DataFrame, table: str, run: int, inputs: LoadInputs, log_path: str | None = None
) -> DataFrame:
    """Load ``raw`` ``(doc, collection)`` as run ``run``; returns the run counters.

    Lines which are no JSON objects are rejected: kept beside the table and counted, never loaded.
    Runs must be numbered upwards from 1. Repeating the last run gives the same table; an earlier one is refused.
    """
    with job(spark):
        result_table.create(spark, table)
        lines = write_stage(marked(raw), "lines")
        write_rejects(lines, table, run)
        documents = new_documents(lines, table, run, inputs.broadcast_rows)
        staged = write_stage(derive(documents, inputs), "derived")
        decided = decide_phrases(staged, inputs)
        if log_path:
            decided = write_stage(decided, "decided")
            files.append_log(classify.score_log(decided, inputs.threshold), log_path, run)
        result_table.append_run(write_stage(result_rows(staged, decided, inputs), "result_rows"), table, run)
        total, rejected = lines.agg(F.count(F.lit(1)), F.count_if(~F.col("is_document"))).first()
        new = staged.count()
    counted = [(total - rejected, new, total - rejected - new, rejected)]
    return spark.createDataFrame(counted, "total_jobs bigint, new_jobs bigint, skipped_jobs bigint, rejected_lines bigint")


def write_rejects(lines: DataFrame, table: str, run: int) -> None:
    """Marked lines which are no JSON objects, kept with their text as ``rejects/run=<n>``. Writing a run again replaces it."""
    lines.where("NOT is_document").select("collection", "doc").write.mode("overwrite").parquet(f"{table}/rejects/run={run}")


def rejects(spark: SparkSession, table: str) -> DataFrame:
    """``(collection, doc, run)`` of all rejected lines."""
    return spark.read.schema("collection string, doc string, run long").parquet(f"{table}/rejects")
