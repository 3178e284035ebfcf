"""Skipping, upsert, the load job and its streaming form."""

import json
import os
from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from postmill import fixed_values as fv
from postmill.operators.joins import first_per_key, join_small, skip_known
from postmill.plans import evaluation
from postmill.plans import fixtures as fx
from postmill.plans import load as load_plan
from postmill.schemas import RESULT_COLUMNS
from postmill.session import job, shared_folder
from postmill.sinks import files, keyed_table, known_ids, result_table
from postmill.sources.collections import read_collections
from postmill.streaming import incremental


def result_rows(spark, rows):
    """Rows from ``(id, url, city, company, ord)``."""
    df = spark.createDataFrame(rows, "i string, u string, c string, n string, o string")
    given = {"MongoDB_ID": "i", "Job_URL": "u", "Stadt": "c", "Unternehmen": "n", "Zeitmodell": None, "Position": None}
    numbers = set(fv.FLAG_COLUMNS) | {fv.EXPERIENCE_COLUMN}
    columns = [
        F.col(given[c]).alias(c) if given.get(c) else (F.lit(0) if c in numbers else F.lit("x")).alias(c) for c in RESULT_COLUMNS
    ]
    seq = F.struct(F.lit("c").alias("collection"), F.col("o").alias("ord"), F.lit(0).alias("place_pos"), F.lit(0).alias("time_model_pos"))
    return df.select(*columns, seq.alias("seq"))


def content(spark, path):
    return sorted((r.Job_URL, r.Stadt, r.MongoDB_ID, r.Unternehmen) for r in result_table.current(spark, path).collect())


def test_skip_known(spark):
    rows = [("a", 1), ("b", 2), ("b", 3), ("", 4), ("", 5), (None, 6), ("c", 7)]
    df = spark.createDataFrame(rows, "_id string, ord int")
    known = spark.createDataFrame([("a",), ("a",), ("",)], "x string")
    assert sorted(r.ord for r in skip_known(df, known, ["ord"]).collect()) == [2, 4, 5, 6, 7]


def test_first_rows_and_checked_broadcast(spark):
    df = spark.range(100).withColumn("k", F.col("id") % 3)
    assert sorted(r.id for r in first_per_key(df, ["k"], [F.col("id").desc()], 2).collect()) == [94, 95, 96, 97, 98, 99]
    small = spark.createDataFrame([(0, "x")], "k long, v string")
    for limit in (0, 10):
        joined = join_small(df, small, "k", limit)
        assert joined.where("v = 'x'").count() == 34 and joined.count() == 100


def test_upsert_last_wins_and_repeats_change_nothing(spark, tmp_path):
    path = str(tmp_path / "t")
    result_table.create(spark, path)
    assert content(spark, path) == []
    first = result_rows(spark, [("1", "u", "c", "old", "1"), ("2", "u", "c", "newer", "2"), ("3", "v", "c", "n", "3")])
    result_table.append_run(first, path, 1)
    once = content(spark, path)
    assert once == [("u", "c", "2", "newer"), ("v", "c", "3", "n")]
    result_table.create(spark, path)
    result_table.append_run(first, path, 1)
    result_table.append_run(first, path, 2)
    assert content(spark, path) == once
    result_table.append_run(result_rows(spark, [("4", "v", "c", "late", "0"), ("5", "", "c", "e", "1"), ("", "", "d", "e", "2")]), path, 3)
    assert content(spark, path) == [("", "c", "5", "e"), ("", "d", "", "e"), ("u", "c", "2", "newer"), ("v", "c", "4", "late")]
    assert sorted(r[0] for r in result_table.known_ids(spark, path, 4).collect()) == ["1", "2", "3", "4", "5"]
    assert sorted(r[0] for r in result_table.known_ids(spark, path, 3).collect()) == ["1", "2", "3"]
    moved = str(tmp_path / "moved")
    result_table.compact(spark, path, moved, 3)
    assert content(spark, moved) == content(spark, path)
    assert result_table.known_ids(spark, moved, 4).count() == 5
    result_table.append_run(result_rows(spark, [("6", "u", "c", "after", "1"), ("7", "u", "e", "n", "2")]), moved, 4)
    assert content(spark, moved) == [
        ("", "c", "5", "e"), ("", "d", "", "e"), ("u", "c", "6", "after"), ("u", "e", "7", "n"), ("v", "c", "4", "late"),
    ]
    again = str(tmp_path / "again")
    result_table.compact(spark, moved, again, 4)
    assert content(spark, again) == content(spark, moved)
    assert sorted(r[0] for r in result_table.known_ids(spark, again, 5).collect()) == ["1", "2", "3", "4", "5", "6", "7"]


def test_export(spark, tmp_path):
    path, csv = str(tmp_path / "t"), str(tmp_path / "csv")
    assert not files.export_table(spark, path, csv) and not os.path.exists(csv)
    result_table.create(spark, path)
    result_table.append_run(result_rows(spark, [("1", "u", 'a "b", c\nd', "ä", "1")]), path, 1)
    assert files.export_table(spark, path, csv)
    row = spark.read.options(header=True, multiLine=True, escape='"').csv(csv).first()
    assert row.Stadt == 'a "b", c\nd' and row.Unternehmen == "ä" and row["13. Gehalt"] == "0"


def test_history_grows(spark, tmp_path):
    path = str(tmp_path / "h")
    schema = "Job_URL string, Unternehmen string, Boni int, Stadt string, row_no int"
    left, right = (spark.createDataFrame([("u", "c", n, "s", 1)], schema) for n in (1, 0))
    evaluation.run(left, left, path, "2025-01-01 00:00:00")
    evaluation.run(left, right, path, "2025-01-02 00:00:00")
    rows = {r.run_ts: r for r in files.read_history(spark, path).collect()}
    assert rows["2025-01-01 00:00:00"].overall_accuracy == 1.0
    assert rows["2025-01-02 00:00:00"].overall_accuracy == pytest.approx(1 / 3)
    assert rows["2025-01-02 00:00:00"].Boni_recall == 0.0 and rows["2025-01-02 00:00:00"]["13._Gehalt_recall"] is None


def test_a_repeated_evaluation_replaces_its_figures(spark, tmp_path):
    path = str(tmp_path / "h")
    table = spark.createDataFrame([("u", "c", 1, "s", 1)], "Job_URL string, Unternehmen string, Boni int, Stadt string, row_no int")
    counts = []
    for _ in range(2):
        evaluation.run(table, table, path, "2025-01-01 00:00:00")
        counts.append(spark.read.parquet(path).count())
    evaluation.run(table, table, path, "2025-01-02 00:00:00")
    assert counts[0] == counts[1] > 0 and spark.read.parquet(path).count() == 2 * counts[0]
    assert files.read_history(spark, path).count() == 2


def test_history_keeps_other_columns(spark, tmp_path):
    path = str(tmp_path / "h")
    table = spark.createDataFrame([("u", "c", 1, 1)], "Job_URL string, Unternehmen string, Extra int, row_no int")
    evaluation.run(table, table, path, "2025-01-01 00:00:00", flags=["Extra"], texts=[])
    assert files.read_history(spark, path).first().Extra_accuracy == 1.0


DOCS = [
    {"_id": f"d{n}", "url": f"https://www.p{n % 4}.de/{n % 6}", "lists": {"company": [["C", ["Ulm", "Paris, Ulm", "Nix"][n % 3]]]},
     "paragraphs": [["teilzeit", "ganztags und teilzeit"][n % 2]], "benefits": ["Dienstrad", f"Leistung {n + 20}"][: n % 3]}
    for n in range(12)
] + [{"url": "https://x.com/a", "benefits": ["Laptop neu"]}] * 3 + [{"_id": "d3", "url": "repeat"}]


@pytest.fixture(scope="module")
def inputs(spark, sf_dir):
    given = fx.load_inputs(spark, sf_dir)
    given.gazetteer = spark.createDataFrame(
        [("Ulm", "Staat_1", "EUROPE", 1), ("Paris", "Ile", "ASIA", 2)], "city string, state string, country string, ord long"
    )
    return given


def landed(tmp_path, name, docs):
    folder = tmp_path / name
    folder.mkdir(exist_ok=True)
    return folder, [json.dumps(d, ensure_ascii=False) for d in docs]


def whole(spark, path):
    return sorted(tuple(str(v) for v in r) for r in result_table.current(spark, path).collect())


def test_load_twice_and_in_parts(spark, tmp_path, inputs):
    folder, lines = landed(tmp_path, "all", DOCS)
    (folder / "a.json").write_text("\n".join(lines), encoding="utf-8")
    raw = read_collections(spark, {"c": str(folder)})
    path = str(tmp_path / "t")
    counters = load_plan.load(spark, raw, path, 1, inputs, log_path=str(tmp_path / "log")).first()
    assert tuple(counters) == (16, 15, 1, 0)
    once = whole(spark, path)
    assert len({r[2] for r in once}) == 13 and any("Mapped_1" in r for r in once)
    assert spark.read.parquet(str(tmp_path / "log")).where("incentive = 'Laptop neu'").count() == 3

    assert tuple(load_plan.load(spark, raw, path, 1, inputs).first()) == (16, 15, 1, 0)
    assert whole(spark, path) == once
    again = load_plan.load(spark, raw, path, 2, inputs).first()
    assert (again.total_jobs, again.new_jobs, again.skipped_jobs) == (16, 3, 13)
    assert whole(spark, path) == once

    split, other = replace(inputs, rows_per_task=2, broadcast_rows=0), str(tmp_path / "other")
    assert load_plan.load(spark, raw.where("doc LIKE '%d1%'"), other, 1, split).first().new_jobs == 3
    assert load_plan.load(spark, raw, other, 2, split).first().new_jobs == 12
    assert sorted(r[2:] for r in whole(spark, other)) == sorted(r[2:] for r in once)


def test_first_scanned_document_of_an_id_wins(spark, tmp_path, inputs):
    docs = [{"_id": "same", "url": "https://www.z.de/1", "Job Title": "first"}, {"_id": "same", "url": "https://www.a.de/1", "Job Title": "second"}]
    folder, lines = landed(tmp_path, "repeats", docs)
    (folder / "a.json").write_text("\n".join(lines), encoding="utf-8")
    path = str(tmp_path / "t")
    load_plan.load(spark, read_collections(spark, {"c": str(folder)}), path, 1, inputs)
    assert {(r.Job_URL, r.Job_Titel) for r in result_table.current(spark, path).collect()} == {("https://www.z.de/1", "first")}


def test_rejected_lines(spark, tmp_path, inputs):
    """Broken and blank lines are kept and counted, never loaded, and never new again."""
    folder, lines = landed(tmp_path, "rejects", DOCS[:3])
    (folder / "a.json").write_text("\n".join([lines[0], '{"_id": "broken', "", *lines[1:], "[1]"]), encoding="utf-8")
    raw, path = read_collections(spark, {"c": str(folder)}), str(tmp_path / "t")
    assert tuple(load_plan.load(spark, raw, path, 1, inputs).first()) == (3, 3, 0, 3)
    assert tuple(load_plan.load(spark, raw, path, 2, inputs).first()) == (3, 0, 3, 3)
    assert sorted((r.doc, r.run) for r in load_plan.rejects(spark, path).collect()) == sorted(
        (doc, run) for doc in ('{"_id": "broken', "", "[1]") for run in (1, 2)
    )
    assert all(r[2] != "" for r in whole(spark, path))


def test_job_leaves_no_stage(spark, tmp_path, inputs):
    folder, lines = landed(tmp_path, "stages", DOCS[:3])
    (folder / "a.json").write_text("\n".join(lines), encoding="utf-8")
    work = os.path.join(shared_folder(spark), "postmill")
    before = set(os.listdir(work)) if os.path.exists(work) else set()
    load_plan.load(spark, read_collections(spark, {"c": str(folder)}), str(tmp_path / "t"), 1, inputs, log_path=str(tmp_path / "log")).collect()
    assert set(os.listdir(work)) == before


def test_stage_folder_must_be_shared(spark):
    class Context:
        master, applicationId = "spark://host:7077", "x"

    class Session:
        conf, sparkContext = {}, Context()

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        shared_folder(Session())


def test_stream_equals_batch(spark, tmp_path, inputs):
    docs = [{**d, "url": f"https://www.p.de/{n}"} for n, d in enumerate(DOCS[:12])]
    batch_folder, lines = landed(tmp_path, "batch", docs)
    (batch_folder / "a.json").write_text("\n".join(lines), encoding="utf-8")
    batch_table, stream_table = str(tmp_path / "bt"), str(tmp_path / "st")
    load_plan.load(spark, read_collections(spark, {"c": str(batch_folder)}), batch_table, 1, inputs)
    folder, _ = landed(tmp_path, "stream", docs)
    for n in range(3):
        part = lines[n * 4 : n * 4 + 4] + lines[:1]
        (folder / f"{n}.json").write_text("\n".join(part), encoding="utf-8")
        stream = incremental.read_landed(spark, str(folder), "c", max_files=1)
        incremental.load_available(stream, stream_table, str(tmp_path / "checkpoint"), inputs)
    assert keyed_table.runs(spark, stream_table) == [0, 1, 2, 3]
    ids = known_ids.known(spark, f"{stream_table}/known", 9, columns="*").collect()
    assert sorted(r.id for r in ids) == sorted(f"d{n}" for n in range(12))
    # every document has a url of its own, so no row displaces another, in whatever order files arrive
    assert whole(spark, batch_table) == whole(spark, stream_table) != []


def test_models_as_hooks(spark, inputs):
    answers = load_plan.answers_from_models(
        lambda **settings: (lambda prompts: ['{"Experience_Required": 1}' for _ in prompts]),
        lambda **settings: (lambda prompts: ['{"benefits": ["A"]}' for _ in prompts]),
        lambda **settings: (lambda prompts: ['{"Kategorie": "Recht"}' for _ in prompts]),
    )
    df = spark.createDataFrame([("1", "d", "b", "t")], "ord string, description string, benefits_text string, job_title string")
    row = answers(df).first()
    assert [row[c] for c in load_plan.RESPONSE_COLUMNS] == ['{"Experience_Required": 1}', '{"benefits": ["A"]}', '{"Kategorie": "Recht"}']
    vectors = load_plan.vectors_from_model(lambda: (lambda batch: [[1.0] * 64 for _ in batch]))
    assert vectors(spark.createDataFrame([("x", 3)], "phrase string, _rows long")).first()._rows == 3


def test_models_with_a_store_derive_postings_once(spark, tmp_path):
    """the postings were worked out again for the join with their answers."""
    calls = tmp_path / "calls"
    calls.mkdir()

    @F.udf("string")
    def counted(ord_):
        with open(calls / f"{os.getpid()}", "a", encoding="utf-8") as file:
            file.write(f"{ord_}\n")
        return f"d{ord_}"

    answer = load_plan.answers_from_models(
        *[(lambda n: lambda **settings: lambda prompts: [f"{n}{len(p)}" for p in prompts])(n) for n in "xyz"], store=str(tmp_path / "store"), model="m"
    )
    df = spark.createDataFrame([(str(n), "b" * (n % 3), "t") for n in range(9)] + [("9", None, "t")], "ord string, benefits_text string, job_title string")
    rows = {r.ord: r for r in answer(df.withColumn("description", counted("ord"))).collect()}
    assert sorted(rows) == [str(n) for n in range(10)] and {r.description for r in rows.values()} == {f"d{n}" for n in range(10)}
    assert [rows["0"][c][0] for c in load_plan.RESPONSE_COLUMNS] == ["x", "y", "z"]
    assert int(rows["1"].benefits_response[1:]) == int(rows["0"].benefits_response[1:]) + 1 and rows["9"].benefits_response is None
    assert sorted(line for path in calls.iterdir() for line in path.read_text().split()) == [str(n) for n in range(10)]


def test_a_load_runs_compiled_code(spark):
    """methods of over 8,000 bytes were left to the JVM's interpreter."""
    with job(spark):
        assert spark.conf.get("spark.sql.codegen.hugeMethodLimit") == "8000"
    assert int(spark.conf.get("spark.sql.codegen.hugeMethodLimit", "65535")) == 65535


def test_keep_new_within_watermark_is_a_stream(spark, tmp_path):
    folder = tmp_path / "s"
    folder.mkdir()
    (folder / "a.json").write_text('{"id": "a", "ts": "2025-01-01T00:00:00Z"}\n{"id": "a", "ts": "2025-01-01T00:00:01Z"}')
    stream = spark.readStream.schema("id string, ts timestamp").json(str(folder))
    out, checkpoint = str(tmp_path / "o"), str(tmp_path / "c")
    query = (
        incremental.keep_new_within(stream, "id", "ts", "1 hour").writeStream.format("parquet")
        .option("checkpointLocation", checkpoint).trigger(availableNow=True).start(out)
    )
    query.awaitTermination()
    assert spark.read.parquet(out).count() == 1
