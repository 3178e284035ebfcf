"""Tables updated in place, known ids by filters, streaming state, dictionaries of synonyms, cut-off answers."""

import json
import os
import random
import re

import pandas as pd
import pytest
from pyspark.resource import ResourceProfileBuilder, TaskResourceRequests
from pyspark.sql import functions as F
from pyspark.sql import types as T

from postmill.operators import dictionary, hooks, responses
from postmill.sinks import answers, keyed_table, known_ids
from postmill.sources.tables import delete_path, list_names, read_text, rename_path, table_exists, write_text
from postmill.streaming import seen

ROWS = "k string, v long"


def table(spark, path):
    schema = spark.createDataFrame([], ROWS).schema
    return sorted((tuple(r) for r in keyed_table.read(spark, path, schema).collect()), key=str)


def upsert(spark, path, run, rows):
    df = spark.createDataFrame(rows, ROWS)
    keyed_table.upsert(df, path, run, ["k"], [F.desc("v")], df.schema)


def test_small_files(spark, tmp_path):
    path = str(tmp_path / "a" / "b.json")
    assert not table_exists(spark, path) and list_names(spark, str(tmp_path / "a")) == []
    write_text(spark, path, "ä\n")
    write_text(spark, path + "x", "new")
    assert read_text(spark, path) == "ä\n" and list_names(spark, str(tmp_path / "a")) == ["b.json", "b.jsonx"]
    rename_path(spark, path + "x", path)
    assert read_text(spark, path) == "new" and table_exists(spark, path)
    delete_path(spark, path)
    assert list_names(spark, str(tmp_path / "a")) == []


def test_upsert_rewrites_touched_buckets_only(spark, tmp_path):
    path = str(tmp_path / "t")
    keyed_table.create(spark, path, 16)
    keyed_table.create(spark, path, 4)
    assert table(spark, path) == []
    upsert(spark, path, 1, [(str(i % 50), i) for i in range(200)] + [("hot", i) for i in range(500)] + [(None, 7), (None, 8)])
    want = {str(i): 150 + i for i in range(50)} | {"hot": 499, None: 8}
    assert dict(table(spark, path)) == want and len(table(spark, path)) == 52
    first = keyed_table.manifest(spark, path)
    upsert(spark, path, 2, [("hot", 1), ("new", 2)])
    second = keyed_table.manifest(spark, path)
    old = next(iter(first["attempts"]))
    touched = {b for a, own in second["attempts"].items() if a != old for b in own}
    assert len(touched) <= 2 and set(second["attempts"][old]) == set(first["attempts"][old]) - touched
    assert dict(table(spark, path)) == want | {"hot": 1, "new": 2}


def test_a_repeated_run_replaces_itself(spark, tmp_path):
    path = str(tmp_path / "t")
    keyed_table.create(spark, path, 4)
    upsert(spark, path, 1, [("a", 1), ("b", 1)])
    upsert(spark, path, 2, [("b", 2), ("c", 2)])
    upsert(spark, path, 2, [("d", 2)])
    assert table(spark, path) == [("a", 1), ("b", 1), ("d", 2)]
    with pytest.raises(ValueError):
        upsert(spark, path, 1, [("a", 3)])
    upsert(spark, path, 3, [])
    assert table(spark, path) == [("a", 1), ("b", 1), ("d", 2)] and keyed_table.runs(spark, path) == [0, 1, 2, 3]
    assert keyed_table.vacuum(spark, path, 1) >= 1
    assert table(spark, path) == [("a", 1), ("b", 1), ("d", 2)] and keyed_table.runs(spark, path) == [3]


def test_a_killed_run_leaves_the_table(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "t")
    keyed_table.create(spark, path, 4)
    upsert(spark, path, 1, [("a", 1)])

    def killed(*_):
        raise RuntimeError("killed before the manifest")

    with monkeypatch.context() as patched:
        patched.setattr(keyed_table, "_publish", killed)
        with pytest.raises(RuntimeError):
            upsert(spark, path, 2, [("a", 2), ("b", 2)])
    assert table(spark, path) == [("a", 1)]
    upsert(spark, path, 2, [("a", 3)])
    assert table(spark, path) == [("a", 3)]
    assert keyed_table.vacuum(spark, path, 2) == 1 and table(spark, path) == [("a", 3)]


def test_reading_neither_sorts_nor_shuffles(spark, tmp_path):
    path = str(tmp_path / "t")
    keyed_table.create(spark, path, 4)
    for run in (1, 2):
        upsert(spark, path, run, [(str(i), run) for i in range(20)])
    plan = keyed_table.read(spark, path, spark.createDataFrame([], ROWS).schema)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Exchange|Sort|Window|Join", plan)


def ids(spark, names):
    return spark.createDataFrame([(n,) for n in names], "x string")


def unknown(spark, path, names, run):
    found = known_ids.looked_up(ids(spark, names), path, run, 8).cache()
    return sorted(r.id for r in known_ids.new_ids(found, path, run).collect()), found


def test_known_ids(spark, tmp_path):
    path = str(tmp_path / "k")
    names = [f"d{i}" for i in range(300)]
    assert unknown(spark, path, ["a", "a", "", None], 1)[0] == ["a"]
    known_ids.add(ids(spark, [*names, "d1", "", None]), path, 1, 8, 1 << 10)
    assert unknown(spark, path, ["d1", "d299", "e", None], 1)[0] == ["d1", "d299", "e"]
    assert unknown(spark, path, ["d1", "d299", "e", "f"], 2)[0] == ["e", "f"]
    known_ids.add(ids(spark, ["e"]), path, 2, 8, 1 << 10)
    known_ids.add(ids(spark, ["f"]), path, 2, 8, 1 << 10)
    assert unknown(spark, path, ["d1", "e", "f"], 3)[0] == ["e"]
    known_ids.add(ids(spark, []), path, 3, 8, 1 << 10)
    assert unknown(spark, path, ["d1", "e", "f"], 4)[0] == ["e"]


def test_untouched_buckets_are_not_read(spark, tmp_path):
    path = str(tmp_path / "k")
    known_ids.add(ids(spark, [f"d{i}" for i in range(400)]), path, 1, 8)
    _, found = unknown(spark, path, ["d7", "new1", "new2"], 2)
    hit = {r.bucket for r in found.where("maybe").collect()}
    assert len(hit) <= 2
    for name in os.listdir(f"{path}/ids/run=1"):
        if name.startswith("bucket=") and int(name[7:]) not in hit:
            for file in os.listdir(f"{path}/ids/run=1/{name}"):
                if not file.endswith(".crc"):
                    (tmp_path / "k" / "ids" / "run=1" / name / file).write_bytes(b"no parquet")
    assert sorted(r.id for r in known_ids.new_ids(found, path, 2).collect()) == ["new1", "new2"]


def test_filters_grow_and_tell_their_rate(spark, tmp_path):
    path = str(tmp_path / "k")
    for run in range(1, 4):
        known_ids.add(ids(spark, [f"r{run}-{i}" for i in range(800)]), path, run, 4, 1 << 9)
    filters = known_ids.filters(spark, path)
    assert filters.agg(F.sum("n")).first()[0] == 2400 and filters.agg(F.min(F.length("bits")) * 8).first()[0] >= 4096
    rate = known_ids.false_positive_rate(filters)
    others = known_ids.looked_up(ids(spark, [f"other{i}" for i in range(4000)]), path, 9, 4)
    share = others.where("maybe").count() / 4000
    assert rate < 0.05 and abs(share - rate) < 0.02
    assert known_ids.looked_up(ids(spark, [f"r2-{i}" for i in range(800)]), path, 9, 4).where("not maybe").count() == 0


def test_state_over_batches_and_a_restart(spark, tmp_path):
    landing, target, checkpoint = (str(tmp_path / n) for n in ("landing", "target", "checkpoint"))
    schema = "id string, at long"
    parts = [[("a", 2), ("a", 1), ("b", 3), (None, 4)], [("a", 0), ("c", 5), ("", 6), (None, 4)], [("c", 1), ("d", 9), ("d", 8)], [("a", 1)]]
    updated = []
    for part in parts:
        spark.createDataFrame(part, schema).coalesce(1).write.mode("append").parquet(landing)
        stream = spark.readStream.schema(schema).parquet(landing)
        progress = seen.keep_first(stream, "id", ["at"], target, checkpoint)
        updated.append(sum(p["stateOperators"][0]["numRowsUpdated"] for p in progress if p["stateOperators"]))
    rows = spark.read.parquet(target).select("id", "at", "run").collect()
    assert sorted((r.id or "", r.at) for r in rows) == [("", 4), ("", 4), ("", 6), ("a", 1), ("b", 3), ("c", 5), ("d", 8)]
    # a batch works on its own ids: none of the later ones touches what earlier ones have put in
    assert updated == [2, 1, 1, 0] and {r.run for r in rows} == {0, 1, 2}
    assert spark.conf.get(seen.PROVIDER, "") != seen.ROCKSDB


LABELS = {"a": ["voll", "vollzeit", "ö", "x-y"], "b": ["zeit", "home office", "e"], "c": ["llz", ".", "n.n"], "d": []}


def test_dictionary_by_brute_force(spark):
    rng = random.Random(4)
    pieces = ["voll", "zeit", "vollzeit", " ", " ", "-", ".", "home", "office", "ö", "e", "_", "x-y", "n", "é", "\n", "7", "漢"]
    texts = ["".join(rng.choice(pieces) for _ in range(rng.randint(0, 30))) for _ in range(400)] + ["", None, "q" * 9000 + " zeit", "z" * 4094 + "zeit" + "q" * 5000]
    df = spark.createDataFrame(list(enumerate(texts)), "k long, t string").repartition(3)
    for whole in (False, True):
        found = {r.k: r.labels for r in dictionary.label_texts(df, "k", "t", LABELS, whole_words=whole).collect()}
        for k, text in enumerate(texts):
            want = set()
            for label, words in LABELS.items():
                for w in words:
                    pattern = re.escape(w)
                    for m in re.finditer(f"(?={pattern})", text or ""):
                        b, e = m.start(), m.start() + len(w)
                        border = [(i > 0 and dictionary.is_word_char(text[i - 1])) != (i < len(text) and dictionary.is_word_char(text[i])) for i in (b, e)]
                        if not whole or all(border):
                            want.add(label)
            assert found[k] == sorted(want), text


def test_dictionary_agrees_with_patterns(spark):
    from postmill import fixed_values as fv
    from postmill.operators import fields

    words = ["praktikum", "werkstudent", "Teilzeit", "vollzeit", "im", "senior", "Praktikant", "und", "20 Stunden"]
    rng = random.Random(2)
    rows = [(n, " ".join(rng.choice(words) + rng.choice(["", "in", ",", "-"]) for _ in range(8)).lower()) for n in range(200)]
    df = spark.createDataFrame(rows, "k long, search_text string")
    by_patterns = {r.k: r.time_models for r in fields.time_models(df).collect()}
    labels = {r.k: r.labels for r in dictionary.label_texts(df, "k", "search_text", fv.TIME_MODELS, whole_words=False).collect()}
    assert {k: v or [fv.DEFAULT_TIME_MODEL] for k, v in labels.items()} == by_patterns


def test_dictionary_is_bounded():
    with pytest.raises(ValueError):
        dictionary.Synonyms({"a": ["x" * (dictionary.MAX_CHARS + 1)]})
    assert dictionary.labels_of(["a", ""], dictionary.Synonyms({}), True) == [[], []]


def closed(spark, texts):
    df = spark.createDataFrame(list(enumerate(texts)), "n long, t string")
    return [r.r for r in df.select("n", responses.repaired(F.col("t")).alias("r")).orderBy("n").collect()]


def test_every_cut_is_closed(spark):
    value = {"benefits": ["Urlaub", 'a "b" \\ ä', {"x": [], "y": {}}], "n": -12.5e3, "t": True, "z": None, "e": ""}
    for whole in (json.dumps(value), json.dumps(value, ensure_ascii=False, indent=1)):
        found = closed(spark, [whole[:n] for n in range(len(whole) + 1)])
        assert found[0] is None and found[-1].json == whole and found[-1].closed == ""
        for n, r in enumerate(found[1:], 1):
            read = json.loads(r.json)
            assert r.stopped_at == n and list(read) == list(value)[: len(read)]


def test_kinds_of_cuts(spark):
    cases = {
        'Text {"a": ["A", "B': ('{"a": ["A", "B"]}', '"]}', 19),
        '{"a": ["A", ': ('{"a": ["A"]}', "]}", 12),
        '{"a": "x\\': ('{"a": "x"}', '"}', 9),
        '{"a": "x\\u00e': ('{"a": "x"}', '"}', 13),
        '{"a": 1, "b': ('{"a": 1}', "}", 11),
        '{"a": 1, "b":': ('{"a": 1}', "}", 13),
        '{"a": fals': ("{}", "}", 10),
        '[1, 2': ("[1, 2]", "]", 5),
        '[1, -': ("[1]", "]", 5),
        '{"a": 1} and {"b"': ('{"a": 1}', "", 8),
        '{"a" 1}': ("{}", "}", 5),
        '{"a": 1]': ('{"a": 1}', "}", 7),
        '["}", "]"]': ('["}", "]"]', "", 10),
    }
    assert [(r.json, r.closed, r.stopped_at) for r in closed(spark, list(cases))] == list(cases.values())
    assert closed(spark, ["no bracket", "", None]) == [None, None, None]


def test_an_answer_is_folded_once(spark):
    given = spark.createDataFrame([('{"benefits": ["A',)], "benefits_response string")
    folds = lambda df: df._jdf.queryExecution().optimizedPlan().toString().count("aggregate(")
    assert folds(given.select(responses.repaired(F.col("benefits_response")).alias("r")).select("r.json", "r.closed", "r.stopped_at")) == 1
    assert folds(responses.phrases(given, repair=True)) == 1
    assert closed(spark, ['["\U0001f600\\ud83d\\ude0']) == [('["\U0001f600\\ud83d"]', '"]', 14)]


def test_repair_changes_no_given_answer(spark):
    from postmill.plans import fixtures as fx

    given = spark.createDataFrame([(t,) for t in fx.ANSWERS["benefits_response"]], "benefits_response string")
    assert responses.phrases(given).collect()[0].phrases == responses.phrases(given, repair=True).collect()[0].phrases
    plain, fixed = ([r.phrases for r in responses.phrases(given, repair=p).collect()] for p in (False, True))
    # only the cut answer reads more: the text that was open
    assert [n for n, (a, b) in enumerate(zip(plain, fixed, strict=True)) if a != b] == [3] and fixed[3][: len(plain[3])] == plain[3]


def counting_model(calls, answer):
    """A hook that leaves a file per opened model and a line per text asked."""

    def open_model(**settings):
        path = f"{calls}/{os.getpid()}-{random.random()}"

        def score(texts):
            with open(path, "a", encoding="utf-8") as file:
                file.writelines(f"{len(t)}\n" for t in texts)
            return [answer(t) for t in texts]

        return score

    return open_model


def asked(calls):
    return [int(line) for name in os.listdir(calls) for line in open(f"{calls}/{name}", encoding="utf-8")]


def test_nothing_is_asked_twice(spark, tmp_path):
    calls, path = tmp_path / "calls", str(tmp_path / "answers")
    calls.mkdir()
    model = counting_model(calls, str.upper)
    texts = spark.createDataFrame([("a",), ("bb",), ("a",), (None,), ("",)], "t string")
    first = answers.answered(texts, "t", "out", model, path, "m", {"x": 1}, wave=2)
    assert sorted((r.t, r.out) for r in first.collect() if r.t is not None) == [("", ""), ("a", "A"), ("a", "A"), ("bb", "BB")]
    assert first.where("t IS NULL AND out IS NULL").count() == 1 and sorted(asked(calls)) == [0, 1, 2]
    opened = len(os.listdir(calls))
    answers.answered(texts, "t", "out", model, path, "m", {"x": 1}).collect()
    assert len(os.listdir(calls)) == opened
    more = texts.unionAll(spark.createDataFrame([("ccc",)], "t string"))
    assert answers.answered(more, "t", "out", model, path, "m", {"x": 1}).where("out = 'CCC'").count() == 1
    assert sorted(asked(calls)) == [0, 1, 2, 3]
    answers.ask(texts, "t", model, path, "m", {"x": 2})
    answers.ask(texts, "t", model, path, "other", {"x": 1})
    assert sorted(asked(calls)) == [0, 0, 0, 1, 1, 1, 2, 2, 2, 3]


def test_a_wave_reads_its_own_texts(spark, tmp_path, monkeypatch):
    """with a filter on one table each wave read the texts of all."""
    texts, waves, by_length = spark.createDataFrame([(str(n),) for n in range(40)], "t string"), [], hooks.by_length

    def kept(part, *rest):
        waves.append((part._jdf.queryExecution().executedPlan().toString(), part.count()))
        return by_length(part, *rest)

    monkeypatch.setattr(hooks, "by_length", kept)
    assert answers.ask(texts, "t", lambda: (lambda batch: batch), str(tmp_path / "answers"), "m", wave=10).count() == 40
    assert len(waves) == 4 and sum(n for _, n in waves) == 40
    assert all(re.search(r"PartitionFilters: \[[^\]]*wave", plan) for plan, _ in waves)


def test_an_unfinished_wave_is_asked_again(spark, tmp_path, monkeypatch):
    calls, path = tmp_path / "calls", str(tmp_path / "answers")
    calls.mkdir()
    model = counting_model(calls, str.upper)
    texts = spark.createDataFrame([(str(n),) for n in range(20)], "t string")
    finish, finished = answers._finish, []

    def killed(*paths):
        if finished:
            raise RuntimeError("killed")
        finished.append(1)
        finish(*paths)

    with monkeypatch.context() as patched:
        patched.setattr(answers, "_finish", killed)
        with pytest.raises(RuntimeError):
            answers.ask(texts, "t", model, path, "m", wave=7)
    kept = answers.stored(spark, path, T.StringType()).count()
    before = len(asked(calls))
    assert 0 < kept < 20
    assert answers.ask(texts, "t", model, path, "m", wave=7).count() == 20 and len(asked(calls)) - before == 20 - kept


def test_batches_by_length_need_little_padding(spark):
    rng = random.Random(1)
    df = spark.createDataFrame([(n, "x" * int(rng.lognormvariate(5, 1))) for n in range(20_000)], "n long, t string").repartition(5)

    def padding(batches):
        for batch in batches:
            sizes = [len(t) for t in batch["t"]]
            groups = [sizes[i : i + 64] for i in range(0, len(sizes), 64)]
            yield pd.DataFrame({"padded": [sum(max(g) * len(g) for g in groups)], "own": [sum(sizes)]})

    totals = [
        d.mapInPandas(padding, "padded long, own long").agg(F.sum("padded") / F.sum("own") - 1).first()[0] for d in (df, hooks.by_length(df, "t", 4))
    ]
    assert totals[1] < 0.1 < totals[0]


def test_profile_reaches_the_stage(spark):
    needs = TaskResourceRequests().cpus(2)
    profile = ResourceProfileBuilder().require(needs).build
    asked_ = hooks.add_by_models(spark.createDataFrame([("a",)], "t string"), {"o": ("t", lambda: list)}, T.StringType(), profile=profile)
    plan = asked_._jdf.queryExecution().toString()
    assert f"Profile: id = {profile.id}" in plan and "cpus, amount: 2.0" in plan


def test_a_large_bucket_is_written_by_several_tasks(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(keyed_table, "ROWS_PER_PART", 20)
    path, schema = str(tmp_path / "t"), T.StructType([T.StructField("k", T.StringType()), T.StructField("v", T.LongType())])
    keyed_table.create(spark, path, 2)
    for run, rows in ((1, [(str(n), n) for n in range(200)]), (2, [(str(n), -n) for n in range(100, 300)] + [(None, 7)])):
        keyed_table.upsert(spark.createDataFrame(rows, schema), path, run, ["k"], [F.desc("v")], schema)
        folders = sorted((tmp_path / "t" / "data").glob(f"attempt={run}-*/bucket=*"))
        assert len(folders) == 2 and all(len(list(f.glob("*.parquet"))) > 2 for f in folders)
    found = {r.k: r.v for r in keyed_table.read(spark, path, schema).collect()}
    assert found == {str(n): n if n < 100 else -n for n in range(300)} | {None: 7}


def test_a_landed_file_is_sorted_by_many_tasks(spark, tmp_path):
    from postmill.sources import dumps

    lines = spark.range(0, 500, 1, 7).select((499 - F.col("id")).alias("k"), F.concat(F.lit("l"), 499 - F.col("id")).alias("value"))
    dumps.land(lines, ["k"], str(tmp_path / "landed" / "one.txt"), str(tmp_path / "drafts"), 5)
    assert len(dumps.list_dumps(str(tmp_path / "drafts"))) > 1 and list(dumps.list_dumps(str(tmp_path / "landed"))) == [str(tmp_path / "landed" / "one.txt")]
    assert (tmp_path / "landed" / "one.txt").read_text() == "".join(f"l{n}\n" for n in range(500))
