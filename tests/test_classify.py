import numpy as np
import pytest
from pyspark.sql import types as T

from postmill import fixed_values as fv
from postmill.operators import classify, hooks

RANKED = "phrase string, posting int, pos int, ranked array<struct<category:string,ord:int,score:double>>"
PROTOTYPES = [
    ("a", 0, "example", [1.0, 0.0]), ("a", 0, "example", [0.8, 0.6]), ("a", 0, "context", [1.0, 0.0]),
    ("b", 1, "example", [0.0, 1.0]), ("b", 1, "context", [0.0, 2.0]),
    ("c", 2, "example", [0.0, 3.0]), ("c", 2, "context", [0.0, 1.0]),
    ("d", 3, "example", [0.0, 0.0]), ("d", 3, "context", [0.0, 0.0]),
]


@pytest.fixture(scope="module")
def prototypes(spark):
    df = spark.createDataFrame(PROTOTYPES, "category string, ord int, kind string, embedding array<double>")
    return classify.Prototypes.collect(df)


def phrases(spark, *vectors):
    return spark.createDataFrame([(f"p{n}", v) for n, v in enumerate(vectors)], "phrase string, embedding array<float>")


def test_scores(spark, prototypes):
    rows = {r.category: r for r in classify.score_all(phrases(spark, [0.6, 0.8]), prototypes).collect()}
    assert rows["a"].direct == pytest.approx(0.96) and rows["a"].context == pytest.approx(0.6)
    assert rows["a"].combined == pytest.approx(0.8 * 0.96 + 0.2 * 0.6)
    assert rows["b"].combined == pytest.approx(0.8) and rows["d"].combined == 0.0


def test_ranking_ties_and_zero_vectors(spark, prototypes):
    ranked = classify.score_ranked(phrases(spark, [0.0, 1.0], [0.0, 0.0], [-1.0, -1.0]), prototypes)
    rows = {r.phrase: r for r in classify.decide(ranked, 0.45).collect()}
    assert [e.category for e in rows["p0"].ranked] == ["b", "c", "a", "d"] and rows["p0"].best_category == "b"
    assert (rows["p1"].best_category, rows["p1"].best_score, rows["p1"].assigned) == (None, 0.0, 0)
    assert rows["p2"].best_category is None and rows["p2"].assigned == 0


def test_top_five_of_many(spark):
    many = [(f"c{n}", n, kind, [1.0, n / 10]) for n in range(8) for kind in ("example", "context")]
    df = spark.createDataFrame(many, "category string, ord int, kind string, embedding array<double>")
    whole = classify.score_ranked(phrases(spark, [1.0, 0.0]), classify.Prototypes.collect(df))
    assert [e.category for e in whole.first().ranked] == ["c0", "c1", "c2", "c3", "c4"]
    with pytest.raises(ValueError):
        classify.Prototypes.collect(df, max_rows=10)
    halves = [
        classify.score_ranked(phrases(spark, [1.0, 0.0]), classify.Prototypes.collect(df.where(test)))
        for test in ("ord % 2 = 0", "ord % 2 = 1")
    ]
    merged = classify.merge_ranked([h.drop("embedding") for h in halves]).first()
    assert [tuple(e) for e in merged.ranked] == [tuple(e) for e in whole.first().ranked]


def test_threshold_is_strict_and_dropped_category_counts_nowhere(spark):
    rows = [
        ("at", 1, 0, [("Boni", 4, 0.45)]), ("over", 1, 1, [("Boni", 4, 0.46)]), ("drop", 1, 2, [("non_incentive", 20, 0.9)]),
        ("low", 1, 3, [("13. Gehalt", 6, 0.1)]), ("none", 2, 0, None), ("drop", 3, 0, [("non_incentive", 20, 0.9)]),
    ]
    decided = classify.decide(spark.createDataFrame(rows, RANKED), fv.THRESHOLD)
    assert {r.phrase: r.assigned for r in decided.collect()} == {"at": 0, "over": 1, "drop": 1, "low": 0, "none": 0}
    flags = {r.posting: r for r in classify.flags_and_unmatched(decided, ["posting"]).collect()}
    assert flags[1]["Boni"] == 1 and flags[1]["13. Gehalt"] == 0 and flags[1].others == "at; low"
    assert flags[2].others == "none" and flags[3].others == "" and sum(flags[3][c] for c in fv.FLAG_COLUMNS) == 0


def test_log_row_pads_with_null(spark):
    decided = classify.decide(spark.createDataFrame([("x", 1, 0, [("a", 0, 0.5)])], RANKED))
    row = classify.score_log(decided).first()
    assert (row.top_1_category, row.top_2_category, row.top_5_score, row.assigned, row.threshold) == ("a", None, None, 1, 0.45)


def test_hot_phrase_is_scored_once_and_kept_whole(spark, prototypes):
    rows = spark.createDataFrame([(n, 0, "hot" if n % 3 else f"p{n}") for n in range(300)], "id int, pos int, phrase string")
    vectors = spark.createDataFrame([("hot", [1.0, 0.0]), ("p0", [0.0, 1.0])], "phrase string, embedding array<float>")
    decided = classify.classify_distinct(rows, vectors, prototypes, ["id", "pos"], rows_per_task=20).collect()
    assert len(decided) == 300
    assert sum(r.best_category == "a" for r in decided) == 200 and sum(r.best_category == "b" for r in decided) == 1
    assert sum(r.assigned is None for r in decided) == 99


def test_prototype_table(spark):
    counts = classify.prototype_texts(spark).groupBy("kind").count().collect()
    assert {r.kind: r["count"] for r in counts} == {"example": 100, "context": 21}


def test_hooks_open_the_model_once_per_partition(spark):
    def opener():
        opened = {"calls": 0}

        def scorer(batch):
            opened["calls"] += 1
            return [f"{t}!{opened['calls']}" for t in batch]

        return scorer

    df = spark.createDataFrame([(n, f"t{n}") for n in range(10)], "n int, prompt string").repartition(2)
    rows = hooks.generate(df, "prompt", "answer", opener).collect()
    assert sorted(r.answer for r in rows) == sorted(f"t{n}!1" for n in range(10))

    vectors = hooks.embed(df.select("prompt"), "prompt", lambda: (lambda batch: [[float(len(t))] for t in batch]))
    assert vectors.schema["embedding"].dataType == T.ArrayType(T.FloatType()) and vectors.first().embedding == [2.0]

    pairs = hooks.translation_pairs(df, "prompt", "de>en", lambda: (lambda batch: [None if t == "t1" else t.upper() for t in batch]))
    assert {r.src: r.dst for r in pairs.collect()}["t1"] == "t1" and {r.src: r.dst for r in pairs.collect()}["t2"] == "T2"


def test_logged_scores_give_the_logged_decisions(spark):
    """Phrases with scores of a real run: best score, and 1 where it was assigned."""
    logged = [
        ("Monatliche Vergütung", "13. Gehalt", 0.4783063530921936, 1), ("20 Urlaubstage", "Zusätzliche_Urlaubstage", 0.43397191166877747, 0),
        ("25 Seminartage", "Zusätzliche_Urlaubstage", 0.32934272289276123, 0),
    ]
    rows = [(p, 0, n, [(c, n, s)]) for n, (p, c, s, _) in enumerate(logged)]
    decided = {r.phrase: r for r in classify.decide(spark.createDataFrame(rows, RANKED)).collect()}
    assert [(decided[p].best_category, decided[p].best_score, decided[p].assigned) for p, *_ in logged] == [
        (c, s, a) for _, c, s, a in logged
    ]


def test_blocks_rank_like_one_set(spark):
    rows = [(c, n, "example", [float(n + j), 1.0, float(j * j % 5)]) for n, c in enumerate("abcd") for j in range(5)]
    rows += [(c, n, "context", [1.0, float(n), 0.5]) for n, c in enumerate("abcd")]
    embedded = spark.createDataFrame(rows, "category string, ord int, kind string, embedding array<double>")
    phrases = spark.createDataFrame([(f"p{i}", [float(i % 3), 1.0, float(i % 4)]) for i in range(12)], "phrase string, embedding array<double>")
    whole = {r.phrase: [(x.ord, round(x.score, 9)) for x in r.ranked] for r in classify.score_ranked(phrases, classify.Prototypes.collect(embedded), 3).collect()}
    for size in (3, 7, 100):
        parts = classify.score_blocks(phrases, classify.Prototypes.blocks(embedded, size), 3)
        assert {r.phrase: [(x.ord, round(x.score, 9)) for x in r.ranked] for r in parts.collect()} == whole


def test_three_prompts_in_one_pass(spark):
    """Openers get their settings, models their batch size, and only key and prompts cross to Python."""
    from postmill.plans.load import answers_from_models

    def opener(name):
        def open_model(**settings):
            return lambda texts: [f"{name} {settings['max_new_tokens']} {len(texts)} {t.count('wanted')}" for t in texts]

        return open_model

    df = spark.createDataFrame([(f"d{n}", "wanted", "wanted wanted", "none", n) for n in range(5)], "ord string, description string, benefits_text string, job_title string, other int")
    rows = answers_from_models(opener("e"), opener("b"), opener("c"), batch_size=5)(df.coalesce(1)).orderBy("ord").collect()
    assert [r.other for r in rows] == list(range(5))
    assert {r.experience_response for r in rows} == {"e 15 5 1"}
    assert {r.benefits_response for r in rows} == {"b 350 5 2"}
    assert {r.branch_response for r in rows} == {"c 20 5 0"}


def test_pruned_scores_equal_all_scores(spark):
    """100,000 examples around 50 themes: the results of looking at all, for a small share of the products."""
    rng = np.random.default_rng(3)
    themes = rng.normal(size=(50, 32))
    examples = [themes[rng.integers(5 * n, 5 * n + 5, 10_000)] + rng.normal(scale=0.25, size=(10_000, 32)) for n in range(10)]
    examples[3][17] = 0
    contexts = np.stack([e.mean(axis=0) for e in examples])
    unit = lambda m: classify._unit_rows(list(m))
    prototypes = classify.Prototypes([f"c{n}" for n in range(10)], list(range(10)), [unit(e) for e in examples], unit(contexts))
    vectors = np.concatenate([themes[rng.integers(0, 50, 150)] + rng.normal(scale=0.4, size=(150, 32)), rng.normal(size=(20, 32)), np.zeros((1, 32)), examples[2][:5]])
    phrases = spark.createDataFrame([(f"p{n}", v.tolist()) for n, v in enumerate(vectors)], "phrase string, embedding array<double>").repartition(2)
    groups = classify.PrototypeGroups(prototypes)
    plain = {r.phrase: r.ranked for r in classify.score_ranked(phrases, prototypes).collect()}
    pruned = classify.score_pruned(phrases, groups).collect()
    assert len(pruned) == len(plain) == len(vectors) and len(groups) == 100_000
    for row in pruned:
        assert [x.category for x in row.ranked] == [x.category for x in plain[row.phrase]]
        assert [x.score for x in row.ranked] == pytest.approx([x.score for x in plain[row.phrase]], abs=1e-12)
    skipped = 1 - sum(r.products for r in pruned) / (len(pruned) * len(groups))
    assert skipped > 0.5, skipped


def test_more_phrases_are_scored_by_more_tasks(spark, prototypes):
    rng = np.random.default_rng(5)
    phrases = spark.createDataFrame([(f"p{n}", rng.normal(size=2).tolist()) for n in range(100)], "phrase string, embedding array<double>").coalesce(1)
    pruned = classify.score_pruned(phrases, classify.PrototypeGroups(prototypes), rows=4)
    assert pruned.rdd.getNumPartitions() == 13
    plain = {r.phrase: [x.category for x in r.ranked] for r in classify.score_ranked(phrases, prototypes).collect()}
    assert {r.phrase: [x.category for x in r.ranked] for r in pruned.collect()} == plain


def test_more_vectors_than_one_block_holds(spark, sf_dir, monkeypatch):
    from postmill.plans import queries

    whole = {(r.phrase, r.rank): (r.category, r.score) for r in queries.vector_pruned(spark, sf_dir).collect()}
    monkeypatch.setattr(queries, "MANY_PROTOTYPES", 200)
    assert {(r.phrase, r.rank): (r.category, r.score) for r in queries.vector_pruned(spark, sf_dir).collect()} == whole
