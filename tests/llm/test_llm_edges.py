"""Nulls, empty and very long texts, ties, repeated rows, empty tables and clashing columns."""

import hashlib
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from postmill import session
from postmill.llm import ctw, decontaminate, html_mincut, jaccard_join, language_id, raking, substring_dedup, topk_search, url_trust, warc_audit

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, id string, row string, row_key string, n_words int, lang_pred string, mix_tokens int, score string"
WORD = re.compile("[^\x20\x09-\x0d]+")


def untidy_texts():
    rng = random.Random(3)
    words = [f"w{i}" for i in range(30)]
    texts = []
    for n in range(40):
        base = [rng.choice(words) for _ in range(rng.choice([3, 12, 13, 14, 40, 90]))]
        texts.append(" ".join(base))
        if n % 4 == 0:
            texts += [" ".join(base), "  ".join(base[:-1] + ["changed"]), "\n".join(["x", *base, "y"])]
    passage = " ".join(f"p{i}" for i in range(60))
    texts += [f"start {passage} end", f"{passage} other", "same " * 50, "same " * 70, "same " * 12, "Ünïcode ǅ text" + " a b" * 20]
    texts += [None, "", " \t\n ", "12 34 !!", "long " + " ".join(str(i % 997) for i in range(200_000))]
    return texts


@pytest.fixture(scope="module")
def untidy(spark):
    rows = [(n, t, "en" if n % 3 else "de", f"s{n % 2}" if n % 5 else None, 1, "c", "l", "a", 2, "s", 3, "h") for n, t in enumerate(untidy_texts())]
    rows += [rows[0], rows[0], (None, rows[0][1], None, None, None, *rows[0][5:]), (None, None, None, None, None, *rows[0][5:]), (5, "other text under a used id", *rows[5][2:])]
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


def _texts(df):
    return [(r.doc_id, r.text) for r in df.select("doc_id", "text").collect()]


def test_substring_dedup_by_brute_force(spark, untidy):
    for width in (13, 20):
        found = substring_dedup.deduplicated(untidy, width).select("row.doc_id", "n_words", "n_removed", "kept_sha256").collect()
        rows = [(d, WORD.findall(t or "")) for d, t in _texts(untidy)]
        least = {}
        for d, w in rows:
            for i in range(len(w) - width + 1):
                key, own = tuple(w[i : i + width]), float("inf") if d is None else d
                least[key] = min(least.get(key, own), own)
        want = []
        for d, w in rows:
            gone = set()
            for i in range(len(w) - width + 1):
                if least[tuple(w[i : i + width])] < (float("inf") if d is None else d):
                    gone.update(range(i, i + width))
            kept = " ".join(x for i, x in enumerate(w) if i not in gone)
            want.append((d, len(w), len(gone), hashlib.sha256(kept.encode()).hexdigest()))
        assert sorted(map(str, map(tuple, found))) == sorted(map(str, want))


def test_substring_dedup_text(spark):
    passage = " ".join(f"p{i}" for i in range(15))
    docs = spark.createDataFrame([(1, f"a {passage} b"), (2, f" c\n{passage}  d e"), (3, passage)], "doc_id long, text string")
    texts = {r.doc_id: r.text for r in substring_dedup.deduplicated(docs).select("row.doc_id", "text").collect()}
    assert texts == {1: f"a {passage} b", 2: " c\nd e", 3: ""}


def test_jaccard_join_by_brute_force(spark, untidy):
    for width, percent in ((4, 85), (5, 80)):
        rows = []
        for d, t in _texts(untidy):
            w = WORD.findall((t or "").lower())
            rows.append((d, {tuple(w[i : i + width]) for i in range(len(w) - width + 1)} if len(w) >= width else {tuple(w)} if w else set()))
        parent = list(range(len(rows)))

        def root(x, parent=parent):
            while parent[x] != x:
                x = parent[x]
            return x

        for i, (_, a) in enumerate(rows):
            for j, (_, b) in enumerate(rows[:i]):
                if a and 100 * len(a & b) >= percent * len(a | b):
                    parent[root(i)] = root(j)
        groups = {}
        for i, (d, _) in enumerate(rows):
            groups.setdefault(root(i), []).append(jaccard_join.NO_ID if d is None else d)
        want = sorted((jaccard_join.NO_ID if d is None else d, len(s), min(groups[root(i)])) for i, (d, s) in enumerate(rows))
        found = jaccard_join.similar_sets(untidy, width, percent)
        assert sorted((r.id, r.n, r.component) for r in found.collect()) == want


def test_near_copies_by_brute_force(spark):
    rng = random.Random(8)
    vocabulary = [f"v{i}" for i in range(400)]
    base = [rng.choice(vocabulary) for _ in range(120)]
    texts = [" ".join(base)]
    for _ in range(150):
        copy = list(base)
        for _ in range(rng.randint(1, 8)):
            copy[rng.randrange(len(copy))] = rng.choice(vocabulary)
        texts.append(" ".join(copy))
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(4)
    test_jaccard_join_by_brute_force(spark, docs)


def test_one_of_each_group(spark, untidy):
    kept = jaccard_join.one_of_each_group(untidy, 5, 80)
    assert kept.columns == untidy.columns
    ids = [r.doc_id for r in kept.where("trim(text) <> ''").collect()]
    assert ids.count(0) == 1 and 1 not in ids
    assert kept.where("text IS NULL OR trim(translate(text, '\t\n', '')) = ''").count() == untidy.where("text IS NULL OR trim(translate(text, '\t\n', '')) = ''").count()


def test_decontaminate_takes_ids_of_any_type(spark):
    docs = spark.createDataFrame([(1, "x p q r y"), (2, None)], "doc_id long, text string")
    items = spark.createDataFrame([("b-2", "p q"), ("a1", "Q R"), (None, "y")], "item_id string, text string")
    found = {r.doc_id: r for r in decontaminate.digest(docs, items).collect()}
    assert (found[1].n_hit, found[1].n_items, found[2].n_hit) == (4, 2, 0)
    assert found[1].items_sha256 == hashlib.sha256(b"a1,b-2").hexdigest()


def test_decontaminate_by_brute_force(spark, untidy):
    items = [(1, " ".join(f"P{i}" for i in range(5, 25))), (2, "same, same. same same same same same same same same same"), (2, "w1 w2"), (None, "w3"), (3, None), (4, ""), (5, "--")]
    for part_chars in (decontaminate.PART_CHARS, 60):
        found = decontaminate.contamination(untidy, spark.createDataFrame(items, "item_id long, text string"), part_chars=part_chars)
        cut = lambda t: re.findall(r"[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", (t or "").translate({i: i + 32 for i in range(65, 91)}))
        windows = []
        for item, t in items:
            w = cut(t)
            size = min(10, len(w))
            windows += [(item, tuple(w[i : i + size])) for i in range(len(w) - size + 1) if w]
        want = []
        for d, t in _texts(untidy):
            w = cut(t)
            hit, met = set(), set()
            for item, win in windows:
                for i in range(len(w) - len(win) + 1) if len(w) < 10_000 else ():
                    if tuple(w[i : i + len(win)]) == win:
                        hit.update(range(i, i + len(win)))
                        met.add(item)
            ids = ",".join(sorted(str(i) for i in met - {None}))
            want.append((d, len(w), len(hit), len(met - {None}), hashlib.sha256(ids.encode()).hexdigest()))
        assert sorted(str(tuple(r)[:5]) for r in found.collect()) == sorted(map(str, want))
    for row in decontaminate.contamination(untidy, spark.createDataFrame(items, "item_id long, text string"), keep="*").where("n_hit > 0").collect():
        raw = row["row"].text.encode()
        assert sum(len(cut(raw[b:e].decode())) for b, e in zip(row.span_begins, row.span_ends, strict=True)) == row.n_hit


def test_topk_ties_nulls_and_repeats(spark):
    rows = [(i, [float(i % 3), 0.5]) for i in range(30)] + [(0, [0.0, 0.5]), (31, None), (32, [1.0, float("nan")]), (33, [1.0, None]), (34, [1.0]), (35, []), (None, [1.0, 1.0])]
    vectors = topk_search.integer_vectors(spark.createDataFrame(rows, "vec_id long, embedding array<double>"))
    for group_bytes in (topk_search.GROUP_BYTES, 40):
        found = topk_search.top_k(vectors, F.col("vec_id") % 10 == 0, 4, group_bytes).collect()
        want = []
        for q in (0, 10, 20):
            scored = sorted((-(256 * (q % 3) * 256 * (c % 3) + 128 * 128), c) for c in range(30) if c != q)[:4]
            want += [(q, n + 1, c, -s) for n, (s, c) in enumerate(scored)]
        assert sorted(map(tuple, found)) == want
    big = topk_search.integer_vectors(spark.createDataFrame([(i, [1e6 * i, -1e6 * i]) for i in range(1, 8)], "vec_id long, embedding array<double>"))
    assert [r.vec_id for r in topk_search.top_k(big, F.col("vec_id") == 1, 2).orderBy("rank").collect()] == [7, 6]


def test_url_parts_and_rank(spark):
    urls = ["HTTP://A.Example.NET/en/x?y#z", "http://x.org", "no url", None, "a://b://c/d", "//h/p", "https://EXAMPLE.com/de/?q", "http://net", "http://net/"]
    pages = spark.createDataFrame([(i, u, None, "v") for i, u in enumerate(urls)], "page_id long, url string, html string, rule string")
    found = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in url_trust.judge(pages).collect()}
    assert found[0] == ("a.example.net", "/en/x", "example.net/en/", "allow")
    assert found[1] == ("x.org", "", None, "allow")
    assert found[2] == found[3] == found[5] == ("", "", None, "allow")
    assert found[4][:2] == ("b:", "//c/d")
    assert found[6] == ("example.com", "/de/", "example.com/de/", "block")
    assert found[7] == ("net", "", None, "allow") and found[8] == ("net", "/", "net/", "block")


def test_distrust_flows_against_links(spark):
    link = lambda *hosts: "".join(f"<a class=x href='https://{h}/p'>t</a>" for h in hosts)
    rows = [(1, "http://spam.net/a", ""), (2, "http://friend.com/a", link("spam.net", "spam.net")), (3, "http://good.org/fr/a", link("neutral.com")), (4, "http://neutral.com/x", None)]
    found = {r.page_id: r for r in url_trust.judge(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert [found[i].verdict for i in (1, 2, 3, 4)] == ["block", "block", "allow", "allow"]
    assert found[2].distrust > 0 and found[4].trust > 0


def test_pagerank_by_matrix(spark):
    rng = random.Random(2)
    edges = {(rng.randrange(12), rng.randrange(12)): rng.randint(1, 4) for _ in range(30)}
    matrix = np.zeros((12, 12))
    for (a, b), n in edges.items():
        matrix[a, b] = n
    seed = np.isin(np.arange(12), [0, 5]) / 2
    share = matrix / np.maximum(matrix.sum(1, keepdims=True), 1)
    rank = seed
    for _ in range(200):
        moved = 0.85 * rank @ share
        rank = moved + (1 - moved.sum()) * seed
    table = spark.createDataFrame([(str(a), str(b), n) for (a, b), n in edges.items()], "src string, dst string, n long")
    seeds = spark.createDataFrame([("0",), ("5",)], "node string")
    found = {r.node: r["rank"] for r in url_trust.pagerank(table, seeds, rounds=100, tolerance=1e-10).collect()}
    assert np.allclose([found.get(str(i), 0.0) for i in range(12)], rank, atol=1e-8)


def test_pagerank_ends_by_its_tolerance(spark):
    edges = spark.createDataFrame([("a", "b", 1), ("b", "a", 1)], "src string, dst string, n long")
    found = {r.node: r["rank"] for r in url_trust.pagerank(edges, spark.createDataFrame([("a",)], "node string"), tolerance=1e-3).collect()}
    assert abs(found["a"] - 1 / 1.85) < 1e-3


def test_warc_audit(spark):
    rows = [(i, f"u{i}", "x" * (i % 7) * 40) for i in range(3000)] + [(None, "u", "y"), (7, "u7", "x" * 0), (8, None, None)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    archive = warc_audit.archive(pages)
    assert warc_audit.audit(archive, archive).count() == 0
    damaged = spark.createDataFrame([(i, u, "z" * len(h) if i == 1500 and h else h) for i, u, h in rows if i != 2999] + [(9000, "new", "n")], pages.schema)
    found = {(r.id, r.kind) for r in warc_audit.audit(archive, warc_audit.archive(damaged)).collect()}
    assert found == {(1500, "changed"), (2999, "missing"), (9000, "extra")}
    gone = warc_audit.audit(archive, archive.where("false"))
    assert gone.where("kind = 'missing'").count() == gone.count() == archive.count()


def test_warc_audit_counts_repeats(spark):
    rows = [(i, f"u{i}", "x" * i) for i in range(5)]
    schema = "page_id long, url string, html string"
    archive, repeated = (warc_audit.archive(spark.createDataFrame(r, schema)) for r in (rows, [*rows, rows[3]]))
    found = {(r.id, r.kind) for r in warc_audit.audit(archive, repeated).collect()}
    assert found == {(3, "copies"), (4, "moved")}


def test_language_edges(spark, untidy):
    model = language_id.fit(untidy, language_id.learned_from())
    found = {r.row.text: r.lang_pred for r in language_id.identified(untidy, model, keep="*").collect()}
    assert found[None] == found[""] == found["12 34 !!"] == "und"
    assert set(found.values()) == {"de", "en", "und"}
    assert language_id.identified(untidy, None).where("lang_pred <> 'und' OR score <> 0").count() == 0


def test_pipeline_rejects_texts_unlike_every_language(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text", "lang")
    rng = random.Random(4)
    junk = [(-1 - n, rng.randbytes(1500).hex(), None) for n in range(5)] + [(-9, "".join(chr(rng.randrange(0x4E00, 0x9000)) for _ in range(300)), None)]
    kept = {r.doc_id for r in corpus_pipeline.in_a_language(spark, docs.unionAll(spark.createDataFrame(junk, docs.schema)), sf_dir).collect()}
    assert kept == {r.doc_id for r in docs.where(F.col("text").rlike(r"\p{L}")).collect()}


@pytest.mark.parametrize(
    ("page", "text"),
    [
        (None, ""), ("", ""), ("a plain sentence stands here, without any markup.", "a plain sentence stands here, without any markup."),
        ("<article><h1>T</h1><p>A &amp; b\n c&#33;<p>d<br>e</article><footer>f</footer>", "T\n\nA & b c!\n\nd e"),
        ("<article><p>x</p><div class='comment-list'><p>first reader says a lot of words here.</p></div><script>s</script></article>", "x"),
        ("<div class=sidebar>s</div><main><ul><li>one<li>two</ul><form><p>Join</p></form></main>", "one\n\ntwo"),
        ("<div id=cookie-notice><p>We use cookies to make this site better for you.</p></div><article><p>y</p><aside>z</aside></article>", "y"),
        ("<article><p>a &lt;b&gt; c</p><!-- no --><style>q</style>tail text</article", "a <b> c\n\ntail text"),
        ("<p>" * 3000 + "Deep text which is long enough to be the content of a page.", "Deep text which is long enough to be the content of a page."),
    ],
)
def test_html_cases(page, text):
    assert html_mincut.main_text(page) == text


def test_min_cut_is_minimal():
    rng = random.Random(4)
    for _ in range(200):
        n = rng.randint(1, 7)
        prices = [rng.choice([-2, -0.5, -0.1, 0.1, 0.4, 2]) for _ in range(n)]
        edges = [(a, b, rng.choice([0.1, 0.5, 1.0])) for a in range(n) for b in range(a) if rng.random() < 0.5]

        def cost(label, prices=prices, edges=edges):
            return sum((-p if x else 0) + max(p, 0) for p, x in zip(prices, label, strict=True)) + sum(c for a, b, c in edges if label[a] != label[b])

        best = min(cost([bool(m >> i & 1) for i in range(n)]) for m in range(1 << n))
        assert cost(html_mincut.min_cut(prices, edges)) == pytest.approx(best)


def test_raking_edges(spark, untidy):
    found = raking.standard_mix(untidy)
    assert found.columns[:3] == untidy.columns[:3] and found.count() == untidy.count()
    assert found.where("mix_probability IS NULL OR mix_weight IS NULL OR mix_kept IS NULL").count() == 0
    assert found.where("mix_tokens = 0 AND NOT mix_kept").count() == 0


def test_ctw_edges(spark, untidy):
    held = F.crc32(F.col("doc_id").cast("string")) % 5 == 1
    rows = ctw.scores(untidy.where("length(text) < 5000 OR text IS NULL"), held, depth=3).collect()
    assert all(np.isfinite(r.score) and np.isfinite(r.base_score) for r in rows)
    ends = {round(r.score, 6) for r in rows if r.n_tokens == 1}
    assert len(ends) == 1
    nothing = ctw.scores(untidy.where("doc_id = 1"), F.lit(True), depth=3).first()
    assert nothing.train_tokens == 0 and nothing.n_known == 0
    assert nothing.score == pytest.approx(-8 * np.log10(2) * (len(" ".join(WORD.findall(untidy_texts()[1])).encode()) + 1))


def test_empty_tables(spark, untidy, sf_dir):
    none = untidy.where("false")
    items = spark.createDataFrame([], "item_id long, text string")
    assert substring_dedup.deduplicated(none).count() == 0
    assert jaccard_join.similar_sets(none).count() == 0
    assert decontaminate.contamination(none, items).count() == 0
    assert decontaminate.contamination(untidy, items).where("n_hit > 0").count() == 0
    assert language_id.fit(none, language_id.learned_from()) is None
    assert ctw.scores(none, F.lit(False)).count() == 0
    assert raking.standard_mix(none).count() == 0
    pages = spark.createDataFrame([], "page_id long, url string, html string")
    assert url_trust.judge(pages).count() == 0 and html_mincut.extracted(pages).count() == 0
    assert warc_audit.audit(warc_audit.archive(pages), warc_audit.archive(pages)).count() == 0
    vectors = topk_search.integer_vectors(spark.createDataFrame([], "vec_id long, embedding array<float>"))
    assert topk_search.top_k(vectors, F.lit(True)).count() == 0
    docs = none.select("doc_id", "text", "lang", "source", "n_chars")
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, sf_dir)
    assert docs.count() == 0


def test_texts_are_scanned_in_one_python_step(spark):
    items = spark.createDataFrame([(1, "a b c d e f g h i j k l"), (2, "m n o")], "item_id long, text string")
    docs = spark.createDataFrame([(1, "x a b c d e f g h i j y"), (2, "m n o"), (3, None)], "doc_id long, text string")
    for part_chars in (1 << 20, 20):
        found = decontaminate.contamination(docs, items, part_chars=part_chars)
        assert found._jdf.queryExecution().executedPlan().toString().count("MapInArrow") == 1
        assert {r.doc_id: (r.n_hit, r.n_items) for r in found.collect()} == {1: (10, 1), 2: (3, 1), 3: (0, 0)}


def test_op9_strings_are_asked_for_but_not_written(spark, monkeypatch):
    written = {}

    def stage(df, name):
        written[name] = session.write_stage(df, name)
        return written[name]

    monkeypatch.setattr(ctw, "write_stage", stage)
    table = spark.createDataFrame([(n, f"ein Wort {n % 3} und noch eins") for n in range(12)], "doc_id long, text string")
    before = spark.conf.get(session.SHUFFLE_CLEANUP)
    ctw.scores(table, F.col("doc_id") % 4 == 1, depth=2, head=5)
    assert spark.conf.get(session.SHUFFLE_CLEANUP) == before
    assert [r.kind for r in written["blocks"].select("kind").distinct().collect()] == [ctw.TEXT]


def test_op9_counts_pack_small():
    number = np.random.default_rng(1).geometric(0.4, 10_000)
    assert (ctw._unpack_counts(ctw._pack_counts(number)) == number).all()
    assert len(ctw._pack_counts(number)) < len(number)
    assert len(ctw._unpack_counts(ctw._pack_counts(number[:0]))) == 0
