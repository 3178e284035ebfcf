"""Every query of the training-data operators: beside DuckDB where SQL can state it, else beside a brute-force version."""

import collections
import math
import re
import zlib

import numpy as np
import pytest

import corpus_pipeline
from postmill.llm import ctw, queries
from tests.oracle_check import compare, connect

LOW = str.maketrans({chr(i): chr(i + 32) for i in range(65, 91)})
WORD = re.compile("[^\x20\x09-\x0d]+")


@pytest.fixture(scope="module")
def con(sf_dir):
    return connect(sf_dir)


@pytest.fixture(scope="module")
def documents(con):
    return con.execute("SELECT doc_id, text, lang FROM documents ORDER BY doc_id").fetchall()


@pytest.mark.parametrize("name", sorted(queries.oracle_sql()))
def test_beside_sql(spark, con, sf_dir, name):
    assert compare(spark, con, name, sf_dir) is None


def test_op1(spark, con, sf_dir):
    rows = queries.REGISTRY["op1_url_trust"](spark, sf_dir).collect()
    rules = [("block", "net", "/"), ("allow", "example.net", "/en/"), ("block", "example.com", "/de/"), ("allow", "org", "/fr/")]
    urls = dict(con.execute("SELECT page_id, url FROM pages").fetchall())
    assert len(rows) == len(urls)
    for row in rows:
        rest = urls[row.page_id].split("://", 1)[1]
        host, path = re.match(r"([^/?#]*)([^?#]*)", rest).groups()
        fit = [r for r in rules if (host == r[1] or host.endswith("." + r[1])) and path.startswith(r[2])]
        best = max(fit, key=lambda r: len(r[1] + r[2]), default=None)
        assert (row.host, row.path, row.rule) == (host, path, best and best[1] + best[2])
        assert row.verdict in ("allow", "block") and (best is None or row.verdict == best[0])


def test_op5_held_out(spark, documents, sf_dir):
    rows = {r.doc_id: r for r in queries.REGISTRY["op5_language_kernel"](spark, sf_dir).collect()}
    assert rows.keys() == {i for i, _, _ in documents}
    assert all(r.held_out == (zlib.crc32(str(i).encode()) % 4 == 2) and 0 <= r.score <= 1 for i, r in rows.items())
    held = [(rows[i].lang_pred, lang) for i, _, lang in documents if rows[i].held_out]
    assert np.mean([a == b for a, b in held]) > 0.95


def test_op6_article(spark, con, sf_dir):
    import html

    rows = {r.page_id: r for r in queries.REGISTRY["op6_html_mincut"](spark, sf_dir).collect()}
    for page_id, page in con.execute("SELECT page_id, html FROM pages").fetchall():
        article = re.search(r"<article>(.*?)(</article>|<footer|$)", page, re.S).group(1).replace("<br>", " ")
        blocks = [re.sub(r"\s+", " ", html.unescape(re.sub(r"<[^>]+>", "", b))).strip() for b in re.split(r"</?(?:p|h1)>", article)]
        assert rows[page_id].text == "\n\n".join(b for b in blocks if b)
        assert rows[page_id].n_chars == len(rows[page_id].text)


def _tokens(text):
    return [*WORD.findall((text or "").translate(LOW)), None]


def test_op9_base(spark, documents, sf_dir):
    rows = queries.REGISTRY["op9_ctw_score"](spark, sf_dir).orderBy("doc_id").collect()
    train = [i for i, (d, _, _) in enumerate(documents) if zlib.crc32(str(d).encode()) % 5 != 1]
    tokens = [_tokens(t) for _, t, _ in documents]
    counts = collections.Counter(w for i in train for w in tokens[i])
    n, v = sum(counts.values()), len(counts)
    for row, own in zip(rows, tokens, strict=True):
        base = sum(math.log10((counts[w] + 0.5) / (n + 0.5 * (v + 1))) for w in own)
        assert row.base_score == pytest.approx(base) and row.train_tokens == n
        assert (row.n_tokens, row.n_known) == (len(own), sum(counts[w] > 0 for w in own))
        assert row.score < 0


def _brute_tree(texts, depth):
    """Prediction by recursion over a dictionary of all nodes."""
    counts, children = collections.defaultdict(lambda: [0, 0]), collections.defaultdict(set)

    def steps(text):
        stream = bytes([255] * depth) + b" ".join(w.encode() for w in _tokens(text)[:-1]) + b"\xff"
        for n in range(depth, len(stream)):
            context = tuple(stream[n - 1 - j] for j in range(depth))
            for k in range(8):
                yield context, (1 << k) | stream[n] >> (8 - k), stream[n] >> (7 - k) & 1

    for text in texts:
        for context, prefix, bit in steps(text):
            for d in range(depth + 1):
                counts[context[:d], prefix][bit] += 1
                if d < depth:
                    children[context[:d], prefix].add((context[: d + 1], prefix))
    weighted, share = {}, {}
    for node in sorted(counts, key=lambda x: -len(x[0])):
        a, b = counts[node]
        e = math.lgamma(a + 0.5) + math.lgamma(b + 0.5) - math.log(math.pi) - math.lgamma(a + b + 1)
        below = sum(weighted[c] for c in children[node])
        weighted[node] = e if len(node[0]) == depth else np.logaddexp(e, below) - math.log(2)
        share[node] = 1 if len(node[0]) == depth else math.exp(e - math.log(2) - weighted[node])

    def one(context, prefix, d=0):
        node = context[:d], prefix
        if node not in counts:
            return None
        a, b = counts[node]
        longer = one(context, prefix, d + 1) if d < depth else None
        kt = (b + 0.5) / (a + b + 1)
        return kt if longer is None else share[node] * kt + (1 - share[node]) * longer

    def score(text):
        total = 0.0
        for context, prefix, bit in steps(text):
            p = one(context, prefix)
            p = 0.5 if p is None else p
            total += math.log10(p if bit else 1 - p)
        return total

    return score


def test_op9_tree(spark, documents, sf_dir):
    from pyspark.sql import functions as F

    train = [d for d, _, _ in documents[:8]]
    want = _brute_tree([t for _, t, _ in documents[:8]], 3)
    table = spark.read.parquet(f"{sf_dir}/documents.parquet").where(F.col("doc_id") < 14)
    found = {r.doc_id: r.score for r in ctw.scores(table, ~F.col("doc_id").isin(train), depth=3).collect()}
    for doc_id, text, _ in documents[:14]:
        assert found[doc_id] == pytest.approx(want(text), rel=1e-5)


def test_op9_batches_of_strings_change_nothing(spark, sf_dir):
    from pyspark.sql import functions as F

    table = spark.read.parquet(f"{sf_dir}/documents.parquet")
    held = F.crc32(F.col("doc_id").cast("string")) % 5 == 1
    full = ctw.scores(table, held, depth=3)
    small = ctw.scores(table, held, depth=3, max_grams=2000, head=50)
    exact = ctw.scores(table, held, depth=1)
    score = lambda d: [r.score for r in d.orderBy("doc_id").collect()]
    assert score(small) == pytest.approx(score(full), rel=1e-6)
    base = lambda d: [(r.doc_id, round(r.base_score, 6), r.n_known) for r in d.orderBy("doc_id").collect()]
    assert base(small) == base(exact)


def test_op9_holds_every_context(spark, documents, sf_dir):
    from pyspark.sql import functions as F

    train = [d for d, _, _ in documents[:8]]
    want = _brute_tree([t for _, t, _ in documents[:8]], 5)
    table = spark.read.parquet(f"{sf_dir}/documents.parquet").where(F.col("doc_id") < 14)
    found = {r.doc_id: r.score for r in ctw.scores(table, ~F.col("doc_id").isin(train), depth=5, max_grams=50).collect()}
    for doc_id, text, _ in documents[:14]:
        assert found[doc_id] == pytest.approx(want(text), rel=1e-5)


def test_op10(spark, con, sf_dir):
    rows = queries.REGISTRY["op10_raking"](spark, sf_dir).toPandas()
    words = dict(con.execute(r"SELECT doc_id, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) FROM documents").fetchall())
    assert rows.mix_tokens.tolist() == [words[d] for d in rows.doc_id]
    total = rows.mix_tokens.sum()
    assert (rows.mix_tokens * rows.mix_probability).sum() == pytest.approx(0.8 * total)
    for dimension, power in (("mix_source", 0.7), ("mix_lang", 0.7), ("mix_topic", 0.9)):
        wanted = rows.groupby(dimension).mix_tokens.sum() ** power
        got = (rows.mix_tokens * rows.mix_probability * rows.mix_weight).groupby(rows[dimension]).sum()
        assert np.allclose(got / got.sum(), wanted / wanted.sum(), atol=1e-5)
    # cells by plain iterative fitting
    cells = rows.groupby(["mix_source", "mix_lang", "mix_topic"]).mix_tokens.sum().rename("w").reset_index().astype({"w": float})
    cells["w"] /= cells.w.sum()
    for _ in range(60):
        for dimension, power in (("mix_source", 0.7), ("mix_lang", 0.7), ("mix_topic", 0.9)):
            wanted = rows.groupby(dimension).mix_tokens.sum() ** power
            cells["w"] *= cells[dimension].map(wanted / wanted.sum()) / cells.groupby(dimension).w.transform("sum")
    got = (rows.mix_tokens * rows.mix_probability * rows.mix_weight / total).groupby([rows.mix_source, rows.mix_lang, rows.mix_topic]).sum()
    assert np.allclose(got.to_numpy(), cells.w.to_numpy(), atol=1e-5)


def test_pipeline(spark, con, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    columns = docs.columns
    kept = docs.count()
    for n, (_, stage) in enumerate(corpus_pipeline.STAGES):
        docs = corpus_pipeline.write_stage(stage(spark, docs, sf_dir), "stage")
        assert n == 4 or docs.columns == columns
        assert 0.7 * kept < docs.count() <= kept
        kept = docs.count()
    assert {"probability", "weight"} < set(docs.columns)
    assert docs.groupBy("doc_id").count().where("count > 1").count() == 0
