"""Registered queries of the training-data operators, with DuckDB SQL where it can state them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from postmill.llm import ctw, decontaminate, html_mincut, jaccard_join, language_id, phrase_graph, raking, resharding, spelling, substring_dedup, topk_search, url_trust, warc_audit
from postmill.llm.common import table

REGISTRY: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(build: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    REGISTRY[build.__name__] = build
    return build


@query
def op1_url_trust(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The verdict on every page's url: rules, then trust and distrust over links between hosts."""
    return url_trust.judge(table(spark, sf_dir, "pages"))


@query
def op2_topk_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 5 best other vectors of every vector whose id is divisible by 50."""
    vectors = topk_search.integer_vectors(table(spark, sf_dir, "embeddings"))
    return topk_search.top_k(vectors, F.col("vec_id") % 50 == 0)


@query
def op3_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups of documents linked by a Jaccard similarity of 0.85 of their 4-word shingles."""
    found = jaccard_join.similar_sets(table(spark, sf_dir, "documents"))
    no_id = F.lit(jaccard_join.NO_ID)
    return found.select(
        F.nullif("id", no_id).alias("doc_id"), F.col("n").alias("n_shingles"), F.nullif("component", no_id).alias("component_id")
    )


@query
def op4_warc_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An archive of all pages against a replica in which bits of some records have turned; the damaged records."""
    pages = table(spark, sf_dir, "pages")
    turned = F.col("page_id") * 7919 % 50 == 7
    middle = (F.char_length("html") / 2).cast("int") + 1
    replica = pages.withColumn("html", F.when(turned & (F.char_length("html") > 0), F.overlay("html", F.lit("\x01"), middle)).otherwise(F.col("html")))
    found = warc_audit.audit(warc_audit.archive(pages), warc_audit.archive(replica))
    return found.select(F.col("id").alias("page_id"), "file", "offset_a", "offset_b", "length_a", "length_b", "digest_a", "digest_b", "kind")


@query
def op5_language_kernel(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The language of every document, learned from those whose remainder is not 2."""
    documents = table(spark, sf_dir, "documents")
    model = language_id.fit(documents, language_id.learned_from())
    found = language_id.identified(documents, model)
    return found.select(F.col("row").alias("doc_id"), F.lit(False).alias("held_out"), "lang_pred", "score").withColumn("held_out", language_id.held_out())


@query
def op6_html_mincut(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The main text of every page."""
    return html_mincut.extracted(table(spark, sf_dir, "pages"))


@query
def op7_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of passages of 13 words or more which also stand in a document with a smaller id."""
    found = substring_dedup.deduplicated(table(spark, sf_dir, "documents").select("doc_id", "text"), with_text=False)
    return found.select("row.doc_id", "n_words", "n_removed", "kept_sha256")


@query
def op8_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Benchmark windows in every document."""
    return decontaminate.digest(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query
def op9_ctw_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    """log10 probability of every document by context-tree weighting, and by word frequencies."""
    return ctw.scores(table(spark, sf_dir, "documents"), F.crc32(F.col("doc_id").cast("string")) % 5 == 1)


@query
def op10_raking(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's weight and sampling probability under source, language and topic targets."""
    found = raking.standard_mix(table(spark, sf_dir, "documents").select("doc_id", "text", "lang", "source"))
    return found.drop("text", "lang", "source")


@query
def op11_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 2,000 best collocations of two to five words of every language."""
    return phrase_graph.collocations(table(spark, sf_dir, "documents"))


@query
def op12_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every frequent word with its near words and the more frequent form it varies."""
    return spelling.variants(spelling.word_counts(table(spark, sf_dir, "documents")))


@query
def op13_resharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents, laid in 6 shards by their text, moved into 8 shards of equal bytes."""
    return resharding.resharded(table(spark, sf_dir, "documents"))


ORACLES: dict[str, str] = {}

ORACLES["op2_topk_search"] = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), pairs AS (
  SELECT q.vec_id AS query_id, c.vec_id, list_dot_product(q.v::DOUBLE[], c.v::DOUBLE[])::BIGINT AS score
  FROM v q JOIN v c ON q.vec_id <> c.vec_id WHERE q.vec_id % 50 = 0
)
SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INT AS rank, vec_id, score
FROM pairs QUALIFY rank <= 5
"""

ORACLES["op3_jaccard_join"] = """
WITH RECURSIVE docs AS (
  SELECT doc_id, coalesce(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x20\\x09-\\x0D]+'), []) AS w
  FROM documents
),
grams AS (
  SELECT DISTINCT doc_id, array_to_string(w[i:i + least(4, len(w)) - 1], ' ') AS g
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - least(4, len(w)) + 2)) AS i FROM docs WHERE len(w) > 0)
),
sizes AS (SELECT doc_id, count(*) AS n FROM grams GROUP BY doc_id),
common AS (SELECT g FROM grams GROUP BY g HAVING count(*) > 1),
shared AS (SELECT doc_id, g FROM grams SEMI JOIN common USING (g)),
met AS (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS o FROM shared x JOIN shared y ON x.g = y.g AND x.doc_id <> y.doc_id GROUP BY ALL),
links AS (
  SELECT a, b FROM met JOIN sizes s ON s.doc_id = a JOIN sizes t ON t.doc_id = b WHERE 100 * o >= 85 * (s.n + t.n - o)
),
reach(node, seen) AS (
  SELECT a, b FROM links UNION SELECT r.node, l.b FROM reach r JOIN links l ON l.a = r.seen
),
least AS (SELECT node, min(seen) AS m FROM reach GROUP BY node)
SELECT d.doc_id, coalesce(n, 0)::BIGINT AS n_shingles, least(d.doc_id, coalesce(m, d.doc_id)) AS component_id
FROM docs d LEFT JOIN sizes s ON s.doc_id = d.doc_id LEFT JOIN least l ON l.node = d.doc_id
"""

ORACLES["op4_warc_audit"] = """
WITH texts AS (
  SELECT page_id, coalesce(url, '') AS url, coalesce(html, '') AS a,
         CASE WHEN page_id * 7919 % 50 = 7 AND length(html) > 0
              THEN html[1:length(html) // 2] || chr(1) || html[length(html) // 2 + 2:] ELSE coalesce(html, '') END AS b
  FROM pages
),
records AS (
  SELECT page_id,
         'WARC/1.0' || e || 'WARC-Type: response' || e || 'WARC-Target-URI: ' || url || e || 'Content-Length: ' || strlen(a) || e || e || a || e || e AS ra,
         'WARC/1.0' || e || 'WARC-Type: response' || e || 'WARC-Target-URI: ' || url || e || 'Content-Length: ' || strlen(b) || e || e || b || e || e AS rb
  FROM texts, (SELECT chr(13) || chr(10) AS e)
),
placed AS (
  SELECT page_id, page_id // 500 AS file, ra, rb, strlen(ra)::BIGINT AS length_a, strlen(rb)::BIGINT AS length_b,
         (sum(strlen(ra)) OVER w - strlen(ra))::BIGINT AS offset_a, (sum(strlen(rb)) OVER w - strlen(rb))::BIGINT AS offset_b
  FROM records WINDOW w AS (PARTITION BY page_id // 500 ORDER BY page_id)
)
SELECT page_id, file, offset_a, offset_b, length_a, length_b, sha256(ra) AS digest_a, sha256(rb) AS digest_b,
       CASE WHEN ra = rb THEN 'moved' ELSE 'changed' END AS kind
FROM placed WHERE ra <> rb OR offset_a <> offset_b
"""

ORACLES["op7_substring_dedup"] = """
WITH docs AS (SELECT doc_id, coalesce(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+'), []) AS w FROM documents),
places AS (SELECT doc_id, unnest(range(1, len(w) - 11)) AS i, w FROM docs WHERE len(w) >= 13),
windows AS (SELECT doc_id, i, array_to_string(w[i:i + 12], ' ') AS win FROM places),
least AS (SELECT win, min(doc_id) AS first_id FROM windows GROUP BY win),
covered AS (
  SELECT DISTINCT doc_id, unnest(range(i, i + 13)) AS i FROM windows JOIN least USING (win) WHERE first_id < doc_id
),
n_covered AS (SELECT doc_id, list(i) AS gone FROM covered GROUP BY doc_id)
SELECT d.doc_id, len(w)::BIGINT AS n_words, coalesce(len(gone), 0)::BIGINT AS n_removed,
       sha256(array_to_string(list_filter(w, lambda x, j: NOT list_contains(coalesce(gone, []), j)), ' ')) AS kept_sha256
FROM docs d LEFT JOIN n_covered USING (doc_id)
"""

_WORDS8 = r"regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"

ORACLES["op8_decontaminate"] = f"""
WITH items AS (SELECT item_id, {_WORDS8} AS w FROM benchmark WHERE text IS NOT NULL),
windows AS (
  SELECT DISTINCT item_id, least(10, len(w)) AS size, array_to_string(w[i:i + least(10, len(w)) - 1], ' ') AS win
  FROM (SELECT item_id, w, unnest(range(1, len(w) - least(10, len(w)) + 2)) AS i FROM items WHERE len(w) > 0)
),
docs AS (SELECT doc_id, coalesce({_WORDS8}, []) AS w FROM documents),
places AS (SELECT doc_id, w, unnest(range(1, len(w) + 1)) AS i FROM docs),
hits AS (
  SELECT p.doc_id, p.i, s.size, x.item_id
  FROM places p, (SELECT DISTINCT size FROM windows) s, windows x
  WHERE p.i + s.size - 1 <= len(p.w) AND x.size = s.size AND x.win = array_to_string(p.w[p.i:p.i + s.size - 1], ' ')
),
covered AS (SELECT DISTINCT doc_id, unnest(range(i, i + size)) AS i FROM hits),
n_hit AS (SELECT doc_id, count(*) AS n FROM covered GROUP BY doc_id),
n_items AS (
  SELECT doc_id, count(*) AS n, string_agg(s, ',' ORDER BY s COLLATE "C") AS ids
  FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS s FROM hits) GROUP BY doc_id
)
SELECT d.doc_id, len(d.w)::BIGINT AS n_words, coalesce(h.n, 0)::BIGINT AS n_hit, coalesce(t.n, 0)::BIGINT AS n_items,
       sha256(coalesce(t.ids, '')) AS items_sha256, coalesce(h.n, 0) > 0 AS contaminated
FROM docs d LEFT JOIN n_hit h USING (doc_id) LEFT JOIN n_items t USING (doc_id)
"""

ORACLES["op11_collocations"] = """
WITH texts AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\\x0A-\\x0D]')) AS piece
  FROM documents
),
pieces AS (SELECT lang, regexp_extract_all(piece, '[^\\x20\\x09]+') AS w FROM texts),
totals AS (SELECT lang, sum(len(w))::HUGEINT AS n FROM pieces GROUP BY lang),
places AS (SELECT lang, w, unnest(range(1, len(w) + 1)) AS i FROM pieces WHERE len(w) > 0),
counts AS (
  SELECT lang, array_to_string(w[i:i + k - 1], ' ') AS phrase, k AS size, count(*)::HUGEINT AS f
  FROM places, (SELECT unnest(range(1, 6)) AS k) WHERE i + k - 1 <= len(w) GROUP BY ALL HAVING count(*) >= 100
),
candidates AS (SELECT lang, phrase, size, f AS a, string_split(phrase, ' ') AS w FROM counts WHERE size >= 2),
parts AS (
  SELECT lang, array_to_string(w[i:i + k - 1], ' ') AS phrase, max(a) AS f
  FROM candidates, (SELECT unnest(range(1, 6)) AS i), (SELECT unnest(range(2, 5)) AS k) WHERE k < size AND i + k - 1 <= size GROUP BY ALL
),
kept AS (SELECT c.* FROM candidates c LEFT JOIN parts p USING (lang, phrase) WHERE p.f IS NULL OR 100 * p.f < 100 * a),
cuts AS (
  SELECT c.lang, c.phrase, c.a, k, x.f AS l, y.f AS r, n, (1000 * c.a * n) // (x.f * y.f) AS score
  FROM (SELECT *, unnest(range(1, size)) AS k FROM kept) c JOIN totals USING (lang)
  JOIN counts x ON x.lang = c.lang AND x.phrase = array_to_string(w[1:k], ' ')
  JOIN counts y ON y.lang = c.lang AND y.phrase = array_to_string(w[k + 1:], ' ')
),
lowest AS (SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase,
       a::BIGINT AS a, l::BIGINT AS l, r::BIGINT AS r, n::BIGINT AS n, score::BIGINT AS score
FROM lowest QUALIFY rank <= 2000
"""


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return dict(REGISTRY)


def oracle_sql() -> dict[str, str]:
    return dict(ORACLES)
