"""The registered queries in DuckDB SQL, written from the rules rather than from the Spark code."""

from __future__ import annotations

import textwrap

from postmill import fixed_values as fv
from postmill.plans import fixtures as fx
from postmill.plans.queries import EVAL_FLAGS, EVAL_TEXTS


def s(text: str) -> str:
    """A string literal."""
    return "'" + text.replace("'", "''") + "'"


def arr(values: list[str]) -> str:
    return "[" + ", ".join(s(v) for v in values) + "]"


P = f"""
base AS (
  SELECT o_orderkey AS k, o_custkey, c_name, c_mktsegment, o_orderpriority, o_totalprice, o_orderdate,
         n_name AS n1, 'NATION_' || ((c_nationkey + 7) % 25) AS n2, 'NATION_' || ((c_nationkey + 11) % 25) AS n3,
         o_orderkey % 2 = 0 AS is_a
  FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey),
p0 AS (
  SELECT k, 'p' || k AS _id, is_a, c_name, CASE WHEN is_a THEN 'stepstone' ELSE 'indeed' END AS collection,
    CASE WHEN k % 97 = 0 THEN ''
         WHEN is_a THEN 'https://www.stepstone.de/jobs/' || o_custkey || '?k=' || (k % 3)
         ELSE 'https://de.indeed.com/viewjob/' || k END AS url_raw,
    CASE WHEN k % 194 = 97 THEN 'https://jobs.example.org/' || k END AS url_alt,
    CASE WHEN k % 31 = 0 THEN '' ELSE ' ' || o_orderpriority || ' ' || c_mktsegment || ' ' END AS title,
    CASE WHEN NOT is_a THEN c_name END AS company_name,
    CASE k % 7 WHEN 0 THEN CASE WHEN k % 14 = 0 THEN n1 ELSE 'Ort_' || o_custkey END
      WHEN 1 THEN n1 || ', ' || n2 WHEN 2 THEN n1 || '; ' || n2 || ' / ' || n3
      WHEN 3 THEN n1 || ' (Zentrum) und ' || n2 WHEN 4 THEN '12345 ' || n1 || ' bei ' || n2
      WHEN 5 THEN 'bundesweit' ELSE CASE WHEN k % 14 = 6 THEN 'Nirgendwo' ELSE 'Irgendwo' END END AS loc,
    CASE WHEN k % 3 = 0 THEN 'Feste Anstellung' ELSE 'Befristet' END AS contract,
    CASE k % 8 WHEN 1 THEN '1,000 Mitarbeiter' WHEN 2 THEN '51-250' WHEN 3 THEN '10.000' WHEN 4 THEN 'keine Angabe'
      WHEN 5 THEN '0' WHEN 6 THEN CAST(CAST(floor(o_totalprice) AS BIGINT) AS VARCHAR)
      WHEN 7 THEN '2,501-10,000 Mitarbeiter' END AS size,
    k % 16 <> 1 AS size_is_list,
    {arr(fx.PHRASES)} AS ph, {arr(fx.TEXTS)} AS tx,
    CASE k % 5 WHEN 0 THEN 'dict' WHEN 1 THEN 'none' ELSE 'list' END AS para,
    CASE WHEN k % 9 = 0 THEN NULL WHEN k % 9 = 1 THEN 'gestern'
      WHEN k % 9 <= 5 THEN strftime(o_orderdate, '%Y-%m-%d') || 'T00:30:00+02:00'
      ELSE strftime(o_orderdate, '%Y-%m-%d') || 'T23:15:00Z' END AS date_posted
  FROM base),
p AS (
  SELECT *, CASE WHEN url_raw <> '' THEN url_raw ELSE coalesce(url_alt, '') END AS url,
    CASE WHEN k % 4 = 0 THEN [ph[1 + k % 12], ph[1 + (k + 1) % 12]] END AS listed,
    CASE WHEN NOT is_a THEN list_concat(list_concat(list_concat([ph[1 + k % 12], ph[1 + (5 * k) % 12]],
        CASE WHEN k % 4 = 1 THEN ['Nicht gefunden'] ELSE [] END), CASE WHEN k % 6 = 1 THEN [''] ELSE [] END),
        CASE WHEN k % 3 = 0 THEN ['Leistung ' || (15 + k % 400)] ELSE [] END) ELSE CAST([] AS VARCHAR[]) END AS benefits,
    tx[1 + k % 10] AS tx1, tx[1 + (k // 10) % 10] AS tx2
  FROM p0),
t AS (
  SELECT *,
    list_filter([CASE WHEN is_a THEN '[''' || c_name || ''', ''' || loc || ''', ''' || contract || ''']' END,
      CASE WHEN size_is_list THEN '[''Unternehmensgröße'', ''' || size || ''']' ELSE size END,
      listed[1], listed[2]], lambda x: x IS NOT NULL) AS list_texts,
    CASE WHEN para = 'none' THEN CAST([] AS VARCHAR[]) ELSE [tx1, tx2] END AS para_texts
  FROM p),
f AS (
  SELECT *, array_to_string(list_concat(para_texts, list_texts), ' ') AS description,
    lower(array_to_string(list_concat(list_texts, para_texts), ' ')) AS search_text,
    list_filter(benefits, lambda b: b <> '' AND lower(b) <> 'nicht gefunden') AS direct_benefits,
    CASE WHEN len(listed) > 0 THEN array_to_string(listed, chr(10))
         WHEN para = 'dict' THEN tx1 || chr(10) || tx2 || chr(10) || 'Homeoffice möglich'
         WHEN para = 'list' THEN tx1 || chr(10) || tx2 ELSE '' END AS benefits_text,
    CASE WHEN trim(title) = '' THEN 'Kein Titel' ELSE trim(title) END AS job_title,
    c_name AS company,
    -- the place text of layout B starts with a postal code, which goes
    loc AS location,
    CASE WHEN size_is_list AND size IS NOT NULL THEN size ELSE 'Keine Angaben' END AS size_raw
  FROM t)
"""


def size_case(expr: str) -> str:
    whens = " ".join(
        f"WHEN n > {low}" + ("" if high is None else f" AND n <= {high}") + f" THEN {s(label)}" for low, high, label in fv.SIZE_BUCKETS
    )
    largest = f"list_max(list_transform(regexp_extract_all(replace({expr}, ',', ''), '[0-9]+'), lambda x: CAST(x AS HUGEINT)))"
    return f"(SELECT CASE {whens} ELSE 'Keine Angaben' END FROM (SELECT {largest} AS n))"


def portal_case(url: str) -> str:
    return (
        f"CASE WHEN regexp_matches({url}, 'www\\..*?\\.') THEN regexp_extract({url}, 'www\\.(.*?)\\.', 1) "
        f"WHEN regexp_matches({url}, 'https?://(?:[\\w-]+\\.)*([\\w-]+)\\.com') "
        f"THEN regexp_extract({url}, 'https?://(?:[\\w-]+\\.)*([\\w-]+)\\.com', 1) ELSE 'Unknown' END"
    )


def contains_list(words: list[str]) -> str:
    return "(" + " OR ".join(f"contains(search_text, {s(w)})" for w in words) + ")"


def word_list(words: list[str]) -> str:
    edge = r"[^\p{L}\p{N}_]"
    return f"regexp_matches(search_text, {s(f'(^|{edge})(' + '|'.join(words) + f')($|{edge})')})"


def time_models(models: dict[str, list[str]]) -> str:
    a, b = (contains_list(models[m]) for m in ("Teilzeit", "Vollzeit"))
    return f"CASE WHEN {a} AND {b} THEN ['Teilzeit', 'Vollzeit'] WHEN {a} THEN ['Teilzeit'] ELSE ['Vollzeit'] END"


POSITION = (
    f"CASE WHEN {word_list(fv.POSITIONS['Praktikant'])} THEN 'Praktikant' "
    f"WHEN {word_list(fv.POSITIONS['Werkstudent'])} THEN 'Werkstudent' ELSE 'Normaler Angestellter' END"
)
EMPLOYMENT = (
    f"CASE WHEN (is_a AND contract = 'Feste Anstellung') OR {word_list(fv.PERMANENT_SYNONYMS)} "
    "THEN 'Feste Anstellung' ELSE 'befristet' END"
)
REMOTE = (
    "CASE WHEN contains(lower(array_to_string(list_concat(CASE WHEN para = 'dict' THEN ['Aufgaben', 'Profil'] "
    "ELSE para_texts END, list_texts), ' ')), 'homeoffice möglich') THEN 1 ELSE 0 END"
)
DATE = (
    "CASE WHEN date_posted IS NULL OR date_posted = 'gestern' THEN '05.05.2025' "
    "ELSE strftime(CAST(substr(date_posted, 1, 10) AS DATE), '%d.%m.%Y') END"
)

# Places: comma-separated after clean-up, then single names without postal code.
PLACES = P + r""",
pl0 AS (
  SELECT *, regexp_replace(regexp_replace(regexp_replace(location, '[;/•]| und | oder ', ', ', 'g'),
      '\bbei\b.*', '', 'gi'), '\(.*?\)', '', 'g') AS loose FROM f),
pl1 AS (SELECT *, trim(regexp_replace(loose, '\s*,\s*', ', ', 'g')) AS tidy FROM pl0),
pl2 AS (
  SELECT *, list_transform(regexp_split_to_array(tidy, ',\s*'),
      lambda n: regexp_replace(trim(regexp_replace(n, '\s+', ' ', 'g')), '^\d+\s*', '')) AS places FROM pl1),
pl AS (SELECT *, unnest(places) AS place, CAST(generate_subscripts(places, 1) - 1 AS BIGINT) AS place_pos FROM pl2)
"""

GAZ = f"""
n AS (SELECT * FROM nation JOIN region ON n_regionkey = r_regionkey),
g AS (
  SELECT n_name AS city, 'Staat_' || (n_nationkey % 7) AS state, r_name AS country, CAST(n_nationkey AS BIGINT) AS ord FROM n
  UNION ALL SELECT n_name, 'Heim_' || (n_nationkey % 3), 'EUROPE', 100 + n_nationkey FROM n WHERE n_nationkey % 4 = 0
  UNION ALL SELECT 'Ort_' || c_custkey, 'Staat_' || (c_nationkey % 7), r_name, 1000 + c_custkey
            FROM customer JOIN n ON c_nationkey = n_nationkey),
tr(src, dst) AS (VALUES ('Staat_2', 'Land_2'), ('ASIA', 'Asien')),
g1 AS (SELECT *, row_number() OVER (PARTITION BY lower(city) ORDER BY country <> 'EUROPE', ord) AS rn FROM g),
g2 AS (
  SELECT lower(city) AS city_key,
    CASE WHEN state = 'Staat_1' THEN 'Mapped_1' ELSE coalesce(a.dst, state) END AS state,
    CASE WHEN country = 'EUROPE' THEN 'Europa' ELSE coalesce(b.dst, country) END AS country
  FROM g1 LEFT JOIN tr a ON state = a.src LEFT JOIN tr b ON country = b.src WHERE rn = 1),
gi AS (
  SELECT city_key, state, country, coalesce(a.dst, state) AS state_2, coalesce(b.dst, country) AS country_2
  FROM g2 LEFT JOIN tr a ON state = a.src LEFT JOIN tr b ON country = b.src)
"""

RESOLVED = f"""
pr AS (
  SELECT pl.*,
    CASE WHEN lower(place) = 'bundesweit' THEN 'bundesweit' WHEN i1.city_key IS NOT NULL THEN i1.state
         WHEN i2.city_key IS NOT NULL THEN i2.state_2 ELSE 'Unbekannt' END AS state,
    CASE WHEN lower(place) = 'bundesweit' THEN 'Germany' WHEN i1.city_key IS NOT NULL THEN i1.country
         WHEN i2.city_key IS NOT NULL THEN i2.country_2 ELSE 'Unbekannt' END AS country
  FROM pl LEFT JOIN gi i1 ON i1.city_key = lower(place)
    LEFT JOIN gi i2 ON i2.city_key = lower(CASE WHEN place = 'Nirgendwo' THEN 'NATION_2' ELSE place END))
"""

VEC = f"""
e AS (SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS v FROM embeddings),
ex AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY label ORDER BY vec_id) AS rn FROM e)
       WHERE rn <= {fx.EXAMPLES_PER_LABEL}),
dims AS (SELECT label, unnest(v) AS x, generate_subscripts(v, 1) AS i FROM ex),
means AS (SELECT label, i, avg(x) AS x FROM dims GROUP BY label, i),
ctx AS (SELECT label, list(x ORDER BY i) AS v FROM means GROUP BY label),
direct AS (SELECT e.vec_id, ex.label, max(list_cosine_similarity(e.v, ex.v)) AS direct FROM e, ex GROUP BY ALL),
sc AS (
  SELECT e.vec_id, d.label, {arr(fx.CATEGORIES)}[d.label + 1] AS category, d.direct,
    list_cosine_similarity(e.v, ctx.v) AS context, 0.8 * d.direct + 0.2 * list_cosine_similarity(e.v, ctx.v) AS combined
  FROM e JOIN direct d ON e.vec_id = d.vec_id JOIN ctx ON ctx.label = d.label),
rk AS (SELECT *, row_number() OVER (PARTITION BY vec_id ORDER BY combined DESC, label) AS rank FROM sc),
best AS (
  SELECT vec_id, CASE WHEN combined > 0 THEN category END AS best_category,
    CASE WHEN combined > 0 THEN combined ELSE 0 END AS best_score,
    CASE WHEN combined > {fx.THRESHOLD} THEN 1 ELSE 0 END AS assigned
  FROM rk WHERE rank = 1)
"""
PHRASE_NAME = f"coalesce({arr(fx.PHRASES + ['A', 'B', '1. C'])}[vec_id + 1], 'Leistung ' || vec_id)"


def answer(name: str) -> str:
    return f"{arr(fx.ANSWERS[name])}[1 + o_orderkey % 8]"


RESP = rf"""
r AS (
  SELECT 'p' || o_orderkey AS _id, {answer('experience_response')} AS xr, {answer('branch_response')} AS br,
    regexp_replace({answer('benefits_response')}, '\\x[0-9A-Fa-f]{{2}}', '', 'g') AS t FROM orders),
r1 AS (
  SELECT *, regexp_extract(xr, '(?s)\{{.*?\}}') AS xo, regexp_extract(br, '(?s)\{{.*?\}}') AS bo_first,
    coalesce(list_last(regexp_extract_all(br, '(?s)\{{.*?\}}')), '') AS bo_last, regexp_extract(t, '(?s)\{{.*\}}') AS wide,
    CASE WHEN regexp_matches(t, '(?s)"benefits":\s*\[(.*?)(?:\]|}}|$)')
         THEN regexp_extract(t, '(?s)"benefits":\s*\[(.*?)(?:\]|}}|$)', 1) END AS part FROM r),
r2 AS (
  SELECT _id,
    CASE WHEN json_valid(xo) THEN coalesce(TRY_CAST(json_extract_string(xo, '$.Experience_Required') AS BIGINT), 0) ELSE 0 END
      AS experience,
    CASE WHEN json_valid(bo_first) THEN json_extract_string(bo_first, '$.Kategorie') END AS cat_first,
    CASE WHEN json_valid(bo_last) THEN json_extract_string(bo_last, '$.Kategorie') END AS cat_last,
    CASE WHEN json_valid(t) AND json_type(CASE WHEN json_valid(t) THEN t END) = 'ARRAY' THEN json_extract_string(t, '$[*].benefit')
      WHEN json_valid(t) AND json_type(CASE WHEN json_valid(t) THEN t END, '$.benefits') = 'ARRAY'
        THEN json_extract_string(t, '$.benefits[*]')
      WHEN json_valid(wide) AND json_type(CASE WHEN json_valid(wide) THEN wide END, '$.benefits') = 'ARRAY'
        THEN json_extract_string(wide, '$.benefits[*]')
      WHEN part IS NOT NULL AND json_valid('[' || part || ']') THEN json_extract_string('[' || part || ']', '$[*]')
      WHEN part IS NOT NULL THEN regexp_extract_all(part, '"([^"]*)"', 1)
      ELSE list_filter(list_transform(list_filter(string_split(t, chr(10)),
          lambda l: regexp_matches(l, '^(\s*[-*•]|\d+\.)\s*')), lambda l: trim(regexp_replace(l, '^[\s\-*•]+\s*', ''))),
          lambda l: l <> '') END AS found
  FROM r1),
resp AS (
  SELECT _id, experience, list_filter(found, lambda x, i: list_position(found, x) = i) AS phrases,
    CASE WHEN lower(replace(cat_last, ' ', '')) IN ({', '.join(s(b.lower().replace(' ', '')) for b in fv.BRANCHES)})
         THEN cat_last ELSE 'Andere' END AS branch,
    CASE WHEN cat_first IN ({', '.join(s(b) for b in fv.BRANCHES)}) THEN cat_first ELSE 'Andere' END AS branch_strict
  FROM r2)
"""

LABELLED = PLACES + f""",
lab AS (
  SELECT DISTINCT k, url AS job_url, split_part(url, '?', 1) AS url_key, CASE WHEN k % 101 <> 0 THEN company END AS company,
    CASE WHEN k % 2 = 0 THEN 1 ELSE 0 END AS boni, CASE WHEN k % 3 = 0 THEN 1 ELSE 0 END AS gehalt13,
    CASE WHEN k % 5 = 0 THEN 1 ELSE 0 END AS homeoffice, CASE WHEN k % 7 = 0 THEN 1 ELSE 0 END AS shares,
    places[1] AS stadt, {POSITION} AS position, {DATE} AS datum FROM pl),
va AS (SELECT * FROM lab WHERE k % 3 <> 0),
ex0 AS (SELECT * FROM lab WHERE k % 5 <> 0 OR k % 15 = 0),
xa AS (
  SELECT k, job_url, url_key, company, CASE WHEN k % 11 = 0 THEN 1 - boni ELSE boni END AS boni,
    CASE WHEN k % 11 = 0 THEN 1 - gehalt13 ELSE gehalt13 END AS gehalt13,
    CASE WHEN k % 11 = 0 THEN 1 - homeoffice ELSE homeoffice END AS homeoffice, shares,
    CASE WHEN k % 19 = 0 THEN NULL WHEN k % 17 = 0 THEN '~' || stadt WHEN k % 13 = 0 THEN stadt || ' ' ELSE stadt END AS stadt,
    CASE WHEN k % 19 = 0 THEN NULL WHEN k % 17 = 0 THEN '~' || position WHEN k % 13 = 0 THEN position || ' ' ELSE position END
      AS position,
    CASE WHEN k % 19 = 0 THEN NULL WHEN k % 17 = 0 THEN '~' || datum WHEN k % 13 = 0 THEN datum || ' ' ELSE datum END AS datum
  FROM ex0)
"""


def cell_union() -> str:
    sides = [("Boni", "boni", "incentive"), ("13._Gehalt", "gehalt13", "incentive"), ("Homeoffice", "homeoffice", "incentive"),
             ("Stadt", "stadt", "non_incentive"), ("Position", "position", "non_incentive"), ("Datum", "datum", "non_incentive")]
    assert [n for n, _, _ in sides] == EVAL_FLAGS[:3] + EVAL_TEXTS
    parts = [
        f"SELECT {s(scope)} AS scope, {s(name)} AS column_name, lk, rk, trim(CAST(l_{c} AS VARCHAR)) AS a, trim(CAST(r_{c} AS VARCHAR)) AS b FROM j"
        for name, c, scope in sides
    ]
    parts.append(
        f"SELECT 'incentive', {s(EVAL_FLAGS[3])}, lk, rk, CASE WHEN rk IS NULL THEN CAST(l_shares AS VARCHAR) END, NULL FROM j WHERE rk IS NULL"
    )
    return " UNION ALL ".join(parts)


EVAL = LABELLED + f""",
vf AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY company, url_key ORDER BY k) AS rn FROM va
       WHERE company IS NOT NULL) WHERE rn = 1),
xf AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY company, url_key ORDER BY k) AS rn FROM xa
       WHERE company IS NOT NULL) WHERE rn = 1),
j AS (
  SELECT vf.k AS lk, xf.k AS rk,
    {', '.join(f'vf.{c} AS l_{c}, xf.{c} AS r_{c}' for c in ('boni', 'gehalt13', 'homeoffice', 'shares', 'stadt', 'position', 'datum'))}
  FROM vf FULL JOIN xf ON vf.company = xf.company AND vf.url_key = xf.url_key),
cells AS ({cell_union()}),
marks AS (
  SELECT scope, column_name,
    CASE WHEN a = b THEN 1 ELSE 0 END AS tp,
    CASE WHEN b IS NOT NULL AND (a IS NULL OR a <> b) THEN 1 ELSE 0 END AS fp,
    CASE WHEN a IS NOT NULL AND (b IS NULL OR a <> b) THEN 1 ELSE 0 END AS fn,
    CASE WHEN a IS NULL AND b IS NULL AND lk IS NOT NULL AND rk IS NOT NULL THEN 1 ELSE 0 END AS tn
  FROM cells)
"""
COUNTS = """,
counts AS (
  SELECT coalesce(scope, 'all') AS scope, coalesce(column_name, 'all') AS column_name, CAST(sum(tp) AS BIGINT) AS tp,
    CAST(sum(fp) AS BIGINT) AS fp, CAST(sum(fn) AS BIGINT) AS fn, CAST(sum(tn) AS BIGINT) AS tn
  FROM marks GROUP BY GROUPING SETS ((), (scope), (scope, column_name))),
scores AS (
  SELECT *, CASE WHEN tp + fp + fn + tn > 0 THEN (tp + tn) / (tp + fp + fn + tn) ELSE 1.0 END AS accuracy,
    CASE WHEN tp + fn > 0 THEN tp / (tp + fn) ELSE 1.0 END AS recall FROM counts)
"""


def prompt(template: str, indent: int, value: str) -> str:
    first, rest = template.split("\n", 1)
    body = first + "\n" + textwrap.indent(rest, " " * indent) + (" " * indent if template.endswith("\n") else "")
    before, after = body.split("{value}")
    return f"{s(before)} || {value} || {s(after)}"


TM = time_models(fv.TIME_MODELS)

# Rows of the result table before they are resolved by key.
PLAIN = PLACES + f""",
rows0 AS (SELECT *, {POSITION} AS position, {TM} AS tms FROM pl),
rows1 AS (SELECT *, unnest(tms) AS time_model, generate_subscripts(tms, 1) AS tm_pos FROM rows0)
"""

ARRIVALS = """
a AS (SELECT CASE WHEN o_orderkey % 10 = 0 THEN '' ELSE o_custkey || '/' || o_orderpriority END AS _id, o_orderkey AS ord FROM orders),
known AS (SELECT DISTINCT _id FROM a WHERE ord % 4 = 0 AND _id <> ''),
kept AS (
  SELECT _id, ord FROM a WHERE _id = ''
  UNION ALL SELECT _id, min(ord) FROM a WHERE _id <> '' AND _id NOT IN (SELECT _id FROM known) GROUP BY _id)
"""

LOADED = PLACES + "," + GAZ + "," + RESOLVED + "," + VEC + "," + RESP + f""",
ph_all AS (
  SELECT f._id, unnest(list_concat(f.direct_benefits, resp.phrases)) AS phrase,
    generate_subscripts(list_concat(f.direct_benefits, resp.phrases), 1) AS pos FROM f JOIN resp ON f._id = resp._id),
vecs AS (SELECT {PHRASE_NAME} AS phrase, best.* FROM best),
dec AS (SELECT ph_all.*, best_category, coalesce(assigned, 0) AS assigned FROM ph_all LEFT JOIN vecs USING (phrase)),
flags AS (
  SELECT _id, {', '.join(f"max(CASE WHEN assigned = 1 AND best_category = {s(c)} THEN 1 ELSE 0 END) AS fl_{n}" for n, c in enumerate(fv.FLAG_COLUMNS))},
    coalesce(string_agg(phrase, '; ' ORDER BY pos) FILTER (assigned = 0), '') AS others FROM dec GROUP BY _id),
full0 AS (
  SELECT pr.*, {POSITION} AS position, {EMPLOYMENT} AS employment, {REMOTE} AS remote, {DATE} AS datum,
    {portal_case('pr.url')} AS portal, {TM} AS tms FROM pr),
full1 AS (SELECT *, unnest(tms) AS time_model, generate_subscripts(tms, 1) AS tm_pos FROM full0),
full2 AS (
  SELECT *, row_number() OVER (PARTITION BY url, place, time_model, position
      ORDER BY k % 2 DESC, collection DESC, _id DESC, place_pos DESC, tm_pos DESC) AS rn FROM full1)
"""


def with_(ctes: str, select: str) -> str:
    return f"WITH {ctes.strip()} {select}"


def oracle_sql() -> dict[str, str]:
    flags = [c for c in fx.CATEGORIES if c != fv.DROPPED_CATEGORY]
    score_log_ranks = ", ".join(
        f"max(CASE WHEN rank = {n} THEN category END) AS top_{n}_category, round(max(CASE WHEN rank = {n} THEN combined END), 4) AS top_{n}_score"
        for n in range(1, 6)
    )
    zero_flags = ", ".join(
        f"CAST({'greatest(coalesce(fl_%d, 0), remote)' % n if c == 'Homeoffice' else 'coalesce(fl_%d, 0)' % n} AS BIGINT) AS flag_{n}"
        for n, c in enumerate(fv.FLAG_COLUMNS)
    )
    sql = {
        "postings_by_portal": with_(
            P,
            f"SELECT portal, size_bucket, time_model, count(*) AS n FROM (SELECT {portal_case('url')} AS portal, "
            f"{size_case('size_raw')} AS size_bucket, unnest({TM}) AS time_model FROM f) GROUP BY ALL",
        ),
        "collections_union": """
            SELECT collection, count(*) AS n, CAST(sum(length(text)) AS BIGINT) AS chars, CAST(sum(id) AS BIGINT) AS id_sum,
              count(lang) AS with_lang, count(url) AS with_url, count(role) AS with_role FROM (
              SELECT 'documents' AS collection, doc_id AS id, text, lang, NULL AS url, NULL AS role FROM documents
              UNION ALL SELECT 'pages', page_id, html, NULL, url, NULL FROM pages
              UNION ALL SELECT 'conversations', conv_id, text, NULL, NULL, role FROM conversations) GROUP BY collection""",
        "canonical_postings": with_(
            P,
            """SELECT _id, collection, url, title,
                CASE WHEN k % 62 = 0 THEN 'Job ID: ' || k WHEN k % 62 = 31 THEN 'Job #: ' || k END AS alt_title, company_name,
                CASE WHEN NOT is_a THEN '80331 ' || loc END AS job_location_text, date_posted,
                array_to_string(benefits, '|') AS benefits,
                array_to_string(list_filter([CASE WHEN is_a THEN 'company' END, CASE WHEN size IS NOT NULL THEN 'CompanyInfo' END,
                  CASE WHEN listed IS NOT NULL THEN 'content/benefits' END], lambda x: x IS NOT NULL), '|') AS list_names,
                para AS paragraphs_kind, CAST(CASE para WHEN 'none' THEN 0 ELSE 2 END AS BIGINT) AS n_paragraphs,
                array_to_string(CASE para WHEN 'dict' THEN [tx1, tx2, 'Homeoffice möglich'] ELSE para_texts END, '|') AS paragraph_items
              FROM f""",
        ),
        "completeness_report": with_(
            P,
            """SELECT field, CAST(sum(miss) AS BIGINT) AS missing, count(*) AS total_rows FROM (
                SELECT unnest(['url', 'paragraphs', 'lists', 'company_name', 'date_posted', 'benefits']) AS field,
                  unnest([CAST(url_raw = '' AS INT), CAST(para = 'none' AS INT), 0, CAST(is_a AS INT),
                    CAST(date_posted IS NULL AS INT), CAST(is_a AS INT)]) AS miss FROM p) GROUP BY field""",
        ),
        "gazetteer_flatten": with_(GAZ, "SELECT city, state, country FROM g"),
        "table_scan": """SELECT o_orderkey AS order_key, o_orderpriority AS order_priority, o_totalprice AS total_price,
            false AS before, true AS "after" FROM orders""",
        "portal_of_url": f"SELECT page_id, {portal_case('url')} AS portal FROM pages",
        "url_key_counts": "SELECT split_part(url, '?', 1) AS url_key, count(*) AS n FROM pages GROUP BY 1",
        "posting_date": with_(P, f"SELECT _id, {DATE} AS posting_date FROM p"),
        "size_bucket": with_(P, f"SELECT _id, size_raw, {size_case('size_raw')} AS size_bucket FROM f"),
        "size_bucket_of_documents": f"""SELECT {size_case('CAST(n_chars AS VARCHAR)')} AS size_bucket, count(*) AS n,
            CAST(sum(n_chars) AS BIGINT) AS chars FROM documents GROUP BY 1""",
        "benefits_text": with_(P, "SELECT _id, benefits_text FROM f"),
        "direct_benefits": with_(P, "SELECT _id, array_to_string(direct_benefits, '|') AS direct_benefits FROM f"),
        "search_text": with_(P, "SELECT _id, description, search_text FROM f"),
        "time_model": with_(P, f"SELECT _id, array_to_string({TM}, '|') AS time_models FROM f"),
        "time_model_separated": with_(
            P, f"SELECT _id, array_to_string({time_models(fv.TIME_MODELS_SEPARATED)}, '|') AS time_models FROM f"
        ),
        "position": with_(P, f"SELECT _id, {POSITION} AS position FROM f"),
        "employment": with_(P, f"SELECT _id, {EMPLOYMENT} AS employment FROM f"),
        "remote_flag": with_(
            P,
            f"SELECT _id, CAST({REMOTE} AS BIGINT) AS remote, "
            f"CAST(greatest({REMOTE}, CASE WHEN k % 3 = 0 THEN 1 ELSE 0 END) AS BIGINT) AS combined FROM f",
        ),
        "title_company_location": with_(P, "SELECT _id, job_title, company, location FROM f"),
        "prompt_text": with_(
            P,
            "SELECT _id, md5(a) AS experience_prompt, md5(b) AS benefits_prompt, md5(c) AS branch_prompt, md5(d) AS strict_prompt, "
            "length(a) AS experience_prompt_chars, length(b) AS benefits_prompt_chars, length(c) AS branch_prompt_chars, "
            f"""length(d) AS strict_prompt_chars FROM (
              SELECT _id, {prompt(fv.EXPERIENCE_PROMPT, 16, 'description')} AS a,
                {prompt(fv.BENEFITS_PROMPT, 16, 'benefits_text')} AS b, {prompt(fv.BRANCH_PROMPT, 16, 'job_title')} AS c,
                {prompt(fv.BRANCH_PROMPT, 8, 'job_title')} AS d FROM f)""",
        ),
        "location_split": with_(PLACES, "SELECT _id, place_pos, place FROM pl"),
        "gazetteer_index": with_(GAZ, "SELECT * FROM gi"),
        "geo_lookup": with_(PLACES + "," + GAZ + "," + RESOLVED, "SELECT _id, place_pos, place, state, country FROM pr"),
        "city_membership": with_(
            PLACES + "," + GAZ,
            """SELECT place FROM (SELECT DISTINCT replace(upper(place), 'O', 'Ö') AS place FROM pl)
               WHERE lower(strip_accents(place)) IN (SELECT lower(strip_accents(city)) FROM g)""",
        ),
        "distinct_places": with_(
            PLACES + "," + GAZ + "," + RESOLVED,
            """SELECT _id, string_agg(DISTINCT state, ', ' ORDER BY state) AS state_list,
               string_agg(DISTINCT country, ', ' ORDER BY country) AS country_list FROM pr GROUP BY _id""",
        ),
        "fan_out": with_(PLAIN, "SELECT _id, url, place, time_model, position FROM rows1"),
        "vector_cosine": with_(
            """e AS (SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS v FROM embeddings),
               d AS (SELECT label, unnest(v) AS x, generate_subscripts(v, 1) AS i FROM e),
               m AS (SELECT label, i, avg(x) AS x FROM d GROUP BY label, i),
               c AS (SELECT label, list(x ORDER BY i) AS v FROM m GROUP BY label)""",
            "SELECT vec_id, round(list_cosine_similarity(e.v, c.v), 4) AS cosine FROM e JOIN c ON e.label = c.label",
        ),
        "vector_scores": with_(
            VEC,
            """SELECT 'v' || vec_id AS phrase, category, round(direct, 4) AS direct, round(context, 4) AS context,
               round(combined, 4) AS combined FROM sc""",
        ),
        "category_max": with_(
            VEC, "SELECT vec_id // 8 AS posting, category, round(max(combined), 4) AS combined FROM sc GROUP BY 1, 2"
        ),
        "vector_best": with_(
            VEC,
            """SELECT 'v' || vec_id AS phrase, best_category, round(best_score, 4) AS best_score,
               CAST(assigned AS BIGINT) AS assigned FROM best""",
        ),
        "vector_best_blocks": with_(
            VEC,
            """SELECT 'v' || vec_id AS phrase, best_category, round(best_score, 4) AS best_score,
               CAST(assigned AS BIGINT) AS assigned FROM best""",
        ),
        "canonical_untidy": """
            SELECT 'p' || k AS _id, CASE WHEN k % 2 = 0 THEN 'a' ELSE 'b' END AS collection, section, items
            FROM (SELECT o_orderkey AS k FROM orders), LATERAL (VALUES
              ('company', 'ACME ' || k || '|Berlin'), ('note', 'frei ' || k % 7), ('number', (k % 5)::VARCHAR), ('yes', 'True'), ('nothing', ''),
              ('object', 'a|b'), ('mixed', 'x|' || k % 11 || '|True|None|y+z')) AS v(section, items)""",
        "load_rejects": """
            SELECT run::BIGINT AS run, collection, doc FROM (
              SELECT CASE WHEN o_orderkey % 2 = 0 THEN 'a' ELSE 'b' END AS collection,
                CASE WHEN o_orderkey % 5 = 0 THEN '{"_id":"p' || o_orderkey || '","url":' WHEN o_orderkey % 7 = 0 THEN ''
                     WHEN o_orderkey % 11 = 0 THEN '[' || o_orderkey || ']' END AS doc
              FROM orders) x, (VALUES (1), (2)) AS r(run)
            WHERE doc IS NOT NULL AND (run = 2 OR collection = 'a')""",
        "eval_missing_cells": """
            WITH l AS (SELECT doc_id, CASE WHEN doc_id % 4 = 0 THEN NULL WHEN doc_id % 7 <> 0 THEN quality END AS quality, toxic, quality AS kind FROM labels),
            r AS (SELECT doc_id, CASE WHEN doc_id % 5 = 0 THEN NULL ELSE 1 END AS quality, CASE WHEN doc_id % 3 <> 0 THEN 0 END AS toxic FROM documents),
            j AS (SELECT l.doc_id AS lk, r.doc_id AS rk, l.quality AS lq, r.quality AS rq, l.toxic AS lt, r.toxic AS rt, l.kind AS lc FROM l FULL JOIN r USING (doc_id)),
            cells AS (
              SELECT 'quality' AS column_name, lk, rk, lq AS a, rq AS b, lq IS NOT DISTINCT FROM rq AND lq IS NOT NULL AS same FROM j
              UNION ALL SELECT 'toxic', lk, rk, lt, rt, lt IS NOT DISTINCT FROM rt AND lt IS NOT NULL FROM j
              UNION ALL SELECT 'kind', lk, rk, lc, CASE WHEN rk IS NOT NULL THEN 1 END, false FROM j)
            SELECT column_name, count_if(same)::BIGINT AS tp, count_if(b IS NOT NULL AND NOT same)::BIGINT AS fp, count_if(a IS NOT NULL AND NOT same)::BIGINT AS fn,
              count_if(lk IS NOT NULL AND rk IS NOT NULL AND a IS NULL AND b IS NULL)::BIGINT AS tn
            FROM cells GROUP BY column_name""",
        "vector_top5": with_(
            VEC, "SELECT 'v' || vec_id AS phrase, rank, category, round(combined, 4) AS score FROM rk WHERE rank <= 5"
        ),
        "flag_pivot": with_(
            VEC,
            "SELECT vec_id // 8 AS posting, "
            + ", ".join(
                f"CAST(max(CASE WHEN assigned = 1 AND best_category = {s(c)} THEN 1 ELSE 0 END) AS BIGINT) AS flag_{n}"
                for n, c in enumerate(flags)
            )
            + " FROM best GROUP BY 1",
        ),
        "unmatched": with_(
            VEC,
            """SELECT vec_id // 8 AS posting, coalesce(string_agg('v' || vec_id, '; ' ORDER BY vec_id)
               FILTER (assigned = 0), '') AS others FROM best GROUP BY 1""",
        ),
        "score_log": with_(
            VEC
            + f""", wide AS (SELECT vec_id, {score_log_ranks} FROM rk GROUP BY vec_id)""",
            f"""SELECT run, 'v' || vec_id AS incentive, wide.* EXCLUDE (vec_id), best_category, round(best_score, 4) AS best_score,
               CAST({fx.THRESHOLD} AS DOUBLE) AS threshold, CAST(assigned AS BIGINT) AS assigned
               FROM wide JOIN best USING (vec_id), (VALUES (CAST(1 AS BIGINT)), (2)) x(run)""",
        ),
        "classified_postings": with_(
            P + "," + VEC + f", vecs AS (SELECT {PHRASE_NAME} AS phrase, best.* FROM best),"
            + """o AS (SELECT _id, unnest(direct_benefits) AS phrase,
                 CAST(generate_subscripts(direct_benefits, 1) - 1 AS BIGINT) AS pos FROM f)""",
            """SELECT _id, pos, phrase, best_category, round(best_score, 4) AS best_score, CAST(assigned AS BIGINT) AS assigned
               FROM o LEFT JOIN vecs USING (phrase)""",
        ),
        "response_experience": with_(RESP, "SELECT _id, CAST(experience AS BIGINT) AS experience FROM resp"),
        "response_phrases": with_(
            RESP, "SELECT _id, array_to_string(phrases, '|') AS phrases, CAST(len(phrases) AS BIGINT) AS n FROM resp"
        ),
        "response_category": with_(RESP, "SELECT _id, branch FROM resp"),
        "response_category_strict": with_(RESP, "SELECT _id, branch_strict AS branch FROM resp"),
        "eval_counts": with_(EVAL + COUNTS, "SELECT scope, column_name, tp, fp, fn, tn FROM scores"),
        "eval_scores": with_(
            EVAL + COUNTS, "SELECT scope, column_name, round(accuracy, 6) AS accuracy, round(recall, 6) AS recall FROM scores"
        ),
        "eval_dataset_counts": with_(
            LABELLED
            + """, vk AS (SELECT DISTINCT company, url_key FROM va WHERE company IS NOT NULL),
                 xk AS (SELECT DISTINCT company, url_key FROM xa WHERE company IS NOT NULL)""",
            """SELECT (SELECT count(*) FROM va) AS validation_rows, (SELECT count(*) FROM xa) AS export_rows,
                 (SELECT count(*) FROM vk) AS validation_keys, (SELECT count(*) FROM xk) AS export_keys,
                 (SELECT count(*) FROM (FROM vk INTERSECT FROM xk)) AS common_keys,
                 (SELECT count(*) FROM (FROM vk EXCEPT FROM xk)) AS validation_only,
                 (SELECT count(*) FROM (FROM xk EXCEPT FROM vk)) AS export_only""",
        ),
        "eval_label_scores": with_(
            """j AS (SELECT l.doc_id AS lk, d.doc_id AS rk, l.quality AS lq, l.toxic AS lt,
                 CASE WHEN n_chars > 500 THEN 1 ELSE 0 END AS rq, 0 AS rt
               FROM labels l FULL JOIN documents d ON l.doc_id = d.doc_id),
               cells AS (SELECT 'incentive' AS scope, 'quality' AS column_name, lk, rk, lq AS a, CASE WHEN rk IS NOT NULL THEN rq END AS b FROM j
                 UNION ALL SELECT 'incentive', 'toxic', lk, rk, lt, CASE WHEN rk IS NOT NULL THEN rt END FROM j),
               marks AS (SELECT scope, column_name, CASE WHEN a = b THEN 1 ELSE 0 END AS tp,
                 CASE WHEN b IS NOT NULL AND (a IS NULL OR a <> b) THEN 1 ELSE 0 END AS fp,
                 CASE WHEN a IS NOT NULL AND (b IS NULL OR a <> b) THEN 1 ELSE 0 END AS fn,
                 CASE WHEN a IS NULL AND b IS NULL AND lk IS NOT NULL AND rk IS NOT NULL THEN 1 ELSE 0 END AS tn FROM cells)"""
            + COUNTS,
            """SELECT scope, column_name, tp, fp, fn, tn, round(accuracy, 6) AS accuracy, round(recall, 6) AS recall FROM scores""",
        ),
        "key_intersect": with_(
            LABELLED,
            """SELECT company AS "Unternehmen", url_key FROM va WHERE company IS NOT NULL
               INTERSECT SELECT company, url_key FROM xa WHERE company IS NOT NULL""",
        ),
        "key_except": with_(
            LABELLED,
            """SELECT *, 'validation' AS side FROM (SELECT company AS "Unternehmen", url_key FROM va WHERE company IS NOT NULL
                 EXCEPT SELECT company, url_key FROM xa WHERE company IS NOT NULL)
               UNION ALL SELECT *, 'export' FROM (SELECT company, url_key FROM xa WHERE company IS NOT NULL
                 EXCEPT SELECT company, url_key FROM va WHERE company IS NOT NULL)""",
        ),
        "metric_history": with_(
            EVAL + COUNTS,
            """SELECT run_ts, round(max(accuracy) FILTER (scope = 'all'), 6) AS overall_accuracy,
                 round(max(recall) FILTER (scope = 'all'), 6) AS overall_recall,
                 round(max(accuracy) FILTER (scope = 'incentive' AND column_name = 'all'), 6) AS incentive_accuracy,
                 round(max(recall) FILTER (scope = 'non_incentive' AND column_name = 'all'), 6) AS non_incentive_recall,
                 round(max(accuracy) FILTER (column_name = 'Boni'), 6) AS boni_accuracy,
                 round(max(recall) FILTER (column_name = 'Stadt'), 6) AS stadt_recall,
                 true AS verpflegung_missing
               FROM scores, (VALUES ('2025-05-05 10:00:00'), ('2025-05-05 11:00:00')) x(run_ts) GROUP BY run_ts""",
        ),
        "incremental_skip": with_(ARRIVALS, "SELECT _id, ord FROM kept"),
        "skip_by_filter": with_(
            ARRIVALS,
            "SELECT DISTINCT _id FROM a WHERE _id <> '' AND _id NOT IN (SELECT _id FROM a WHERE ord % 4 = 0 OR ord % 8 = 1)",
        ),
        "run_counters": with_(
            ARRIVALS,
            """SELECT (SELECT count(*) FROM a) AS total_jobs, (SELECT count(*) FROM kept) AS new_jobs,
               (SELECT count(*) FROM a) - (SELECT count(*) FROM kept) AS skipped_jobs""",
        ),
        "upsert": with_(
            PLAIN
            + f""", runs AS (SELECT 1 AS run, * FROM rows1 WHERE k % 2 = 1 OR k % 3 = 1 UNION ALL SELECT 2, * FROM rows1 WHERE k % 3 <> 1),
              lastrow AS (SELECT *, row_number() OVER (PARTITION BY url, place, time_model, position
                ORDER BY run DESC, collection DESC, _id DESC, place_pos DESC, tm_pos DESC) AS rn FROM runs)""",
            f"""SELECT url AS "Job_URL", place AS "Stadt", time_model AS "Zeitmodell", position AS "Position", _id AS "MongoDB_ID",
               company AS "Unternehmen", {size_case('size_raw')} AS size_bucket FROM lastrow WHERE rn = 1""",
        ),
        "export_csv": with_(
            PLAIN
            + f""", lastrow AS (SELECT *, {portal_case('url')} AS portal, row_number() OVER (PARTITION BY url, place, time_model, position
                ORDER BY collection DESC, _id DESC, place_pos DESC, tm_pos DESC) AS rn FROM rows1)""",
            """SELECT portal AS "Portal_Name", time_model AS "Zeitmodell", position AS "Position", count(*) AS n,
               count(DISTINCT nullif(url, '')) AS urls, CAST(sum(length(job_title)) AS BIGINT) AS title_chars, false AS without_table,
               true AS with_table FROM lastrow WHERE rn = 1 GROUP BY ALL""",
        ),
        "stream_incremental": """SELECT event_id, id, value FROM (SELECT event_id, user_id || '/' || event_type AS id, value,
            row_number() OVER (PARTITION BY user_id, event_type ORDER BY event_id) AS rn FROM events) WHERE rn = 1""",
        "response_repaired": """
            WITH t AS (
              SELECT o_orderkey AS k, o_orderkey % 9 AS kind, CASE WHEN o_orderkey % 2 = 1 THEN 'Antwort: ' ELSE '' END AS before,
                '{"benefits": ["Urlaub ' || o_orderkey AS begin FROM orders),
            u AS (SELECT *, CASE kind WHEN 0 THEN '", "Rad"], "n": 1}' WHEN 1 THEN '", "Rad' WHEN 2 THEN '"' WHEN 3 THEN '", "x' WHEN 4 THEN ''
                WHEN 5 THEN '"]' WHEN 6 THEN '"]' WHEN 7 THEN '"]' ELSE '"], "n": 12' END AS kept,
              CASE WHEN kind = 0 THEN '' WHEN kind IN (1, 3, 4) THEN '"]}' WHEN kind = 2 THEN ']}' ELSE '}' END AS closed,
              CASE kind WHEN 0 THEN 18 WHEN 1 THEN 7 WHEN 2 THEN 3 WHEN 3 THEN 6 WHEN 4 THEN 4 WHEN 5 THEN 6 WHEN 6 THEN 8 WHEN 7 THEN 11 ELSE 11 END AS more FROM t)
            SELECT k AS order_key, begin || kept || closed AS json, closed, length(before || begin) + more AS stopped_at,
              'Urlaub ' || k || CASE kind WHEN 0 THEN '|Rad' WHEN 1 THEN '|Rad' WHEN 3 THEN '|x' ELSE '' END AS phrases FROM u""",
        "label_dictionary": """
            WITH t AS (SELECT doc_id, unnest(regexp_extract_all(lower(text), '[\\p{L}\\p{M}\\p{Nd}_]+')) AS word FROM documents),
            d AS (SELECT word, left(word, 1) || length(word) AS label FROM t WHERE regexp_full_match(word, '[a-z]{6,}')
              GROUP BY word ORDER BY count(*) DESC, word LIMIT 5000),
            f AS (SELECT doc_id, string_agg(label, '|' ORDER BY label) AS labels FROM (SELECT DISTINCT doc_id, label FROM t JOIN d USING (word)) GROUP BY doc_id)
            SELECT doc_id, coalesce(labels, '') AS labels FROM documents LEFT JOIN f USING (doc_id)""",
        "load_postings": with_(
            LOADED,
            f"""SELECT full2._id AS "MongoDB_ID", url AS "Job_URL", job_title AS "Job_Titel", portal AS "Portal_Name", datum AS "Datum",
               place AS "Stadt", state AS "Bundesland", country AS "Land", company AS "Unternehmen",
               {size_case('size_raw')} AS "Unternehmensgroesse", time_model AS "Zeitmodell", position AS "Position",
               employment AS "Beschaeftigungsart", CAST(resp.experience AS BIGINT) AS experience, resp.branch AS "Kategorie",
               {zero_flags}, coalesce(flags.others, '') AS others
               FROM full2 JOIN resp ON resp._id = full2._id LEFT JOIN flags ON flags._id = full2._id WHERE rn = 1""",
        ),
    }
    by_length = {
        "experience_response": prompt(fv.EXPERIENCE_PROMPT, 16, "description"), "benefits_response": prompt(fv.BENEFITS_PROMPT, 16, "benefits_text"),
        "branch_response": prompt(fv.BRANCH_PROMPT, 16, "job_title"),
    }
    hooked = RESP.replace("SELECT 'p' || o_orderkey AS _id", "SELECT _id").replace("FROM orders)", "FROM f)", 1)
    for name, text in by_length.items():
        hooked = hooked.replace(answer(name), f"{arr(fx.ANSWERS[name])}[1 + length({text}) % 8]")
    sql["load_with_hooks"] = sql["load_postings"].replace(RESP, hooked)
    sql["vector_pruned"] = sql["vector_top5"].replace(f"WHERE rn <= {fx.EXAMPLES_PER_LABEL}", "WHERE rn > 0")
    sql["key_overlap_sketch"] = with_(
        P,
        f"""SELECT portal, count(*) FILTER (one) AS n_1, count(*) FILTER (two) AS n_2, count(*) FILTER (one AND two) AS n_both, true AS within_bound
            FROM (SELECT {portal_case('url')} AS portal, split_part(url, '?', 1) AS key, bool_or(k % 3 <> 0) AS one, bool_or(k % 2 = 0) AS two
              FROM f WHERE k % 3 <> 0 OR k % 2 = 0 GROUP BY ALL) GROUP BY portal""",
    )
    values = ", ".join(
        f"({s(c)}, {n}, {s(kind)}, {s(text)})" for n, (c, examples, context) in enumerate(fv.PROTOTYPES)
        for kind, text in [*[("example", e) for e in examples], ("context", context)]
    )
    letters = lambda t: f"list_transform(range(26), lambda i: (length({t}) - length(replace(lower({t}), chr((97 + i)::INT), '')))::DOUBLE)"
    sql["prototype_best"] = with_(
        P,
        f"""SELECT phrase, category AS best_category, round(combined, 4) AS best_score, CASE WHEN combined > {fv.THRESHOLD} THEN 1 ELSE 0 END::BIGINT AS assigned,
              5::BIGINT AS ranked FROM (
            SELECT phrase, category, ord, 0.8 * max(cos) FILTER (kind = 'example') + 0.2 * max(cos) FILTER (kind = 'context') AS combined FROM (
              SELECT phrase, category, ord, kind, list_cosine_similarity({letters('phrase')}, {letters('text')}) AS cos
              FROM (SELECT DISTINCT unnest(benefits) AS phrase FROM f), (VALUES {values}) v(category, ord, kind, text) WHERE phrase <> '')
            GROUP BY ALL) QUALIFY row_number() OVER (PARTITION BY phrase ORDER BY combined DESC, ord) = 1""",
    )
    sql["collection_splits"] = """
        WITH d AS (SELECT o_orderkey AS k, '{"_id":"p' || o_orderkey || '","n":"' || o_orderpriority || '"}' AS doc FROM orders)
        SELECT doc, CAST(sum(strlen(doc) + 1) OVER (ORDER BY k) - strlen(doc) - 1 AS BIGINT) AS position, 3::BIGINT AS readings FROM d"""
    sql["load_repeated_ids"] = """
        WITH d AS (SELECT o_orderkey AS k, o_orderkey // 3 AS g, row_number() OVER (PARTITION BY o_orderkey // 3
            ORDER BY CASE WHEN o_orderkey % 4 < 2 THEN 0 ELSE 1 END, o_orderkey) AS rn FROM orders)
        SELECT 'g' || g AS "MongoDB_ID", 'https://www.p.de/' || g || '/' || (9 - k % 3) AS "Job_URL", 't' || k AS "Job_Titel",
          'c' || (k % 7) AS "Unternehmen" FROM d WHERE rn = 1"""
    return sql | {"stream_load": sql["load_postings"], "compacted_table": sql["upsert"], "stream_state_dedup": sql["stream_incremental"]}
