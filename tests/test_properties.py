"""Column expressions against plain Python on random texts."""

import unicodedata

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from postmill.functions import text as tx
from postmill.functions import vectors
from postmill.operators import fields, geo, responses

QUICK = settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
PLACE = st.text(alphabet="aB1 ,;/•() üß\tn", max_size=30)


def column(spark, values, kind, function):
    df = spark.createDataFrame([(n, v) for n, v in enumerate(values)], f"n int, t {kind}")
    return [r.o for r in df.select("n", function(F.col("t")).alias("o")).orderBy("n").collect()]


@QUICK
@given(st.lists(st.lists(st.text(alphabet="ab'\"\\\n\t ä", max_size=8), max_size=4), min_size=20, max_size=60))
def test_list_notation(spark, values):
    assert column(spark, values, "array<string>", tx.python_list_text) == [str(v) for v in values]


@QUICK
@given(st.lists(st.text(alphabet="aÄöüßéñç´Á ﬁœØ", max_size=10), min_size=20, max_size=60))
def test_fold(spark, values):
    expected = [unicodedata.normalize("NFKD", v).encode("ascii", "ignore").decode().lower() for v in values]
    assert column(spark, values, "string", tx.fold) == expected


@pytest.mark.parametrize(
    ("given_text", "expected"),
    [
        ("Köln; Bonn", "Köln, Bonn"), ("Köln/Bonn", "Köln, Bonn"), ("Köln • Bonn", "Köln, Bonn"), ("Köln und Bonn oder Ulm", "Köln, Bonn, Ulm"),
        ("Köln bei Bonn", "Köln"), ("BEI Ulm", ""), ("beim Dom", "beim Dom"), ("Köln (Süd)", "Köln"), ("Köln ,Bonn", "Köln, Bonn"),
    ],
)
def test_place_cases(spark, given_text, expected):
    assert column(spark, [given_text], "string", geo.normalise_places) == [expected]


@QUICK
@given(st.lists(st.lists(st.sampled_from(["Köln", " bei ", " und ", " oder ", ",", ";", "/", "•", "(", ")", " ", "1", "beim"]),
                         max_size=8).map("".join), min_size=20, max_size=60))
def test_places(spark, values):
    """No separator but the comma is left, and cleaning twice changes nothing."""
    once = column(spark, values, "string", geo.normalise_places)
    assert not any(mark in place for place in once for mark in ";/•")
    assert all(place == place.strip() for place in once)
    tame = [place for place in once if "(" not in place and ")" not in place and "und" not in place and "oder" not in place]
    assert column(spark, tame or [""], "string", geo.normalise_places) == (tame or [""])


@QUICK
@given(st.lists(PLACE, min_size=20, max_size=60))
def test_split(spark, values):
    """Nothing but commas and the white space after them is lost, and brackets which close stay whole."""
    for text, parts in zip(values, column(spark, values, "string", geo.split_places), strict=True):
        rest = text
        for part in parts:
            assert part in rest
            rest = rest[rest.index(part) + len(part) :]
        assert "".join(parts).replace(",", "").split() == [] or len(parts) <= text.count(",") + 1


SIZE_CASES = [
    ("", "Keine Angaben"), ("0", "Keine Angaben"), ("1", "0-10"), ("10", "0-10"), ("11", "11-50"), ("50", "11-50"), ("51-250", "51-250"), ("251", "251-500"),
    ("501", "501-1000"), ("1,000 Mitarbeiter", "501-1000"), ("1001", "1001-2500"), ("2,501-10,000", "2501-10000"), ("10001", "10000+"), ("viele", "Keine Angaben"),
]


def sizes(spark, values):
    df = spark.createDataFrame([(n, v) for n, v in enumerate(values)], "n int, size_raw string")
    return [r.size_bucket for r in fields.size_bucket(df).orderBy("n").collect()]


def test_size_cases(spark):
    assert sizes(spark, [text for text, _ in SIZE_CASES]) == [label for _, label in SIZE_CASES]


@QUICK
@given(st.lists(st.integers(1, 99_999), min_size=20, max_size=60))
def test_sizes_rise(spark, values):
    """A larger number never gives a lower bucket, and a smaller number beside it changes nothing."""
    order = list(dict.fromkeys(label for _, label in SIZE_CASES))
    ranks = [order.index(label) for label in sizes(spark, [str(v) for v in sorted(values)])]
    assert ranks == sorted(ranks)
    assert sizes(spark, [f"{v} bis {v // 2}" for v in values]) == sizes(spark, [str(v) for v in values])


def test_bullet_cases(spark):
    texts = ["- a\n* b\n• c", "1. d\n 2. e", "x\n-- f", "-\n* ", "no bullets", " - g "]
    assert column(spark, texts, "string", responses.bullet_items) == [["a", "b", "c"], ["1. d"], ["f"], [], [], ["g"]]


@QUICK
@given(st.lists(st.text(alphabet="-*•1. ab\n ", max_size=20), min_size=20, max_size=60))
def test_bullets(spark, values):
    """Every item is the end of a line of its own, in order, and has no bullet in front."""
    for text, found in zip(values, column(spark, values, "string", responses.bullet_items), strict=True):
        lines = iter(line.strip() for line in text.split("\n"))
        assert all(any(line.endswith(item) for line in lines) for item in found)
        assert all(item and item == item.strip() and item[0] not in "-*•" for item in found)


@pytest.mark.parametrize(
    ("url", "portal"),
    [
        ("https://www.stepstone.de/jobs/1", "stepstone"), ("https://de.indeed.com/viewjob", "indeed"), ("https://indeed.com", "indeed"),
        ("http://a.b.portal.com/x", "portal"), ("https://jobs.example.org/1", "Unknown"), ("", "Unknown"), ("https://www.a-b.com", "a-b"),
    ],
)
def test_portal_cases(spark, url, portal):
    df = spark.createDataFrame([(url,)], "url string")
    assert fields.portal(df).first().portal == portal


def test_vectors(spark):
    df = spark.createDataFrame([([3.0, 4.0], [4.0, 3.0]), ([0.0, 0.0], [1.0, 0.0])], "a array<float>, b array<float>")
    rows = df.select(vectors.cosine(F.col("a"), F.col("b")).alias("c"), vectors.unit(F.col("a")).alias("u"), vectors.dot(F.col("a"), F.col("b")).alias("d"))
    assert [(round(r.c, 6), r.u, r.d) for r in rows.collect()] == [(0.96, [0.6, 0.8], 24.0), (0.0, [0.0, 0.0], 0.0)]
