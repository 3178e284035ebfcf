from pyspark.sql import functions as F

from postmill.operators import geo


def apply(spark, function, *values):
    df = spark.createDataFrame([(n, v) for n, v in enumerate(values)], "n int, t string")
    return [r.o for r in df.select("n", function(F.col("t")).alias("o")).orderBy("n").collect()]


def test_normalise(spark):
    assert apply(
        spark, geo.normalise_places, "Berlin (Mitte); Bonn / Ulm • Kiel und Jena", "Köln bei X, Bonn", "A , B",
        "Köln BEI X\nBonn", "Übeiß",
    ) == ["Berlin, Bonn, Ulm, Kiel, Jena", "Köln", "A, B", "Köln \nBonn", "Übeiß"]


def test_split(spark):
    assert apply(spark, geo.split_places, "Berlin, Frankfurt (Main, X), München", "", "A,", "Berlin, Frankfurt (Main), München") == [
        ["Berlin", "Frankfurt (Main, X)", "München"], [""], ["A", ""], ["Berlin", "Frankfurt (Main)", "München"],
    ]


def test_place_names(spark):
    df = spark.createDataFrame([("12345 Berlin",), ("Berlin",), ("10115  Bad   Ems, 2 Ulm",), ("",)], "location string")
    assert [r.places for r in geo.place_names(df).collect()] == [["Berlin"], ["Berlin"], ["Bad Ems", "Ulm"], [""]]


GAZETTEER = [
    ("Ulm", "Texas", "USA", 1), ("ulm", "Bavaria", "Germany", 2), ("Ulm", "Hesse", "Germany", 3),
    ("Paris", "Ile", "France", 4), ("Hanover", "Lower Saxony", "Germany", 5), ("Nix", "Unknown", "France", 6),
]
TRANSLATIONS = [("Hannover", "Hanover", "de>en"), ("France", "Frankreich", "en>de"), ("Ile", "Insel", "en>de"),
                ("Niedersachsen", "Untersachsen", "en>de"), ("France", "Frankreich", "en>de")]


def resolve(spark, names, rows_per_task=10):
    gazetteer = spark.createDataFrame(GAZETTEER, "city string, state string, country string, ord long")
    translations = spark.createDataFrame(TRANSLATIONS, "src string, dst string, lang_pair string")
    rows = spark.createDataFrame([(n, v) for n, v in enumerate(names)], "n int, place string")
    index = geo.gazetteer_index(gazetteer, translations)
    found = geo.resolve_places(rows, index, translations, ["n"], rows_per_task=rows_per_task)
    return [(r.state, r.country) for r in found.orderBy("n").collect()]


def test_resolution(spark):
    assert resolve(spark, ["ULM", "Paris", "Hannover", "Bundesweit", "", "Nix", "Atlantis", None]) == [
        ("Bayern", "Deutschland"), ("Insel", "Frankreich"), ("Untersachsen", "Deutschland"), ("bundesweit", "Germany"),
        ("Unbekannt", "Unbekannt"), ("Unbekannt", "Unbekannt"), ("Unbekannt", "Unbekannt"), (None, None),
    ]


def test_hot_place_is_split_and_complete(spark):
    names = ["Ulm"] * 500 + ["Paris"] * 30 + ["Nowhere"] * 3 + [None] * 40
    found = resolve(spark, names)
    assert found == [("Bayern", "Deutschland")] * 500 + [("Insel", "Frankreich")] * 30 + [("Unbekannt",) * 2] * 3 + [(None, None)] * 40


def test_membership(spark):
    gazetteer = spark.createDataFrame([("Köln",), ("Gießen",)], "city string")
    names = spark.createDataFrame([("KOLN",), ("Giessen",), ("Gieen",)], "place string")
    assert sorted(r.place for r in geo.known_cities(names, gazetteer).collect()) == ["Gieen", "KOLN"]
