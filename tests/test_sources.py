"""Raw documents, collections, gazetteer, tables."""

import json

from pyspark.sql import functions as F

from postmill.operators import geo
from postmill.sources import gazetteer
from postmill.sources.collections import canonical, completeness, read_collections, with_ids, with_order
from postmill.sources.tables import read_csv, table_exists, underscore_names

DOCS = [
    {"_id": {"$oid": "ff01"}, "url": "", "URL": "u2", "Job Title": "", "jobId": 7, "lists": {"z": ["s"], "a": [["x", "y"]]}},
    {"_id": "b", "url": "u1", "URL": "u2", "Job Title": "T", "Job #": 9, "paragraphs": {"k2": ["p"], "k1": "q"}},
    {"Job #": 9, "paragraphs": ["p", ["q"]], "jobLocationText": ""},
]


def write(tmp_path, name, docs):
    folder = tmp_path / name
    folder.mkdir()
    (folder / "part.json").write_text("\n".join(json.dumps(d, ensure_ascii=False) for d in docs), encoding="utf-8")
    return str(folder)


def test_collections_to_canonical(spark, tmp_path):
    raw = read_collections(spark, {"one": write(tmp_path, "one", DOCS[:2]), "two": write(tmp_path, "two", DOCS[2:])})
    rows = {r._id: r for r in canonical(raw).withColumn("names", F.map_keys("lists")).collect()}
    assert {r.collection for r in rows.values()} == {"one", "two"}
    a, b, c = rows["ff01"], rows["b"], rows[""]
    assert (a.url, b.url, c.url) == ("u2", "u1", "")
    assert (a.alt_title, b.alt_title, c.alt_title) == ("Job ID: 7", None, "Job #: 9")
    assert a.names == ["z", "a"] and a.lists["a"][0]["items"] == ["x", "y"] and a.lists["a"][0].is_list
    assert [s.section for s in b.paragraphs] == ["k2", "k1"] and [s.is_list for s in b.paragraphs] == [True, False]
    assert (b.paragraphs_kind, c.paragraphs_kind, a.paragraphs_kind) == ("dict", "list", "none")
    assert [s["items"] for s in c.paragraphs] == [["p"], ["q"]] and c.job_location_text == "" and a.job_location_text is None


def test_order_is_unique_for_documents_without_id(spark):
    raw = spark.createDataFrame([('{"url": "u"}', "c")] * 50 + [('{"_id": "x"}', "c")], "doc string, collection string")
    rows = with_order(with_ids(raw)).collect()
    assert len({r.ord for r in rows}) == 51 and "x" in {r.ord for r in rows}


def test_completeness(spark):
    df = spark.createDataFrame([(1, None), (None, None), (3, "x")], "a int, b string")
    assert {(r.field, r.missing, r.total_rows) for r in completeness(df).collect()} == {("a", 1, 3), ("b", 2, 3)}


def test_nested_gazetteer_keeps_file_order(spark, tmp_path):
    nested = [
        {"name": "X", "states": [{"name": "s", "cities": [{"name": "Ulm"}, {"name": "Aa"}]}]},
        {"name": "Germany", "states": [{"name": "Bavaria", "cities": [{"name": "ULM"}]}, {"name": "t", "cities": []}]},
    ]
    path = tmp_path / "world.json"
    path.write_text(json.dumps(nested), encoding="utf-8")
    flat = gazetteer.flatten(gazetteer.read_nested(spark, str(path)))
    assert [r.city for r in flat.orderBy("ord").collect()] == ["Ulm", "Aa", "ULM"]
    none = spark.createDataFrame([], "src string, dst string, lang_pair string")
    index = {r.city_key: (r.state, r.country) for r in geo.gazetteer_index(flat, none).collect()}
    assert index == {"ulm": ("Bayern", "Deutschland"), "aa": ("s", "X")}


def test_tables(spark, tmp_path):
    path = str(tmp_path / "t")
    assert not table_exists(spark, path)
    spark.createDataFrame([(1, "a b")], ["x y", "z"]).write.option("header", True).csv(path)
    assert table_exists(spark, path)
    assert underscore_names(read_csv(spark, path)).first().asDict() == {"x_y": 1, "z": "a b"}


def test_one_odd_value_keeps_the_other_lists(spark):
    doc = '{"_id":"1","lists":{"company":["ACME","Berlin"],"note":"freitext","n":1,"o":{"b":1,"a":2},"z":null,"m":[true,null,["x"],{"k":1}]}}'
    lists = canonical(spark.createDataFrame([(doc, "c")], "doc string, collection string")).first().lists
    plain = {k: [i["items"] for i in v] for k, v in lists.items()}
    assert plain == {
        "company": [["ACME"], ["Berlin"]], "note": [["freitext"]], "n": [["1"]], "o": [["a"], ["b"]], "z": [], "m": [["True"], ["None"], ["x"], ['{"k":1}']],
    }
