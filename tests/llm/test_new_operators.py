"""Collocations, spelling variants and resharding: brute force, untidy rows, plans."""

import collections
import itertools
import re
import zlib

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from postmill.llm import phrase_graph, resharding, spelling

LOW = str.maketrans({chr(i): chr(i + 32) for i in range(65, 91)})
SCHEMA = "doc_id long, text string, lang string, source string, word string, n long, phrase string, weight int, row string, size int, shard int, old int, tie string"


def frame(spark, rows):
    """Documents (doc_id, text, lang) with further columns named like those the operators make."""
    return spark.createDataFrame([(*r, "s", "w", 1, "p", 2, "r", 3, 4, 5, "t") for r in rows], SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def rows():
    rng = np.random.default_rng(5)
    words = ["the", "of", "The", "ünd", "a", "b c", "x\x1fy", *[f"w{i}" for i in range(12)]]
    texts = []
    for n in range(60):
        picked = rng.choice(words, rng.integers(1, 200), p=[0.3, 0.2, 0.1] + [0.4 / 16] * 16)
        gaps = rng.choice([" ", "  ", "\t", ", ", ".", "\n", "; a "], len(picked), p=[0.8, 0.03, 0.03, 0.05, 0.04, 0.03, 0.02])
        texts.append((n, "".join(w + g for w, g in zip(picked, gaps, strict=True)), ["en", "de", None][n % 3]))
    passage = " ".join(f"q{i}" for i in range(30))
    texts += [(100 + i, f"x{i} {passage} y{i}" if i % 2 else passage, "en") for i in range(25)]
    texts += [(200, "the " * 5000, "fr"), (201, "one two " * 2600 + "end", "fr"), (None, texts[3][1], "en"), texts[4], texts[4]]
    return [*texts, (202, None, "en"), (203, "", None), (204, " \t.,\n ", "en"), (205, "single", "xx")]


def brute_collocations(rows, least, top):
    counts, totals = collections.Counter(), collections.Counter()
    for _, text, lang in rows:
        lang = lang or "und"
        for piece in re.split("[.,;:!?\n-\r]", (text or "").translate(LOW)):
            w = re.findall("[^ \t]+", piece)
            totals[lang] += len(w)
            for k in range(1, 6):
                counts.update((lang, *w[i : i + k]) for i in range(len(w) - k + 1))
    heavy = {p: f for p, f in counts.items() if f >= least}
    found = []
    for (lang, *w), a in heavy.items():
        if len(w) < 2:
            continue
        inside = any(
            q[0] == lang and len(q) - 1 > len(w) and f >= a and any(list(q[1 + i : 1 + i + len(w)]) == w for i in range(len(q) - len(w)))
            for q, f in heavy.items()
        )
        if not inside:
            n = totals[lang]
            cut = min((1000 * a * n // (heavy[lang, *w[:k]] * heavy[lang, *w[k:]]), k) for k in range(1, len(w)))
            found.append((lang, " ".join(w), a, heavy[lang, *w[: cut[1]]], heavy[lang, *w[cut[1] :]], n, cut[0]))
    out = []
    for _, group in itertools.groupby(sorted(found, key=lambda r: (r[0], -r[6], -r[2], r[1].encode())), key=lambda r: r[0]):
        out += [(r[0], i, *r[1:]) for i, r in enumerate(itertools.islice(group, top), 1)]
    return out


@pytest.mark.parametrize("least,top", [(12, 2000), (60, 7), (100, 2000)])
def test_collocations_by_brute_force(spark, rows, least, top):
    found = phrase_graph.collocations(frame(spark, rows), least=least, top=top)
    assert found.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    assert sorted(map(tuple, found.collect())) == sorted(brute_collocations(rows, least, top))


def test_collocations_of_nothing(spark, rows):
    assert phrase_graph.collocations(frame(spark, rows).where("doc_id < 0")).count() == 0
    assert phrase_graph.collocations(frame(spark, [(1, None, None), (2, "", "en")])).count() == 0


def test_passages_become_unary_paths(spark, rows):
    found = phrase_graph.windows(frame(spark, rows), least=20)
    paths = phrase_graph.unary_paths(found, least=20).collect()
    passage = [p for p in paths if p.phrase.startswith("q0 ")]
    # the last node ends pieces of half of the documents, which does not matter for edges; the passage is one row
    assert [(p.phrase, p.weight, p.edges) for p in passage] == [(" ".join(f"q{i}" for i in range(30)), 25, 26)]
    edges = {(r.lang, r.phrase): r.weight for r in found.where("size = 5 AND weight >= 20").collect()}
    opened = collections.Counter()
    for p in paths:
        w = p.phrase.split(" ")
        assert len(w) == p.edges + 4
        opened.update({(p.lang, " ".join(w[i : i + 5])): p.weight for i in range(p.edges)})
    assert opened == edges


def test_scores_beyond_64_bits(spark):
    counts = spark.createDataFrame([("en", "a", 1, 10**13), ("en", "b", 1, 10**12), ("en", "a b", 2, 999_999_999_989)], "lang string, phrase string, size int, f long")
    totals = spark.createDataFrame([("en", 17 * 10**12 + 1)], "lang string, n long")
    row = phrase_graph.scored(counts, totals).collect()[0]
    assert row.score == 1000 * 999_999_999_989 * (17 * 10**12 + 1) // (10**13 * 10**12)


def brute_variants(rows, divisor):
    counts = collections.Counter()
    for doc_id, text, _ in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(LOW)
            h = zlib.crc32(f"{doc_id}:{run}".encode())
            if doc_id is not None and h % divisor == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            counts[run] += 1
    n = {w: c for w, c in counts.items() if len(w) >= 6 and c >= 5}

    def is_near(a, b):
        if abs(len(a) - len(b)) > 1 or a == b:
            return False
        if len(a) == len(b):
            return sum(x != y for x, y in zip(a, b, strict=True)) == 1
        long, short = (a, b) if len(a) > len(b) else (b, a)
        return any(long[:i] + long[i + 1 :] == short for i in range(len(long)))

    near = {w: [x for x in n if is_near(w, x)] for w in n}
    form = {}
    for w in n:
        best = min(near[w], key=lambda x: (-n[x], x), default=None)
        if best and n[best] >= 5 * n[w]:
            form[w] = best

    def root(w):
        while w in form:
            w = form[w]
        return w

    return [(w, form.get(w), root(w), n[w], len(near[w]), n[form[w]] if w in form else None) for w in n]


def test_variants_by_brute_force(spark):
    rng = np.random.default_rng(6)
    letters = list("abÀÿé")
    words = ["".join(rng.choice(letters, rng.integers(5, 8))) for _ in range(120)] + ["aaaaaa", "aaaaaaa", "aabaaa", "Aaaaaa", "ÀÀÀÀÀÀÀ"]
    rows = [(n, " ".join(rng.choice(words, 60, p=np.arange(1, 126) ** 3 / np.sum(np.arange(1, 126) ** 3))) + "-x1", None) for n in range(120)]
    rows += [rows[0], rows[0], (None, rows[1][1], "en"), (500, None, None), (501, "", None), (502, "naïve×÷ " * 20_000, None)]
    rows += [(600, "Zzzzzz " * 300, None), (601, "zzzzzy " * 40, None), (602, "zzzzxy " * 6, None)]
    for divisor in (spelling.DIVISOR, 3):
        found = spelling.variants(spelling.word_counts(frame(spark, rows), divisor=divisor))
        assert found.columns == ["word", "form", "root", "n", "n_near", "form_n"]
        want = brute_variants(rows, divisor)
        assert sorted(map(tuple, found.collect())) == sorted(want)
        assert divisor == 3 or [w[1:3] for w in want if w[0] == "zzzzxy"] == [("zzzzzy", "zzzzzz")]
    assert spelling.variants(spelling.word_counts(frame(spark, rows).where("doc_id < 0"))).count() == 0


def test_rotations_meet_once(spark):
    words = spark.createDataFrame([("aaaaaab", 9), ("aaaaab", 8), ("aaaaaa", 7), ("abaaaa", 5)], "word string, n long")
    pairs = [(r.word, r.near) for r in spelling.neighbours(words).collect()]
    assert len(pairs) == len(set(pairs)) and set(pairs) == {
        ("aaaaaab", "aaaaab"), ("aaaaab", "aaaaaab"), ("aaaaaab", "aaaaaa"), ("aaaaaa", "aaaaaab"), ("aaaaab", "aaaaaa"), ("aaaaaa", "aaaaab"),
        ("aaaaaa", "abaaaa"), ("abaaaa", "aaaaaa"),
    }


def test_flow_is_cheapest():
    rng = np.random.default_rng(7)
    for _ in range(60):
        n, m = rng.integers(1, 4, 2)
        supply = rng.integers(0, 5, n)
        demand = rng.multinomial(supply.sum(), np.ones(m) / m)
        cost = rng.integers(0, 6, (n, m))
        flow = resharding.least_cost_flow(supply, demand, cost)
        assert (flow >= 0).all() and list(flow.sum(1)) == list(supply) and list(flow.sum(0)) == list(demand)
        # every unit is dealt to a place of a target in all ways
        units = [i for i in range(n) for _ in range(supply[i])]
        places = [j for j in range(m) for _ in range(demand[j])]
        if len(units) <= 7:
            best = min(sum(cost[i, j] for i, j in zip(units, p, strict=True)) for p in set(itertools.permutations(places)))
            assert int((flow * cost).sum()) == best
    with pytest.raises(ValueError):
        resharding.least_cost_flow([1], [2], np.zeros((1, 1)))


def test_moves_as_few_bytes_as_the_capacities_allow():
    rng = np.random.default_rng(8)
    blocks = pd.DataFrame([(i, b, int(rng.integers(500, 1500)), 3) for i in range(6) for b in range(256)], columns=["old", "block", "bytes", "rows"])
    moves = resharding.transfers(blocks, 6, (1,) * 8).merge(blocks, on=["old", "block"])
    total = blocks["bytes"].sum()
    of_shard = moves.groupby("shard")["bytes"].sum()
    assert of_shard.max() - of_shard.min() <= 1500 * 3
    least = sum(max(0, s - total / 8) for s in blocks.groupby("old")["bytes"].sum())
    assert moves.loc[moves["old"] != moves["shard"], "bytes"].sum() <= least + 6 * 1500


def check_law(found, rows):
    by_id = collections.Counter((d, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for d, t, _ in rows)
    assert collections.Counter((r.doc_id, r["size"], r.text_crc32) for r in found) == by_id
    assert all(r.law == "bytes" and r.grown_shard is None for r in found)
    sizes, slots = collections.Counter(), collections.defaultdict(list)
    for r in found:
        sizes[r.shard] += r["size"]
        slots[r.shard].append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    return sizes


def test_resharding_with_a_hot_group(spark):
    rows = [(i, f"text {i} " * (i % 17 + 1), None) for i in range(3000)] + [(5000 + i, "the same text in many rows " * 4, "en") for i in range(1500)]
    rows += [rows[0], rows[0], (None, "no id", None), (None, None, None), (9000, None, None), (9001, "", None)]
    sizes = check_law(resharding.resharded(frame(spark, rows)).collect(), rows)
    assert set(sizes) == set(range(8)) and max(sizes.values()) <= 1.02 * min(sizes.values())


def test_resharding_keeps_groups_and_other_files(spark, tmp_path):
    rows = [(i, f"text {i // 3}", None) for i in range(6000)]
    docs = frame(spark, rows)
    old = F.pmod(F.xxhash64("text"), F.lit(6))
    narrow = resharding.keyed(docs, old, F.struct("doc_id", "text").alias("row"))
    placed = resharding.with_blocks(narrow, *resharding.block_sizes(narrow))
    moves = resharding.plan(placed, 6, (1,) * 8)
    slotted = resharding.with_slots(placed, moves)
    assert slotted.groupBy("row.text").agg(F.count_distinct("shard").alias("n")).where("n > 1").count() == 0
    written = resharding.rewrite(slotted.where("affected"), str(tmp_path / "new"))
    assert 0 < written.count() < 6000 and written.where("shard = old").count() < written.where("shard <> old").count()
    files = written.select("*", F.input_file_name().alias("f")).groupBy("shard", "old", "file").agg(F.count_distinct("f").alias("n"))
    assert files.where("n > 1").count() == 0


def test_resharding_edges(spark):
    assert resharding.resharded(frame(spark, [(1, "a", None)]).where("doc_id < 0")).count() == 0
    rows = [(1, "long " * 60_000, None), (2, "b", None), (3, "c", None)]
    check_law(resharding.resharded(frame(spark, rows)).collect(), rows)
    found = resharding.resharded(frame(spark, [(i, f"{i:03}", None) for i in range(400)]), F.lit(0), 1, (1, 3)).groupBy("shard").count().collect()
    assert {r.shard: r["count"] for r in found} == {0: 100, 1: 300}
