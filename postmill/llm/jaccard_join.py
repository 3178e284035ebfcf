"""Sets of word n-grams joined by exact Jaccard similarity, with the relations between sets used to skip work.

Documents with equal sets form a class, and one set stands for the class. Only n-grams which stand in two or more sets can
be shared; Spark counts n-grams in buckets, each block of documents sends an n-gram once. A set keeps its shared n-grams, rare
ones first. Two similar sets share one of their first ``n - ceil(t n) + 1`` n-grams, so these are indexed, with their
positions. Overlaps are counted on shared n-grams alone, which loses nothing.

Index lists are skipped in blocks: entries meet by n-gram and size band, and only where positions leave room for enough overlap.
Answers are derived in two rounds. First each list's member with the least share of n-grams of its own, as the original of a group
of copies has, becomes its pivot and is compared with all others of the list. Sets linked to one pivot are in one component and
are not compared again. Then only sets of different components meet, and their overlap is first bounded from what each shares with
the pivot: ``min(o1, o2) + min(n1 - o1, n2 - o2)``. A group of m copies so costs m comparisons.

Null and empty texts have no set, no links and their own id as component. Rows with equal doc_id are compared like other
rows. Rows without doc_id take part; a component of such rows alone has a null id. N-grams are told apart by hash: 41 bits or more (bucket and key)
within a pair of sets, 128 bits for equal sets.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from postmill.llm.common import (
    LOWER, bucket_count, bucket_of, block_ids, mix, pack_keys, segments, text_blocks, unpack_keys, whole_row, window_hashes, word_hashes, words,
)
from postmill.operators.joins import first_per_key, join_small
from postmill.session import write_stage

WIDTH = 4
PERCENT = 85
NO_ID = (1 << 63) - 1
MANY = 0xFFFF
MESSAGE = "block long, bucket long, first int, keys binary, more binary"
_MESSAGE = pa.schema([("block", pa.int64()), ("bucket", pa.int64()), ("first", pa.int32()), ("keys", pa.binary()), ("more", pa.binary())])
ROWS = "id long, row_key long, n long, cls binary, own int, prefix array<long>, tokens array<long>"


def block_sets(data: np.ndarray, offsets: np.ndarray, width: int):
    """Distinct n-grams of a block, and (row, number of n-gram) of every member of every set, sorted."""
    starts, ends, row = words(data, offsets)
    hashes = word_hashes(LOWER[data], starts, ends)
    n = len(hashes)
    grams = window_hashes(hashes, width)
    whole = np.flatnonzero(row[: len(grams)] == row[width - 1 :]) if n >= width else np.zeros(0, np.int64)
    number = np.bincount(row, minlength=len(offsets) - 1)
    first = np.cumsum(number) - number
    short = np.flatnonzero((number > 0) & (number < width))
    total = number[short].astype(np.uint64) * np.uint64(0xC2B2AE3D27D4EB4F)
    for k in range(width - 1):
        more = number[short] > k
        total[more] = total[more] * np.uint64(0x9E3779B97F4A7C15) + hashes[first[short][more] + k]
    keys = np.concatenate([grams[whole], mix(total)])
    rows = np.concatenate([row[whole], short])
    distinct, number_of = np.unique(keys, return_inverse=True)
    members = np.unique(rows.astype(np.uint64) << np.uint64(32) | number_of.astype(np.uint64))
    return distinct, (members >> np.uint64(32)).astype(np.int64), (members & np.uint64(0xFFFFFFFF)).astype(np.int64)


def _messages(width: int, buckets: int) -> Callable:
    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids = block_ids()
        for batch, data, offsets in text_blocks(batches):
            block = next(ids)
            distinct, row, gram = block_sets(data, offsets, width)
            size = np.bincount(row, minlength=batch.num_rows).astype(np.int64)
            first = np.cumsum(size) - size
            one, two = np.zeros((2, batch.num_rows), np.uint64)
            if len(row):
                there = size > 0
                one[there] = np.add.reduceat(mix(distinct ^ np.uint64(0x5851F42D4C957F2D))[gram], first[there])
                two[there] = np.add.reduceat(mix(distinct * np.uint64(0x2545F4914F6CDD1D))[gram], first[there])
            # of equal sets in a block one is sent
            order = np.lexsort((two, one))
            again = np.zeros(batch.num_rows, bool)
            again[order[1:]] = (one[order[1:]] == one[order[:-1]]) & (two[order[1:]] == two[order[:-1]])
            sent = ~again[row]
            row, gram = row[sent], gram[sent]
            local = np.bincount(gram, minlength=len(distinct))
            there = np.flatnonzero(local)
            place = np.zeros(len(distinct), np.int64)
            place[there] = np.arange(len(there))
            gram = place[gram]
            keys, local = distinct[there], local[there]
            once = local[gram] == 1
            ref = np.full(len(keys), MANY, np.uint16)
            ref[gram[once]] = row[once]
            rows = []
            if len(keys):
                bucket = bucket_of(keys, buckets)
                limits = np.append(segments(bucket), len(keys))
                rows = [
                    (block, int(bucket[a]), int(a), pack_keys(keys[a:b]), local[a:b].astype("<u2").tobytes() + ref[a:b].astype("<u2").tobytes())
                    for a, b in zip(limits[:-1], limits[1:], strict=True)
                ]
            id_, row_key = (batch.column(batch.schema.get_field_index(c)).to_numpy() for c in ("id", "row_key"))
            about = np.stack([id_, row_key, size, one.view(np.int64), two.view(np.int64), again.astype(np.int64)])
            several = np.stack([row[~once], gram[~once]]).astype("<u4").tobytes()
            rows.append((block, -1 - block % buckets, len(keys), about.astype("<i8").tobytes(), several))
            yield pa.RecordBatch.from_pylist([dict(zip(_MESSAGE.names, r, strict=True)) for r in rows], schema=_MESSAGE)

    return emit


def _count(messages: pd.DataFrame) -> pd.DataFrame:
    """In how many sets the keys of a bucket stand; told back where it is more than one."""
    bucket = messages["bucket"].iat[0]
    if bucket < 0:
        return messages
    keys = np.concatenate([unpack_keys(k) for k in messages["keys"]])
    halves = [np.frombuffer(m, "<u2").reshape(2, -1) for m in messages["more"]]
    local, ref = np.concatenate(halves, axis=1)
    order = np.argsort(keys, kind="stable")
    starts = segments(keys[order])
    total = np.empty(len(keys), np.int64)
    total[order] = np.repeat(np.add.reduceat(local[order].astype(np.int64), starts), np.diff(np.append(starts, len(keys))))
    out, a = [], 0
    for block, first, half in zip(messages["block"], messages["first"], halves, strict=True):
        b = a + half.shape[1]
        shared = np.flatnonzero(total[a:b] > 1)
        if len(shared):
            told = np.stack([shared + first, total[a:b][shared], keys[a:b][shared], ref[a:b][shared]])
            out.append((block, bucket, len(shared), None, told.astype("<u4").tobytes()))
        a = b
    return pd.DataFrame(out, columns=_MESSAGE.names)


def _sets(percent: int) -> Callable:
    """The rows of a block; for sets which may have a link also their shared n-grams, rare ones first."""

    def build(messages: pd.DataFrame) -> pd.DataFrame:
        head = messages[messages["keys"].notna()].iloc[0]
        id_, row_key, size, one, two, again = np.frombuffer(head["keys"], "<i8").reshape(6, -1)
        row, gram = np.frombuffer(head["more"], "<u4").reshape(2, -1).astype(np.int64)
        told = messages[messages["keys"].isna()]
        told = [np.vstack([np.frombuffer(m, "<u4").reshape(4, -1), np.full(n, b)]) for b, n, m in zip(told["bucket"], told["first"], told["more"], strict=True)]
        at, number, low, ref, bucket = np.concatenate([np.zeros((5, 0), np.int64), *told], axis=1).astype(np.int64)
        name = bucket << 32 | low
        df, key = np.zeros((2, int(head["first"])), np.int64)
        df[at], key[at] = number, name
        single = ref != MANY
        row = np.concatenate([row, ref[single]])
        tokens, rarity = np.concatenate([key[gram], name[single]]), np.concatenate([df[gram], number[single]])
        order = np.lexsort((tokens, rarity, row))
        row, tokens = row[order], tokens[order]
        number = np.bincount(row, minlength=len(size))
        own = size - number
        indexed = size - -(-percent * size // 100) + 1 - own
        cuts = np.cumsum(number)
        prefix, kept = [None] * len(size), [None] * len(size)
        for n in np.flatnonzero((indexed > 0) & (number > 0) & (again == 0)):
            kept[n] = tokens[cuts[n] - number[n] : cuts[n]]
            prefix[n] = kept[n][: indexed[n]]
        cls = [a + b if n else None for a, b, n in zip(_bytes(one), _bytes(two), size, strict=True)]
        return pd.DataFrame({"id": id_, "row_key": row_key, "n": size, "cls": cls, "own": own.astype(np.int32), "prefix": prefix, "tokens": kept})

    return build


def _bytes(numbers: np.ndarray) -> list[bytes]:
    raw = numbers.astype(">i8").tobytes()
    return [raw[i : i + 8] for i in range(0, len(raw), 8)]


def components(links: DataFrame) -> DataFrame:
    """The smallest node reachable from each node of ``links`` (a, b): node, comp. Labels move along links and jump along labels."""
    both = write_stage(links.select("a", "b").unionAll(links.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), "links")
    labels = write_stage(both.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("node"), F.least("a", "m").alias("comp")), "labels")
    while True:
        near = both.join(labels.select(F.col("node").alias("b"), "comp"), "b").groupBy(F.col("a").alias("node")).agg(F.min("comp").alias("m"))
        step = labels.join(near, "node").select("node", F.least("comp", "m").alias("via"))
        jump = step.join(step.select(F.col("node").alias("via"), F.col("via").alias("to")), "via").select("node", F.col("to").alias("comp"))
        new = write_stage(jump, "labels")
        changed = new.join(labels.withColumnRenamed("comp", "was"), "node").where("comp <> was").limit(1).count()
        labels = new
        if not changed:
            return labels


def _needed(n1: Column, n2: Column, percent: int) -> Column:
    """The overlap which two sets of these sizes need."""
    return F.ceil((n1 + n2) * F.lit(percent) / F.lit(100.0 + percent) - F.lit(1e-9))


def _overlaps(pairs: DataFrame, classes: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b) with their overlap and whether it makes a link."""
    side = lambda c: classes.select(F.col("cls").alias(c), F.col("n").alias(f"n_{c}"), F.col("tokens").alias(f"tokens_{c}"))
    met = pairs.join(side("b"), "b").join(side("a"), "a")
    overlap = F.size(F.array_intersect("tokens_a", "tokens_b")).cast("long")
    found = met.select("a", "b", "n_a", "n_b", overlap.alias("overlap"))
    return found.select("a", "b", "overlap", (F.col("overlap") * (100 + percent) >= (F.col("n_a") + F.col("n_b")) * percent).alias("link"))


def _room(x: str, y: str) -> Column:
    """The overlap still possible when an n-gram at these positions is the first common one."""
    return 1 + F.least(F.col(f"n_{x}") - F.col(f"at_{x}"), F.col(f"n_{y}") - F.col(f"at_{y}"))


def similar_sets(documents: DataFrame, width: int = WIDTH, percent: int = PERCENT) -> DataFrame:
    """For each row: id (NO_ID for null), row_key, n, component (smallest id), and whether the row is the first of its component."""
    keyed = documents.select(
        F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID)).alias("id"), F.xxhash64("doc_id", "text").alias("row_key"),
        F.col("text").cast("binary").alias("text"),
    )
    sent = keyed.mapInArrow(_messages(width, buckets := bucket_count(documents)), MESSAGE)
    rows = write_stage(sent.groupBy("bucket").applyInPandas(_count, MESSAGE).groupBy("block").applyInPandas(_sets(percent), ROWS), "sets")
    viable = rows.where(F.col("tokens").isNotNull()).select("cls", "n", "own", "prefix", "tokens")
    classes = write_stage(first_per_key(viable, ["cls"], ["own"]), "classes")
    postings = classes.select("cls", "n", "own", F.posexplode("prefix").alias("pos", "token")).select(
        "token", "cls", "n", (F.col("own") + F.col("pos") + 1).alias("at"), (F.col("own") / F.col("n")).alias("share")
    )
    best = F.min(F.struct("share", (-F.col("n")).alias("minus_n"), "cls", "at")).alias("p")
    pivots = postings.groupBy("token").agg(F.count(F.lit(1)).alias("members"), best).where("members > 1")
    pivots = pivots.select("token", F.col("p.cls").alias("a"), (-F.col("p.minus_n")).alias("n_a"), F.col("p.at").alias("at_a"))
    entries = write_stage(postings.drop("share").withColumnsRenamed({"cls": "b", "n": "n_b", "at": "at_b"}).join(pivots, "token"), "entries")

    fits = (_room("a", "b") >= _needed(F.col("n_a"), F.col("n_b"), percent)) & _sizes_fit("a", "b", percent)
    pairs = entries.where((F.col("a") != F.col("b")) & fits).select("a", "b").distinct()
    answers = write_stage(_overlaps(pairs, classes, percent), "answers")
    links = answers.where("link").select("a", "b")
    comps = components(links)

    labels = comps.select(F.col("node").alias("b"), "comp")
    told = answers.select(F.col("a"), "b", "overlap")
    of_pivot = comps.select(F.col("node").alias("a"), F.col("comp").alias("pivot_comp"))
    placed = entries.join(labels, "b", "left").join(told, ["a", "b"], "left").join(of_pivot, "a", "left").select(
        "token", "a", "b", "n_b", "at_b", "overlap", F.coalesce("comp", "b").alias("comp"), F.coalesce("pivot_comp", "a").alias("pivot_comp")
    )
    placed = write_stage(placed.where(F.col("a") != F.col("b")), "placed")
    ratio = float(np.log(100 / percent)) if percent < 100 else 1.0
    band = F.floor(F.log(F.col("n_b").cast("double")) / F.lit(ratio)).cast("int")
    left = placed.where(F.col("comp") != F.col("pivot_comp")).select(
        "token", F.col("b").alias("x"), F.col("n_b").alias("n_x"), F.col("at_b").alias("at_x"), F.col("overlap").alias("o_x"), F.col("comp").alias("comp_x"),
        F.explode(F.array(band - 1, band, band + 1)).alias("band"),
    )
    right = placed.select(
        "token", F.col("b").alias("y"), F.col("n_b").alias("n_y"), F.col("at_b").alias("at_y"), F.col("overlap").alias("o_y"), F.col("comp").alias("comp_y"),
        (F.col("comp") == F.col("pivot_comp")).alias("inside"), band.alias("band"),
    )
    needed = _needed(F.col("n_x"), F.col("n_y"), percent)
    bound = F.least("o_x", "o_y") + F.least(F.col("n_x") - F.col("o_x"), F.col("n_y") - F.col("o_y"))
    crossing = (
        (F.col("comp_x") != F.col("comp_y")) & (F.col("inside") | (F.col("x") < F.col("y"))) & _sizes_fit("x", "y", percent)
        & (_room("x", "y") >= needed) & (F.coalesce(bound, needed) >= needed)
    )
    rest = left.join(right, (left["token"] == right["token"]) & (left["band"] == right["band"]) & crossing).select(F.col("x").alias("a"), F.col("y").alias("b"))
    more = write_stage(_overlaps(rest.distinct(), classes, percent).where("link").select("a", "b"), "links")
    comps = components(links.unionAll(more))

    first = rows.where("n > 0").groupBy("cls").agg(F.min(F.struct("id", "row_key")).alias("first"))
    first = first.join(comps.withColumnRenamed("node", "cls"), "cls", "left").withColumn("comp", F.coalesce("comp", "cls"))
    first = write_stage(first, "first")
    least = first.groupBy("comp").agg(F.min("first").alias("least"))
    of_class = first.join(least, "comp").select("cls", "least")
    found = rows.select("id", "row_key", "n", "cls").join(of_class, "cls", "left")
    return found.select(
        "id", "row_key", "n", F.coalesce("least.id", "id").alias("component"),
        F.coalesce((F.col("least.id") == F.col("id")) & (F.col("least.row_key") == F.col("row_key")), F.lit(True)).alias("stays"),
    )


def _sizes_fit(x: str, y: str, percent: int) -> Column:
    return F.least(f"n_{x}", f"n_{y}") * 100 >= F.greatest(f"n_{x}", f"n_{y}") * percent


def one_of_each_group(documents: DataFrame, width: int, percent: int) -> DataFrame:
    """The first document of every group of linked ones; documents without words all stay."""
    keyed = documents.select(
        whole_row(documents).alias("row"), F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID)).alias("id"), F.xxhash64("doc_id", "text").alias("row_key")
    )
    found = similar_sets(documents, width, percent).groupBy("id", "row_key").agg(
        F.count(F.lit(1)).alias("copies"), F.max("stays").alias("stays"), F.max(F.col("n") == 0).alias("empty")
    )
    # rows which go, and repeated rows of which one stays; all others pass without a shuffle while these are few
    special = write_stage(found.where("not empty and (not stays or copies > 1)").select("id", "row_key", "stays"), "special")
    marked = join_small(keyed, special, ["id", "row_key"])
    repeated = first_per_key(marked.where("stays"), ["id", "row_key"], [F.lit(0)])
    return marked.where("stays is null").select("row.*").unionByName(repeated.select("row.*"))
