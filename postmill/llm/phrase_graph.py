"""Collocations from a weighted de Bruijn graph of words.

Texts are cut into pieces and pieces into words. Each place of a piece gives the words that begin there, ``width`` of them: an edge between
two overlapping nodes of ``width - 1`` words, weighted by its number of places. Near the end of a piece fewer words are left; these shorter
windows are the corrections for piece ends. Every place gives one window, so that the places of a shorter phrase are the flow out of its
node: all edges that begin with it, and the corrections that do.

1. A filter. Blocks count their neighbouring pairs of words; pairs meet in buckets by hash, and those with ``least`` places set one bit of
   a bitmap of fixed size (4 MB). Pairs whose bit is clear stand in no phrase with ``least`` places, so pieces end there too. Hash
   collisions only let a pair pass.
2. Edges. A block adds up equal stretches between such ends, Spark cuts them into windows and adds up the windows of all blocks.
3. Unary paths. Heavy edges meet where a node has one edge in, one edge out, of equal weight, and no piece begins or ends there. Chains of
   them are compacted by doubling pointers (``unary_paths``), so that a passage is one row.
4. Flow. Paths, light edges and corrections are opened to their first 1 to ``width`` words and added up.

No group of rows is gathered: all sums are partial before their shuffle, so that a frequent word, pair or passage is a row per task.
A phrase within another of equal frequency is dropped. The other may be taken as one word longer: if it is longer still, those between are
no rarer than it and no more frequent than the phrase.

Null and empty texts have no words. Documents without a language are of ``und``. Ids play no part: repeated rows and rows without an id
count each. A text is held whole in one task, its stretches are sent in parts of ``STRETCH`` places. Extra columns are not read.
Counts are exact; products are decimals of 38 digits.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from postmill.llm.common import LOWER, bucket_count, bucket_of, mix, pack_keys, ranges, segments, text_blocks, unpack_keys, word_hashes, words
from postmill.operators.joins import join_small
from postmill.session import write_stage

WIDTH, LEAST, TOP = 5, 100, 2000
SLOT_BITS = 25
STRETCH = 1000
MANY = 0xFFFF
BLOCK_BYTES = 3 << 19
ARROW_BYTES = 4 << 20
"""Texts go to Python in batches of so many bytes; batches by number alone hold tens of MB of whole documents, on both sides."""

_PIECE = np.zeros(256, dtype=bool)
_PIECE[list(b".,;:!?\n\x0b\x0c\r")] = True
_SEPARATORS = _PIECE.copy()
_SEPARATORS[[0x20, 0x09]] = True
_PAIRS = pa.schema([("bucket", pa.int64()), ("keys", pa.binary()), ("counts", pa.binary())])
_STRETCHES = pa.schema([("lang", pa.string()), ("stretch", pa.string()), ("places", pa.int32()), ("weight", pa.int64())])


def _block(batch: pa.RecordBatch, data: np.ndarray, offsets: np.ndarray):
    """Lower-cased bytes, words, pair keys (by language), and whether word ``i + 1`` follows word ``i`` in its piece; languages and their rows."""
    data = LOWER[data]
    starts, ends, row = words(data, offsets, _SEPARATORS)
    langs = batch.column(batch.schema.get_field_index("lang")).dictionary_encode()
    names, code = langs.dictionary, langs.indices.to_numpy()
    hashes = word_hashes(data, starts, ends)
    if len(hashes) < 2:
        return data, starts, ends, np.zeros(0, np.uint64), np.zeros(0, bool), names, code[row]
    of_lang = word_hashes(*_joined(names)) if len(names) else np.zeros(0, np.uint64)
    keys = mix(hashes[:-1] * np.uint64(0x9E3779B97F4A7C15) + mix(hashes[1:] + of_lang[code[row[1:]]]))
    ended = np.cumsum(_PIECE[data], dtype=np.int32)
    follows = (row[1:] == row[:-1]) & (ended[starts[1:]] == ended[ends[:-1] - 1])
    return data, starts, ends, keys, follows, names, code[row]


def _joined(names: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    raw = [n.encode() + b" " for n in names.to_pylist()]
    ends = np.cumsum([len(r) for r in raw])
    return np.frombuffer(b"".join(raw), np.uint8), ends - [len(r) for r in raw], ends


def _pair_messages(buckets: int) -> Callable:
    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, data, offsets in text_blocks(batches):
            keys, follows = _block(batch, data, offsets)[3:5]
            keys, counts = np.unique(keys[follows], return_counts=True)
            if not len(keys):
                continue
            counts = np.minimum(counts, MANY).astype("<u2")
            bucket = bucket_of(keys, buckets)
            limits = np.append(segments(bucket), len(keys))
            rows = [(int(bucket[a]), pack_keys(keys[a:b]), counts[a:b].tobytes()) for a, b in zip(limits[:-1], limits[1:], strict=True)]
            yield pa.RecordBatch.from_pylist([dict(zip(_PAIRS.names, r, strict=True)) for r in rows], schema=_PAIRS)

    return emit


def _frequent(least: int) -> Callable:
    def add(messages: pd.DataFrame) -> pd.DataFrame:
        keys = np.concatenate([unpack_keys(k) for k in messages["keys"]])
        counts = np.concatenate([np.frombuffer(c, "<u2") for c in messages["counts"]]).astype(np.int64)
        order = np.argsort(keys, kind="stable")
        starts = segments(keys[order])
        total = np.add.reduceat(counts[order], starts)
        slots = keys[order][starts][total >= min(least, MANY)] & np.uint32((1 << SLOT_BITS) - 1)
        return pd.DataFrame({"at": (slots >> np.uint32(6)).astype(np.int64), "bit": (slots & np.uint32(63)).astype(np.int32)})

    return add


def frequent_pairs(documents: DataFrame, least: int) -> np.ndarray:
    """A bitmap in which each pair of neighbouring words with ``least`` places in one language has its bit set; 4 MB for any input."""
    sent = documents.mapInArrow(_pair_messages(bucket_count(documents)), "bucket long, keys binary, counts binary")
    bits = sent.groupBy("bucket").applyInPandas(_frequent(least), "at long, bit int")
    rows = bits.groupBy("at").agg(F.bit_or(F.expr("shiftleft(1L, bit)")).alias("bits")).toArrow()
    bitmap = np.zeros(1 << (SLOT_BITS - 6), np.uint64)
    bitmap[rows.column("at").to_numpy()] = rows.column("bits").to_numpy().view(np.uint64)
    return bitmap


def _stretches(bitmap, width: int) -> Callable:
    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = bitmap.value
        for batch, data, offsets in text_blocks(batches, max_bytes=BLOCK_BYTES):
            data, starts, ends, keys, follows, names, code = _block(batch, data, offsets)
            if not len(starts):
                continue
            slot = keys & np.uint64((1 << SLOT_BITS) - 1)
            holds = follows & ((bits[slot >> np.uint64(6)] >> (slot & np.uint64(63)) & np.uint64(1)) == 1)
            first = np.flatnonzero(np.concatenate(([True], ~holds)))
            size = np.diff(np.append(first, len(starts)))
            # parts of long stretches overlap by the words a window needs
            parts = -(-size // STRETCH)
            begin = np.repeat(first, parts) + ranges(parts) * STRETCH
            left = np.repeat(first + size, parts) - begin
            places, size = np.minimum(left, STRETCH), np.minimum(left, STRETCH + width - 1)
            word = np.repeat(begin, size) + ranges(size)
            last = np.zeros(len(word), bool)
            last[np.cumsum(size) - 1] = True
            length = ends[word] - starts[word] + ~last
            until = np.cumsum(length)
            at = np.minimum(np.repeat(starts[word], length) + ranges(length), len(data) - 1)
            raw = data[at]
            raw[until[~last] - 1] = 0x20
            text = pa.StringArray.from_buffers(
                len(begin), pa.py_buffer(np.concatenate(([0], until[last])).astype(np.int32)), pa.py_buffer(raw)
            )
            found = pa.table({"lang": code[begin], "places": places.astype(np.int32), "stretch": text})
            found = found.group_by(["lang", "places", "stretch"], use_threads=False).aggregate([([], "count_all")])
            columns = [pc.take(names, found.column("lang").combine_chunks()), *(found.column(c).combine_chunks() for c in ("stretch", "places", "count_all"))]
            yield pa.RecordBatch.from_arrays(columns, schema=_STRETCHES)

    return emit


def _leading(phrase: str, k: str) -> str:
    return f"substring_index({phrase}, ' ', {k})"


def windows(documents: DataFrame, width: int = WIDTH, least: int = LEAST) -> DataFrame:
    """lang, phrase, size, weight: edges of ``width`` words, and the shorter windows at ends of pieces and of what can be frequent."""
    documents.sparkSession.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", ARROW_BYTES)
    texts = documents.where(F.col("text").isNotNull()).select(F.coalesce("lang", F.lit("und")).alias("lang"), F.col("text").cast("binary").alias("text"))
    bitmap = documents.sparkSession.sparkContext.broadcast(frequent_pairs(texts, least))
    stretches = texts.mapInArrow(_stretches(bitmap, width), "lang string, stretch string, places int, weight long")
    split = stretches.select("lang", "weight", "places", F.split("stretch", " ").alias("w"))
    each = split.select("lang", "weight", F.explode(F.expr(f"transform(sequence(1, places), i -> array_join(slice(w, i, {width}), ' '))")).alias("phrase"))
    added = each.groupBy("lang", "phrase").agg(F.sum("weight").alias("weight"))
    return added.select("lang", "phrase", _size("phrase").alias("size"), "weight")


def _size(phrase: str) -> Column:
    return F.char_length(phrase) - F.char_length(F.replace(F.col(phrase), F.lit(" "), F.lit(""))) + 1


def unary_paths(found: DataFrame, width: int = WIDTH, least: int = LEAST) -> DataFrame:
    """lang, phrase, weight, edges: edges of weight ``least`` or more, chained through nodes with one edge in and one out of equal weight.

    A ring of such nodes has no beginning; its edges stay single.
    """
    tail, head = F.expr(_leading("phrase", str(width - 1))), F.expr(f"substring_index(phrase, ' ', {1 - width})")
    edges = found.where(F.col("size") == width)
    heavy = edges.where(F.col("weight") >= least)
    into = heavy.select("lang", head.alias("node"), F.col("phrase").alias("before"), F.col("weight").alias("weight"))
    out = heavy.select("lang", tail.alias("node"), F.col("phrase").alias("after"), F.col("weight").alias("weight"))
    joints = write_stage(into.join(out, ["lang", "node", "weight"]), "joints")
    nodes = joints.select("lang", "node").distinct()
    nodes = write_stage(nodes.select("lang", "node", F.lit(True).alias("joint")), "nodes")
    # what enters and leaves these nodes in all, light edges and ends of pieces included
    leaving = join_small(found.where(F.col("size") >= width - 1).select("lang", tail.alias("node"), F.lit(1).alias("out")), nodes, ["lang", "node"], how="inner")
    entering = join_small(edges.select("lang", head.alias("node"), F.lit(0).alias("out")), nodes, ["lang", "node"], how="inner")
    ways = leaving.unionAll(entering).groupBy("lang", "node").agg(F.sum("out").alias("out"), F.count(F.lit(1)).alias("ways"))
    unary = ways.where("out = 1 AND ways = 2").select("lang", "node")
    links = joints.join(unary, ["lang", "node"]).select("lang", F.col("after").alias("phrase"), "before")
    placed = heavy.select("lang", "phrase", "weight").join(links, ["lang", "phrase"], "left")
    # pointers to an earlier edge of the path and the steps to it, doubled until they stand at its first edge
    placed = write_stage(placed.select(
        "lang", "phrase", "weight", F.coalesce("before", "phrase").alias("to"), F.when(F.col("before").isNull(), 0).otherwise(1).cast("long").alias("steps"),
        F.col("before").isNull().alias("done"),
    ), "paths")
    open_ends = placed.where("not done").count()
    while open_ends:
        target = placed.select("lang", F.col("phrase").alias("to"), F.col("to").alias("next"), F.col("steps").alias("more"), F.col("done").alias("there"))
        placed = write_stage(placed.join(target, ["lang", "to"]).select(
            "lang", "phrase", "weight", F.col("next").alias("to"), F.when(F.col("done"), F.col("steps")).otherwise(F.col("steps") + F.col("more")).alias("steps"),
            F.col("there").alias("done"),
        ), "paths")
        still = placed.where("not done").count()
        if still == open_ends:
            break
        open_ends = still
    own = F.col("done") & (F.col("steps") > 0)
    ordered = F.sort_array(F.collect_list(F.struct("steps", "phrase")))
    chained = placed.withColumn("to", F.when(own, F.col("to")).otherwise(F.col("phrase"))).withColumn("steps", F.when(own, F.col("steps")).otherwise(0))
    paths = chained.groupBy("lang", "to", "weight").agg(ordered.alias("e"))
    more = F.transform(F.slice("e", 2, F.greatest(F.size("e") - 1, F.lit(0))), lambda x: F.substring_index(x["phrase"], " ", -1))
    return paths.select("lang", F.concat_ws(" ", F.col("to"), more).alias("phrase"), "weight", F.size("e").alias("edges"))


def phrase_counts(found: DataFrame, paths: DataFrame, width: int = WIDTH, least: int = LEAST) -> DataFrame:
    """lang, phrase, size, f: all phrases of 1 to ``width`` words with at least ``least`` places, from the flow out of their nodes."""
    rest = found.where((F.col("size") < width) | (F.col("weight") < least)).select("lang", "phrase", "size", "weight")
    split = paths.select("lang", "weight", "edges", F.split("phrase", " ").alias("w"))
    edge = F.explode(F.expr(f"transform(sequence(1, edges), i -> array_join(slice(w, i, {width}), ' '))")).alias("phrase")
    edges = split.select("lang", edge, F.lit(width).alias("size"), "weight")
    opened = F.explode(F.expr(f"transform(sequence(1, size), k -> struct({_leading('phrase', 'k')} AS phrase, k AS size))")).alias("p")
    flow = rest.unionByName(edges).select("lang", "weight", opened).groupBy("lang", "p.phrase").agg(F.max("p.size").alias("size"), F.sum("weight").alias("f"))
    return flow.where(F.col("f") >= least)


def scored(counts: DataFrame, totals: DataFrame, width: int = WIDTH) -> DataFrame:
    """lang, phrase, a, l, r, n, score of the phrases of two words or more that no longer phrase of equal frequency holds."""
    candidates = counts.where("size >= 2")
    longer = counts.where("size >= 3").select(
        "lang", "f", F.explode(F.array(F.expr(_leading("phrase", "size - 1")), F.expr("substring_index(phrase, ' ', 1 - size)"))).alias("phrase")
    ).groupBy("lang", "phrase").agg(F.max("f").alias("in_longer"))
    left = candidates.join(longer, ["lang", "phrase"], "left").where("in_longer IS NULL OR in_longer < f").select("lang", "phrase", "size", F.col("f").alias("a"))
    cuts = left.select("*", F.explode(F.sequence(F.lit(1), F.col("size") - 1)).alias("k"))
    cuts = cuts.select("*", F.expr(_leading("phrase", "k")).alias("first"), F.expr("substring_index(phrase, ' ', k - size)").alias("rest"))
    part = lambda name, f: counts.select("lang", F.col("phrase").alias(name), F.col("f").alias(f))
    cuts = cuts.join(part("first", "l"), ["lang", "first"]).join(part("rest", "r"), ["lang", "rest"])
    cuts = join_small(cuts, totals, "lang")
    score = F.expr("(1000BD * cast(a AS decimal(19,0)) * cast(n AS decimal(19,0))) div (cast(l AS decimal(19,0)) * cast(r AS decimal(19,0)))")
    least = F.min(F.struct(score.alias("score"), "k", "l", "r")).alias("m")
    return cuts.groupBy("lang", "phrase", "a", "n").agg(least).select("lang", "phrase", "a", "m.l", "m.r", "n", "m.score")


def collocations(documents: DataFrame, width: int = WIDTH, least: int = LEAST, top: int = TOP) -> DataFrame:
    """The ``top`` phrases of each language by score, then frequency, then bytes: lang, rank, phrase, a, l, r, n, score."""
    found = write_stage(windows(documents, width, least), "windows")
    totals = write_stage(found.groupBy("lang").agg(F.sum("weight").alias("n")), "totals")
    paths = write_stage(unary_paths(found, width, least), "unary_paths")
    counts = write_stage(phrase_counts(found, paths, width, least), "phrase_counts")
    best = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), F.asc("phrase"))
    ranked = scored(counts, totals, width).withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= top)
    return ranked.select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")
