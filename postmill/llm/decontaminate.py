"""Benchmark decontamination: one Aho-Corasick automaton over normalised items, texts scanned once.

Words are runs of ASCII letters and digits and of any characters beyond ASCII; A-Z are lower-cased. Normalising maps
byte to byte, so a word keeps its place in the UTF-8 text and a hit can be told as a span of the original. Items are cut into
windows of ``width`` words, shorter items are one window. The automaton holds " w1 … wn " for each distinct window.

Items are read to the driver in parts of at most ``part_chars`` pattern characters; each part is one automaton, and the
texts pass through all of them in one step without a shuffle. With the usual size of a benchmark there is one part.

Null or empty texts have no words and no hits. Items without words match nothing. Items with a null id hit words but are
not listed; ids may be of any simple type and are told as text. Repeated items count once by id. Rows with equal ids are kept as they are.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from postmill.llm.common import ranges, whole_row

WIDTH = 10
PART_CHARS = 32 << 20

_NORMAL = bytes(
    c if c >= 0x80 or 0x30 <= c <= 0x39 or 0x61 <= c <= 0x7A else c + 32 if 0x41 <= c <= 0x5A else 0x20 for c in range(256)
)


def normal_words(text: bytes) -> list[bytes]:
    return text.translate(_NORMAL).split()


def _windows(width: int):
    """Distinct windows of each item, as latin-1 text (byte for byte)."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            patterns, ids = [], []
            for item, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                found = normal_words(text or b"")
                size = min(width, len(found))
                own = {b" ".join(found[i : i + size]) for i in range(len(found) - size + 1)} if found else ()
                patterns += own
                ids += [item] * len(own)
            yield pa.record_batch([pa.array(patterns, pa.binary()), pa.array(ids, pa.string())], names=["pattern", "item_id"])

    return cut


def item_windows(items: DataFrame, width: int = WIDTH, part_chars: int = PART_CHARS) -> list[list[tuple[str, list[str]]]]:
    """The windows of all items with the items they belong to, in parts of bounded size."""
    rows = items.select(F.col("item_id").cast("string"), F.col("text").cast("binary").alias("text"))
    windows = rows.mapInArrow(_windows(width), "pattern binary, item_id string").distinct()
    size = windows.agg(F.sum(F.length("pattern") + 16)).first()[0] or 0
    parts = int(-(-size // part_chars)) or 1
    dealt = windows.withColumn("part", F.pmod(F.xxhash64("pattern"), F.lit(parts)))
    out = []
    for part in range(parts):
        patterns: dict[str, list[str]] = {}
        for row in dealt.where(F.col("part") == part).toLocalIterator():
            own = patterns.setdefault(f" {bytes(row['pattern']).decode('latin-1')} ", [])
            if row["item_id"] is not None:
                own.append(row["item_id"])
        out.append(sorted(patterns.items()))
    return out


def _automaton(windows: list[tuple[str, list[str]]]) -> ahocorasick.Automaton | None:
    if not windows:
        return None
    built = ahocorasick.Automaton()
    for pattern, ids in windows:
        built.add_word(pattern, (len(pattern) - 2, pattern.count(" ") - 1, ids))
    built.make_automaton()
    return built


def _scan(shared):
    """Adds the hits of one automaton: word ranges (first, number) and items, as arrays."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton = _automaton(shared.value)
        for batch in batches:
            columns = {name: batch.column(i) for i, name in enumerate(batch.schema.names)}
            first, number, items, counts = [], [], [], []
            for n, text in enumerate(columns["text_bytes"]):
                found = normal_words(text.as_py() or b"")
                counts.append(len(found))
                own_first, own_number, own_items = [], [], set()
                if found and automaton is not None:
                    line = f" {b' '.join(found).decode('latin-1')} "
                    before = None
                    for end, (_, size, ids) in automaton.iter(line):
                        if before is None:
                            before = np.cumsum(np.frombuffer(line.encode("latin-1"), np.uint8) == 32)
                        own_first.append(int(before[end]) - 1 - size)
                        own_number.append(size)
                        own_items.update(ids)
                first.append(columns["hit_first"][n].as_py() + own_first)
                number.append(columns["hit_number"][n].as_py() + own_number)
                items.append(sorted(own_items.union(columns["hit_items"][n].as_py())))
            columns["n_words"] = pa.array(counts, pa.int64())
            columns["hit_first"] = pa.array(first, pa.list_(pa.int32()))
            columns["hit_number"] = pa.array(number, pa.list_(pa.int32()))
            columns["hit_items"] = pa.array(items, pa.list_(pa.string()))
            yield pa.record_batch([columns[name] for name in batch.schema.names], names=batch.schema.names)

    return scan


def _spans(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Covered words, digests, and the byte spans of covered stretches in the original text."""
    for batch in batches:
        columns = {name: batch.column(i) for i, name in enumerate(batch.schema.names)}
        hit_words, digests, begins, ends, sizes = [], [], [], [], []
        for n in range(batch.num_rows):
            items = columns["hit_items"][n].as_py()
            digests.append(hashlib.sha256(",".join(sorted(items)).encode()).hexdigest())
            sizes.append(len(items))
            first = np.array(columns["hit_first"][n].as_py(), dtype=np.int64)
            if not len(first):
                hit_words.append(0)
                begins.append([])
                ends.append([])
                continue
            number = np.array(columns["hit_number"][n].as_py(), dtype=np.int64)
            text = np.frombuffer(columns["text_bytes"][n].as_py().translate(_NORMAL), np.uint8)
            inside = np.concatenate(([False], text != 32, [False]))
            starts, stops = np.flatnonzero(inside[1:] & ~inside[:-1]), np.flatnonzero(inside[:-1] & ~inside[1:])
            covered = np.zeros(len(starts), dtype=bool)
            covered[np.repeat(first, number) + ranges(number)] = True
            hit_words.append(int(covered.sum()))
            edge = np.diff(np.concatenate(([0], covered.astype(np.int8), [0])))
            begins.append(starts[np.flatnonzero(edge == 1)].tolist())
            ends.append(stops[np.flatnonzero(edge == -1) - 1].tolist())
        columns["n_hit"] = pa.array(hit_words, pa.int64())
        columns["n_items"] = pa.array(sizes, pa.int64())
        columns["items_sha256"] = pa.array(digests, pa.string())
        columns["span_begins"] = pa.array(begins, pa.list_(pa.int64()))
        columns["span_ends"] = pa.array(ends, pa.list_(pa.int64()))
        drop = ("text_bytes", "hit_first", "hit_number", "hit_items")
        names = [name for name in columns if name not in drop]
        yield pa.record_batch([columns[name] for name in names], names=names)


OUTPUT = "n_words long, n_hit long, n_items long, items_sha256 string, span_begins array<long>, span_ends array<long>"


def contamination(documents: DataFrame, items: DataFrame, width: int = WIDTH, part_chars: int = PART_CHARS, keep: str = "doc_id") -> DataFrame:
    """For every document its words, hit words, items, and the hit stretches as byte spans of the original UTF-8 text.

    ``keep`` names the column (any simple type) which comes along; "*" brings the whole row as a struct ``row``.
    """
    spark = documents.sparkSession
    row = whole_row(documents).alias("row") if keep == "*" else F.col(keep).alias("row")
    empty = F.array().cast("array<int>")
    scanned = documents.select(
        row, F.col("text").cast("binary").alias("text_bytes"), F.lit(0).cast("long").alias("n_words"),
        empty.alias("hit_first"), empty.alias("hit_number"), F.array().cast("array<string>").alias("hit_items"),
    )
    shared = [spark.sparkContext.broadcast(part) for part in item_windows(items, width, part_chars)]

    def pass_through(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in shared:
            batches = _scan(part)(batches)
        return _spans(batches)

    # one Python worker a task: a step of its own for each would have as many workers a task, each with its own libraries and copies of the rows
    kind = scanned.schema["row"].dataType.simpleString()
    done = scanned.mapInArrow(pass_through, f"row {kind}, {OUTPUT}")
    return done if keep == "*" else done.withColumnRenamed("row", keep)


def digest(documents: DataFrame, items: DataFrame) -> DataFrame:
    """The columns of the contract, one row per document."""
    found = contamination(documents.withColumn("doc_id", F.col("doc_id").cast("long")), items)
    return found.select("doc_id", "n_words", "n_hit", "n_items", "items_sha256", (F.col("n_hit") > 0).alias("contaminated"))
