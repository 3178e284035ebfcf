"""Spelling variants by permuterm rotations: words one inserted, deleted or replaced code point apart meet in sorted rotations.

A word ``w`` is marked with a terminator and all its rotations ``w[i:] + $ + w[:i]`` are sorted. Two words which differ only in the code
point at one place share the rotation that begins after it, up to its last code point: a prefix range that skips the edited code point. A
word with that code point deleted has the prefix itself as a whole rotation. So each group of one prefix holds replacements of each
other (its long members) and, at most once, the word without the edited code point. Of a run of equal code points only the first is
deleted, as the others give the same word, so that no pair of words meets twice.

A group has at most one member per code point of the alphabet, whatever the input, so that no group is large and no hot key arises; a
scan emits the neighbours of its members. Words are counted by document first, then in Spark with partial sums.

Null and empty texts have no words. Rows without a doc_id take part, but no code point of theirs is deleted, as the rule needs the id. Rows
with equal ids count each. Texts have no length limit; a task holds the distinct words of one text. Extra columns are not read.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from postmill.operators.joins import join_small
from postmill.session import write_stage

DIVISOR = 199
LENGTH, OCCURRENCES, RATIO = 6, 5, 5
TERMINATOR = "$"
FLUSH = 200_000
"""Distinct words which a task counts before it sends them on."""

_RUN = re.compile("[A-Za-zÀ-ÿ]+")
_LOWER = bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256))
_COUNTS = pa.schema([("word", pa.string()), ("n", pa.int64())])


def runs_of(text: bytes) -> Counter:
    """How often each run of letters, with A-Z lower-cased, stands in a UTF-8 text."""
    return Counter(map(re.Match.group, _RUN.finditer(text.translate(_LOWER).decode())))


def with_deletions(doc_id: int | None, runs: Counter, divisor: int = DIVISOR) -> Iterator[tuple[str, int]]:
    """The runs with their counts; those whose checksum with the id is divisible lose one code point."""
    if doc_id is None:
        yield from runs.items()
        return
    of_id = zlib.crc32(b"%d:" % doc_id)
    for run, n in runs.items():
        h = zlib.crc32(run.encode(), of_id)
        if h % divisor == 0:
            place = h % len(run)
            run = run[:place] + run[place + 1 :]
        yield run, n


def _counting(least_length: int, divisor: int) -> Callable:
    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = Counter()
        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                for run, n in with_deletions(doc_id, runs_of(text.as_py()), divisor):
                    if len(run) >= least_length:
                        held[run] += n
                if len(held) >= FLUSH:
                    yield pa.RecordBatch.from_arrays([pa.array(held.keys(), pa.string()), pa.array(held.values(), pa.int64())], schema=_COUNTS)
                    held = Counter()
        if held:
            yield pa.RecordBatch.from_arrays([pa.array(held.keys(), pa.string()), pa.array(held.values(), pa.int64())], schema=_COUNTS)

    return emit


def word_counts(documents: DataFrame, least_length: int = LENGTH, least: int = OCCURRENCES, divisor: int = DIVISOR) -> DataFrame:
    """word, n: the words of all documents with at least ``least_length`` code points and ``least`` occurrences."""
    texts = documents.where(F.col("text").isNotNull()).select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("binary").alias("text"))
    counted = texts.mapInArrow(_counting(least_length, divisor), "word string, n long")
    return counted.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= least)


def rotations(words: DataFrame) -> DataFrame:
    """prefix, edited, first, word, n: for each rotation the prefix which skips its last code point, and the whole one (``edited`` is null).

    ``first`` tells whether the edited code point begins a run of equal ones.
    """
    place = F.explode(F.sequence(F.lit(0), F.char_length("word"))).alias("i")
    at = words.select("word", "n", place)
    end = F.char_length("word")
    piece = lambda begin, to: F.substring("word", begin + 1, to - begin)
    whole = F.concat(piece(F.col("i"), end), F.lit(TERMINATOR), piece(F.lit(0), F.col("i")))
    skipping = F.concat(piece(F.col("i") + 1, end), F.lit(TERMINATOR), piece(F.lit(0), F.col("i")))
    edited = piece(F.col("i"), F.col("i") + 1)
    before = F.when(F.col("i") > 0, piece(F.col("i") - 1, F.col("i")))
    both = F.array(
        F.struct(skipping.alias("prefix"), edited.alias("edited"), F.coalesce(edited != before, F.lit(True)).alias("first")),
        F.struct(whole.alias("prefix"), F.lit(None).cast("string").alias("edited"), F.lit(False).alias("first")),
    )
    rows = at.select("word", "n", "i", F.explode(both).alias("r"))
    # after the last code point nothing is left to skip
    return rows.where(F.col("r.edited").isNull() | (F.col("i") < end)).select("r.*", "word", "n")


def neighbours(words: DataFrame) -> DataFrame:
    """word, near, near_n: all ordered pairs of ``words`` which one inserted, deleted or replaced code point tells apart."""
    member = F.struct("word", "n", "edited", "first")
    groups = rotations(words).groupBy("prefix").agg(F.collect_list(member).alias("members")).where(F.size("members") > 1)
    scanned = groups.select("members", F.explode("members").alias("m"))
    other = lambda x: F.when(
        x["edited"].isNotNull() & F.col("m.edited").isNotNull(), x["word"] != F.col("m.word")
    ).otherwise((x["edited"].isNull() & F.col("m.first")) | (F.col("m.edited").isNull() & x["first"]))
    pairs = scanned.select(F.col("m.word").alias("word"), F.explode(F.filter("members", other)).alias("x"))
    return pairs.select("word", F.col("x.word").alias("near"), F.col("x.n").alias("near_n"))


def roots(links: DataFrame) -> DataFrame:
    """word, root: the last word reached from ``word`` by links (word, form). Each round doubles the steps; links must not form rings."""
    found = write_stage(links.select("word", F.col("form").alias("root")), "roots")
    while True:
        onward = found.select(F.col("word").alias("root"), F.col("root").alias("next"))
        stepped = write_stage(found.join(onward, "root", "left").select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")), "roots")
        moved = stepped.where("moved").limit(1).count()
        found = stepped.select("word", "root")
        if not moved:
            return found


def variants(words: DataFrame, ratio: int = RATIO) -> DataFrame:
    """word, form, root, n, n_near, form_n for each of ``words`` (word, n).

    The form is the near word of largest n, the smallest of several, where it is at least ``ratio`` times as frequent as the word.
    """
    words = write_stage(words, "words")
    best = F.min(F.struct((-F.col("near_n")).alias("minus_n"), "near")).alias("best")
    near = neighbours(words).groupBy("word").agg(F.count(F.lit(1)).alias("n_near"), best)
    joined = words.join(near, "word", "left")
    is_form = -F.col("best.minus_n") >= F.col("n") * ratio
    told = write_stage(joined.select(
        "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(is_form, F.col("best.near")).alias("form"), F.when(is_form, -F.col("best.minus_n")).alias("form_n"),
    ), "told")
    last = write_stage(roots(told.where("form IS NOT NULL").select("word", "form")), "last")
    return join_small(told, last, "word").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
