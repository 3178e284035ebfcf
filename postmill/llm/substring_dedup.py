"""Long repeats across documents by recompression.

Every document is parsed in two rounds. A round first names maximal runs of one symbol, then pairs of neighbours where
the left symbol's name falls in one half of all names and the right symbol's in the other. Names are 64-bit digests of what
a symbol stands for, so every task names equal runs and pairs alike without a shared dictionary. Whether two neighbours join
depends on near-by words only; so a passage which stands in two places has the same inner symbols in both.

A level-2 symbol is *settled* when the three words before and after it decide its borders, whatever stands further off: no runs
among them, and no pair which may equal the symbol next to it. Settling and the name of the settled stretch (symbol and those
six words) depend on these words alone. Of each window of ``width`` words the settled stretch inside it with the smallest
name is its anchor; equal windows have equal anchors. A window without any (long runs) is its own anchor.

1. Spark meets the anchors of all documents in buckets; those seen once cannot belong to a repeat.
2. Windows whose anchor is shared are named in full by 105 bits or more (bucket, 32 and 64); Spark finds the smallest document of each name.
   Each block of documents sends a window once, with the smallest id of its own, so a frequent window stays small.
3. Words under a window that also starts in a smaller document are marked.

Null or empty texts and texts shorter than a window have no windows. Rows with equal doc_id are one document for the comparison, each
is answered. Rows without doc_id come after all others: what they repeat is marked in them, and they mark nothing.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from postmill.llm.common import (
    bucket_count, bucket_of, block_ids, mix, pack_keys, ranges, segments, text_blocks, unpack_keys, whole_row, window_hashes, word_hashes, words,
)

WIDTH = 13
SIDE = 3
NO_ID = (1 << 63) - 1
NOWHERE = 0xFFFFFFFF
_ALONE = np.int64(1) << np.int64(31)


def _joined(names: np.ndarray, row: np.ndarray, blocks: bool) -> np.ndarray:
    """Whether each symbol joins the one before it: equal ones to runs, else pairs across the two halves of names."""
    same_row = row[1:] == row[:-1]
    if blocks:
        join = (names[1:] == names[:-1]) & same_row
    else:
        half = (names & np.uint64(1)).astype(bool)
        join = ~half[:-1] & half[1:] & same_row
    return np.concatenate(([False], join))


def _merge(names: np.ndarray, first: np.ndarray, row: np.ndarray, join: np.ndarray):
    """Symbols of the next level: name, first word and row."""
    heads = np.flatnonzero(~join)
    number = np.diff(np.append(heads, len(names)))
    head = names[heads]
    tail = names[heads + number - 1]
    made = np.where(number > 1, mix(head * np.uint64(0xD6E8FEB86659FD93) + tail * np.uint64(0xA5A3564E27F886C9) + number.astype(np.uint64)), head)
    return made, first[heads], row[heads]


def parse(hashes: np.ndarray, row: np.ndarray, rounds: int = 2):
    """First words of the symbols left after ``rounds`` of naming runs and pairs."""
    names, first = hashes, np.arange(len(hashes))
    for _ in range(rounds):
        for blocks in (True, False):
            names, first, row = _merge(names, first, row, _joined(names, row, blocks))
    return first


def anchors(hashes: np.ndarray, row: np.ndarray, row_ends: np.ndarray, width: int):
    """For each window (by first word): its anchor's key and the word at which the anchor begins, or its own key and word.

    ``row_ends`` holds for each word the end of its row. Returns windows, keys, anchor words (with a flag for windows of their own).
    """
    n = len(hashes)
    windows = np.flatnonzero(np.arange(n) + width <= row_ends)
    if not len(windows):
        nothing = np.zeros(0, np.int64)
        return windows, nothing.astype(np.uint64), nothing
    high = parse(hashes, row)
    ends = np.append(high[1:], n)
    row_starts = np.concatenate(([0], np.flatnonzero(row[1:] != row[:-1]) + 1))
    start_of = row_starts[np.searchsorted(row_starts, high, "right") - 1]
    inside = (high - SIDE >= start_of) & (ends + SIDE <= row_ends[high]) & (ends - high + 2 * SIDE <= width)
    place, end = high[inside], ends[inside]
    half = (hashes & np.uint64(1)).astype(bool)
    l1, l2, l3 = (hashes[place - k] for k in (1, 2, 3))
    r1, r2, r3 = (hashes[end + k] for k in (0, 1, 2))
    settled = (l1 != l2) & (l2 != l3) & (r1 != r2) & (r2 != r3)
    settled &= ~(~half[place - 2] & half[place - 1] & (l3 == l1)) & ~(~half[end] & half[end + 1] & (r3 == r1))
    place, begin, end = place[settled], place[settled] - SIDE, end[settled] + SIDE
    # a settled stretch is named by all of its words, which are few
    total = np.zeros(len(begin), np.uint64)
    size = end - begin
    for k in range(width):
        more = size > k
        total[more] = total[more] * np.uint64(0x9E3779B97F4A7C15) + hashes[begin[more] + k]
    names = mix(total + size.astype(np.uint64) * np.uint64(0xC2B2AE3D27D4EB4F))
    # the least name among the stretches inside each window: stretches begin and end in rising order
    first = np.searchsorted(begin, windows, "left")
    last = np.searchsorted(end, windows + width, "right")
    number = last - first
    pick = np.full(len(windows), -1, np.int64)
    least, reach = np.arange(len(names)), 1  # place of the least name among the next ``reach`` stretches, the first of equals
    while reach <= int(number.max(initial=0)):
        own = np.flatnonzero((number >= reach) & (number < 2 * reach))
        left, right = least[first[own]], least[last[own] - reach]
        pick[own] = np.where(names[left] <= names[right], left, right)
        left, right = least[:-reach], least[reach:]
        least, reach = np.where(names[left] <= names[right], left, right), 2 * reach
    alone = pick < 0
    anchor_at = np.where(alone, windows | _ALONE, 0)
    anchor_at[~alone] = place[pick[~alone]]
    keys = np.empty(len(windows), np.uint64)
    keys[~alone] = names[pick[~alone]]
    if alone.any():
        keys[alone] = window_hashes(hashes, width, 0)[windows[alone]]
    return windows, keys, anchor_at


def _words_of(data: np.ndarray, offsets: np.ndarray):
    starts, ends, row = words(data, offsets)
    number = np.bincount(row, minlength=len(offsets) - 1)
    first = np.cumsum(number) - number
    return starts, ends, row, number, first, (first + number)[row] if len(row) else row


def _column(batch: pa.RecordBatch, name: str) -> np.ndarray:
    return batch.column(batch.schema.get_field_index(name)).to_numpy(zero_copy_only=False)


MESSAGE = "block long, bucket long, first int, keys binary, more binary"


def _anchor_messages(width: int, buckets: int) -> Callable:
    """Anchors of each block, one message per bucket, and one about the block's rows."""

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids = block_ids()
        for batch, data, offsets in text_blocks(batches):
            block = next(ids)
            starts, ends, row, number, first, row_ends = _words_of(data, offsets)
            _, keys, at = anchors(word_hashes(data, starts, ends), row, row_ends, width)
            if not len(keys):
                continue
            order = np.argsort(keys, kind="stable")
            keys, at = keys[order], at[order]
            once = np.concatenate(([True], (keys[1:] != keys[:-1]) | (at[1:] != at[:-1])))
            keys, at = keys[once], at[once]
            # what the block itself holds twice is shared: it is sent once, for others, and the places go straight to the block
            heads = segments(keys)
            times = np.diff(np.append(heads, len(keys)))
            own = at[np.repeat(times > 1, times)]
            keys, at = keys[heads], np.where(times > 1, NOWHERE, at[heads])
            bucket = bucket_of(keys, buckets)
            cuts = segments(bucket)
            limits = np.append(cuts, len(keys))
            rows = [(block, int(bucket[a]), 0, pack_keys(keys[a:b]), at[a:b].astype("<u4").tobytes()) for a, b in zip(limits[:-1], limits[1:], strict=True)]
            about = np.stack([_column(batch, "row_key").astype(np.int64), _column(batch, "id"), first, number])
            rows.append((block, -1 - block % buckets, 0, about.astype("<i8").tobytes(), own.astype("<u4").tobytes()))
            yield pa.RecordBatch.from_pylist([dict(zip(("block", "bucket", "first", "keys", "more"), r, strict=True)) for r in rows], schema=_MESSAGE)

    return emit


_MESSAGE = pa.schema([("block", pa.int64()), ("bucket", pa.int64()), ("first", pa.int32()), ("keys", pa.binary()), ("more", pa.binary())])


def _shared_anchors(messages: pd.DataFrame) -> pd.DataFrame:
    """What keys of one bucket stand at several places: back to their blocks. Messages about rows pass."""
    if messages["bucket"].iat[0] < 0:
        return messages
    keys = np.concatenate([unpack_keys(k) for k in messages["keys"]])
    sizes = [len(k) // 4 for k in messages["keys"]]
    order = np.argsort(keys, kind="stable")
    starts = segments(keys[order])
    number = np.diff(np.append(starts, len(keys)))
    shared = np.zeros(len(keys), dtype=bool)
    shared[order] = np.repeat(number > 1, number)
    out, a = [], 0
    for block, more, size in zip(messages["block"], messages["more"], sizes, strict=True):
        at = np.frombuffer(more, "<u4")[shared[a : a + size]]
        at = at[at != NOWHERE]
        a += size
        if len(at):
            out.append((block, 0, 0, None, at.tobytes()))
    return pd.DataFrame(out, columns=["block", "bucket", "first", "keys", "more"])


def _rows_with_shared(messages: pd.DataFrame) -> pd.DataFrame:
    """The shared anchors of a block, row by row."""
    about = messages[messages["keys"].notna()]["keys"].iat[0]
    row_key, id_, first, number = np.frombuffer(about, "<i8").reshape(4, -1)
    at = [np.frombuffer(m, "<u4") for m in messages["more"] if m is not None]
    at = np.concatenate(at).astype(np.int64)
    if not len(at):
        return pd.DataFrame({"id": [], "row_key": [], "at": []})
    word = at & (_ALONE - 1)
    row = np.searchsorted(first + number, word, "right")
    local = (word - first[row]) | (at & _ALONE)
    order = np.argsort(row, kind="stable")
    row, local = row[order], local[order]
    starts = segments(row)
    return pd.DataFrame(
        {"id": id_[row[starts]], "row_key": row_key[row[starts]], "at": [x.astype("<u4").tobytes() for x in np.split(local, starts[1:])]}
    )


def _window_messages(width: int, buckets: int) -> Callable:
    """Windows with a shared anchor: each name once per block with its smallest document, and where it stands."""

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids = block_ids()
        for batch, data, offsets in text_blocks(batches):
            block = next(ids)
            starts, ends, row, number, first, row_ends = _words_of(data, offsets)
            hashes = word_hashes(data, starts, ends)
            windows, _, at = anchors(hashes, row, row_ends, width)
            shared = batch.column(batch.schema.get_field_index("at")).to_pylist()
            wanted = []
            for n, own in enumerate(shared):
                if own:
                    own = np.frombuffer(own, "<u4").astype(np.int64)
                    wanted.append((own & (_ALONE - 1)) + first[n] | (own & _ALONE))
            windows = windows[np.isin(at, np.concatenate(wanted))] if wanted else windows[:0]
            if not len(windows):
                continue
            one, two = window_hashes(hashes, width, 0)[windows], window_hashes(hashes, width, 1)[windows]
            id_ = _column(batch, "id")[row[windows]]
            order = np.lexsort((id_, two, one))
            new = np.concatenate(([True], (one[order][1:] != one[order][:-1]) | (two[order][1:] != two[order][:-1])))
            name = np.empty(len(windows), np.int64)
            name[order] = np.cumsum(new) - 1
            one, two, least = one[order][new], two[order][new], id_[order][new]
            bucket = bucket_of(one, buckets)
            limits = np.append(segments(bucket), len(one))
            rows = [
                (block, int(bucket[a]), int(a), pack_keys(one[a:b]) + two[a:b].astype("<u8").tobytes(), least[a:b].astype("<i8").tobytes())
                for a, b in zip(limits[:-1], limits[1:], strict=True)
            ]
            about = np.stack([_column(batch, "row_key"), _column(batch, "id")]).astype("<i8").tobytes()
            runs = segments(windows - np.arange(len(windows)) + row[windows] * len(hashes))
            at = windows - first[row[windows]]
            place = np.stack([row[windows[runs]], at[runs], np.diff(np.append(runs, len(windows)))])
            rows.append((block, -1 - block % buckets, place.shape[1], about + place.astype("<i8").tobytes(), name.astype("<u4").tobytes()))
            yield pa.RecordBatch.from_pylist([dict(zip(("block", "bucket", "first", "keys", "more"), r, strict=True)) for r in rows], schema=_MESSAGE)

    return emit


def _least_document(messages: pd.DataFrame) -> pd.DataFrame:
    """The smallest document of every window of a bucket, told to the blocks where it is new."""
    if messages["bucket"].iat[0] < 0:
        return messages
    sizes = [len(k) // 12 for k in messages["keys"]]
    one = np.concatenate([unpack_keys(k[: 4 * n]) for k, n in zip(messages["keys"], sizes, strict=True)])
    two = np.concatenate([np.frombuffer(k[4 * n :], "<u8") for k, n in zip(messages["keys"], sizes, strict=True)])
    least = np.concatenate([np.frombuffer(m, "<i8") for m in messages["more"]])
    order = np.lexsort((least, two, one))
    new = np.concatenate(([True], (one[order][1:] != one[order][:-1]) | (two[order][1:] != two[order][:-1])))
    found = np.empty(len(one), np.int64)
    found[order] = least[order][new][np.cumsum(new) - 1]
    out, a = [], 0
    for block, first, size in zip(messages["block"], messages["first"], sizes, strict=True):
        b = a + size
        out.append((block, 0, first, None, found[a:b].astype("<i8").tobytes()))
        a = b
    return pd.DataFrame(out, columns=["block", "bucket", "first", "keys", "more"])


def _marks(width: int) -> Callable:
    """Covered stretches of words of each row of a block: begins and ends."""

    def mark(messages: pd.DataFrame) -> pd.DataFrame:
        head = messages[messages["keys"].notna()]
        packed, runs = np.frombuffer(head["keys"].iat[0], "<i8"), 3 * int(head["first"].iat[0])
        row_key, id_ = packed[: len(packed) - runs].reshape(2, -1)
        row, at, length = packed[len(packed) - runs :].reshape(3, -1)
        row, at = np.repeat(row, length), np.repeat(at, length) + ranges(length)
        name = np.frombuffer(head["more"].iat[0], "<u4")
        least = np.full(int(name.max()) + 1, NO_ID, np.int64)
        answers = messages[messages["keys"].isna()]
        for first, more in zip(answers["first"], answers["more"], strict=True):
            told = np.frombuffer(more, "<i8")
            least[first : first + len(told)] = told
        hit = least[name] < id_[row]
        row, at = row[hit], at[hit]
        order = np.lexsort((at, row))
        row, at = row[order], at[order]
        if not len(row):
            return pd.DataFrame({"id": [], "row_key": [], "begins": [], "ends": []})
        new = np.concatenate(([True], (row[1:] != row[:-1]) | (at[1:] > at[:-1] + width)))
        starts = np.flatnonzero(new)
        begins, ends, of = at[starts], at[np.append(starts[1:], len(at)) - 1] + width, row[starts]
        cuts = segments(of)
        return pd.DataFrame(
            {
                "id": id_[of[cuts]], "row_key": row_key[of[cuts]],
                "begins": [x.astype("<i4").tobytes() for x in np.split(begins, cuts[1:])],
                "ends": [x.astype("<i4").tobytes() for x in np.split(ends, cuts[1:])],
            }
        )

    return mark


def _keyed(documents: DataFrame) -> DataFrame:
    """Rows as (other columns, id, row_key, text): the one shape that is shuffled, so that both joins share the shuffle."""
    return documents.select(
        whole_row(documents, ("text",)).alias("row"), F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID)).alias("id"),
        F.xxhash64("doc_id", "text").alias("row_key"), F.col("text").cast("binary").alias("text"),
    )


def _marked(keyed: DataFrame, width: int, buckets: int) -> DataFrame:
    """Rows with words under a window which also starts in a smaller document: begins and ends as packed 32-bit word numbers."""
    sent = keyed.select("id", "row_key", "text").mapInArrow(_anchor_messages(width, buckets), MESSAGE)
    told = sent.groupBy("bucket").applyInPandas(_shared_anchors, MESSAGE)
    shared = told.groupBy("block").applyInPandas(_rows_with_shared, "id long, row_key long, at binary")
    suspects = keyed.join(shared.dropDuplicates(["id", "row_key"]), ["id", "row_key"])
    sent = suspects.mapInArrow(_window_messages(width, buckets), MESSAGE)
    told = sent.groupBy("bucket").applyInPandas(_least_document, MESSAGE)
    marked = told.groupBy("block").applyInPandas(_marks(width), "id long, row_key long, begins binary, ends binary")
    return marked.dropDuplicates(["id", "row_key"])


def _kept(with_text: bool) -> Callable:
    """The text without the marked words, and the digest of the kept words joined by one space."""

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = {name: batch.column(i) for i, name in enumerate(batch.schema.names)}
            n_words, n_removed, digests, texts = [], [], [], []
            for text, begins, ends in zip(columns["text"], columns["begins"], columns["ends"], strict=True):
                raw = text.as_py()
                found = (raw or b"").split()
                kept, new = found, raw
                if begins.is_valid:
                    stretches = list(zip(np.frombuffer(begins.as_py(), "<i4").tolist(), np.frombuffer(ends.as_py(), "<i4").tolist(), strict=True))
                    outer = [0] + [x for stretch in stretches for x in stretch] + [len(found)]
                    kept = [word for b, e in zip(outer[::2], outer[1::2], strict=True) for word in found[b:e]]
                    new = _without(raw, stretches) if with_text else None
                n_words.append(len(found))
                n_removed.append(len(found) - len(kept))
                digests.append(hashlib.sha256(b" ".join(kept)).hexdigest())
                texts.append(new.decode() if with_text and new is not None else None)
            yield pa.record_batch(
                [columns["row"], pa.array(n_words, pa.int64()), pa.array(n_removed, pa.int64()), pa.array(digests, pa.string()), pa.array(texts, pa.string())],
                names=["row", "n_words", "n_removed", "kept_sha256", "text"],
            )

    return keep


def _without(raw: bytes, stretches: list[tuple[int, int]]) -> bytes:
    """A text without stretches of its words; the white space before each stretch stays, that after it goes."""
    data = np.frombuffer(raw, np.uint8)
    starts, _, _ = words(data, np.array([0, len(data)]))
    pieces, a = [], 0
    for b, e in stretches:
        pieces.append(raw[a : int(starts[b])])
        a = int(starts[e]) if e < len(starts) else len(raw)
    return b"".join([*pieces, raw[a:]])


def deduplicated(documents: DataFrame, width: int = WIDTH, with_text: bool = True) -> DataFrame:
    """Every document's other columns as a struct ``row``, n_words, n_removed, kept_sha256 and the text without repeats."""
    keyed = _keyed(documents)
    joined = keyed.join(_marked(keyed, width, bucket_count(documents)), ["id", "row_key"], "left").select("row", "text", "begins", "ends")
    kind = joined.schema["row"].dataType.simpleString()
    return joined.mapInArrow(_kept(with_text), f"row {kind}, n_words long, n_removed long, kept_sha256 string, text string")
