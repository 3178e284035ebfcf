"""Language-model scores by context-tree weighting over bytes, beside a word-frequency base.

A text is read as its words (A-Z lower-cased) joined by one space, with an end byte that no text holds. Every byte is eight
binary decisions, each in a tree of its own, whose contexts are the 0 to ``depth`` bytes before. Each node estimates its bit by
Krichevsky-Trofimov counts; weighting gives a node the share ``P_e / (P_e + product of its children's P_w)``, and what is left goes
to the next longer context. Weights and counts come from the training texts and stay fixed while scoring, the sum of all
bits' logarithms is the score. Where a longer context was never seen, the longest seen one takes what is left.

Counts cover all training texts. A block of texts sends its distinct byte strings of ``depth + 1`` with their counts to buckets, dealt by
the latest ``TOP`` bytes of the context, so that all longer contexts below these stand in one bucket. Buckets add up counts and weigh their
subtrees; the driver gathers the nodes of ``TOP`` bytes only, weighs the short contexts above and hands back what those leave to each. With
that each bucket predicts every string of a block, and answers the block. Only the blocks are written; their strings are made from them once
for the counts and again for the answers, as they take more disk than the texts. Predictions of at most ``HEAD`` frequent strings go to the
tasks, so that blocks ask for the rarer ones only. No context is dropped; ``MAX_GRAMS`` is how many strings a bucket takes up at a time. Word counts of at most ``HEAD`` frequent words go to the tasks; rarer words meet their counts in a shuffle, so
that each token is exact.

Null and empty texts are the end alone. Rows with equal ids are scored each. Rows without an id are held out. With no training texts
each bit has probability 1/2. Texts have no length limit.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from functools import partial

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from postmill.llm.common import LOWER, bucket_count, bucket_of, block_ids, ranges, segments, text_blocks, word_hashes, words
from postmill.session import shuffles_removed, write_stage

DEPTH = 6
TOP = 3
MAX_GRAMS = 400_000
HEAD = 500_000
GRAM_SHARE = 8
END = 0xFF
PIECE = 1 << 19
LEVELS = 40
NO_ID = (1 << 63) - 1

MESSAGE = "kind int, block long, bucket long, first int, keys binary, more binary"
_MESSAGE = pa.schema(
    [("kind", pa.int32()), ("block", pa.int64()), ("bucket", pa.int64()), ("first", pa.int32()), ("keys", pa.binary()), ("more", pa.binary())]
)
WORDS, GRAMS, TEXT, ABOUT = 0, 1, 2, 3
COUNTED = -1


def byte_stream(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, row: np.ndarray, rows: int):
    """The words of each row joined by spaces, each row closed by the end byte: bytes and the limits of rows."""
    empty = np.setdiff1d(np.arange(rows), row)
    at = np.searchsorted(row, empty)
    starts, ends, row = np.insert(starts, at, 0), np.insert(ends, at, 0), np.insert(row, at, empty)
    lengths = ends - starts + 1
    limits = np.cumsum(lengths)
    out = np.empty(int(limits[-1]) if len(limits) else 0, np.uint8)
    place = ranges(lengths - 1)
    out[np.repeat(limits - lengths, lengths - 1) + place] = LOWER[data[np.repeat(starts, lengths - 1) + place]]
    last = np.append(row[1:] != row[:-1], True)
    out[limits - 1] = np.where(last, END, 0x20)
    return out, np.concatenate(([0], limits[last]))


def gram_codes(stream: np.ndarray, limits: np.ndarray, depth: int, a: int, b: int) -> np.ndarray:
    """For each byte from a to b: the bytes before it, latest first, and itself, as one number. Before a text stand end bytes."""
    back = max(0, a - depth)
    part = stream[back:b].astype(np.uint64)
    inner = limits[(limits > back) & (limits < b)] - back
    n = b - a
    code = np.zeros(n, np.uint64)
    for k in range(1, depth + 1):
        shifted = np.full(n, END, np.uint64)
        skip = max(0, k - (a - back))
        shifted[skip:] = part[a - back - k + skip : a - back - k + n]
        code = code << np.uint64(8) | shifted
    code = code << np.uint64(8) | part[a - back :]
    for j in range(depth):  # the first bytes of a text look back over its begin
        at = inner + j - (a - back)
        at = at[(at >= 0) & (at < n)]
        reach = depth - j
        mask = np.uint64(((1 << (8 * reach)) - 1) << 8)
        code[at] |= mask
    return code


def _message(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_pylist([dict(zip(_MESSAGE.names, r, strict=True)) for r in rows], schema=_MESSAGE)


def _squeeze(data: bytes) -> bytes:
    return len(data).to_bytes(8, "little") + pa.compress(data, codec="zstd", asbytes=True)


def _widen(packed: bytes) -> bytes:
    size = int.from_bytes(packed[:8], "little")
    return pa.decompress(packed[8:], decompressed_size=size, codec="zstd", asbytes=True) if size else b""


def _pack(values: np.ndarray) -> bytes:
    """64-bit numbers as the bytes of their differences, place by place."""
    steps = np.diff(values.astype("<u8"), prepend=np.uint64(0))
    return _squeeze(np.ascontiguousarray(steps.view(np.uint8).reshape(-1, 8).T).tobytes())


def _unpack(packed: bytes) -> np.ndarray:
    planes = np.frombuffer(_widen(packed), np.uint8).reshape(8, -1)
    return np.cumsum(np.ascontiguousarray(planes.T).view("<u8").ravel(), dtype=np.uint64)


def _pack_counts(number: np.ndarray) -> bytes:
    """Counts, place by place: most are small, so that nearly all places but the lowest are zero."""
    return _squeeze(np.ascontiguousarray(number.astype("<i8").view(np.uint8).reshape(-1, 8).T).tobytes())


def _unpack_counts(packed: bytes) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(_widen(packed), np.uint8).reshape(8, -1).T).view("<i8").ravel()


def _floats(packed: bytes) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(_widen(packed), np.uint8).reshape(4, -1).T).view("<f4").ravel()


def _all_codes(stream: np.ndarray, limits: np.ndarray, depth: int) -> np.ndarray:
    return np.concatenate([gram_codes(stream, limits, depth, a, min(a + PIECE, len(stream))) for a in range(0, len(stream), PIECE)])


def _dealt(keys: np.ndarray, depth: int, buckets: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Strings by bucket: their order, the buckets, and the limits of each."""
    bucket = bucket_of(_spread(keys >> np.uint64(8 * (depth + 1 - min(TOP, depth)))), buckets)
    order = np.argsort(bucket, kind="stable")
    edges = segments(bucket[order])
    return order, bucket[order][edges], np.append(edges, len(keys))


def _words(buckets: int) -> Callable:
    """Of each block: the counts of its words in training texts."""

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids = block_ids()
        for batch, data, offsets in text_blocks(batches):
            block = next(ids)
            starts, ends, row = words(data, offsets)
            learned = ~_column(batch, "held_out").astype(bool)[row]
            found, number = np.unique(word_hashes(LOWER[data], starts[learned], ends[learned]), return_counts=True)
            bucket = bucket_of(found, buckets)
            edges = np.append(segments(bucket), len(found))
            yield _message([
                (WORDS, block, int(bucket[a]), 0, found[a:b].astype("<u8").tobytes(), number[a:b].astype("<i8").tobytes())
                for a, b in zip(edges[:-1], edges[1:], strict=True)
            ])

    return emit


def _column(batch: pa.RecordBatch, name: str) -> np.ndarray:
    return batch.column(batch.schema.get_field_index(name)).to_numpy(zero_copy_only=False).astype(np.int64)


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Texts in blocks: their bytes, and id, held_out and end of each."""
    ids = block_ids()
    for batch, data, offsets in text_blocks(batches):
        stream, limits = byte_stream(data, *words(data, offsets), batch.num_rows)
        about = np.stack([_column(batch, "id"), _column(batch, "held_out"), limits[1:]])
        yield _message([(TEXT, next(ids), -1, 0, _squeeze(stream.tobytes()), about.astype("<i8").tobytes())])


def _strings(depth: int, gram_buckets: int, head=None) -> Callable:
    """Of each block: the distinct byte strings of training texts with their counts; with ``head`` those of all texts which it lacks, to be asked for."""

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block, text, about in zip(*(batch.column(n) for n in range(3)), strict=True):
                _, held, limits = np.frombuffer(about.as_py(), "<i8").reshape(3, -1)
                limits = np.append(0, limits)
                codes = _all_codes(np.frombuffer(_widen(text.as_py()), np.uint8), limits, depth)
                if head is None:
                    codes = codes[np.repeat(held == 0, np.diff(limits))]
                codes.sort()
                starts = segments(codes)
                keys, number = codes[starts], np.diff(starts, append=len(codes))
                if head is not None:
                    keys = keys[~_found(head.value[0], keys)[0]]
                order, bucket, edges = _dealt(keys, depth, gram_buckets)
                keys = keys[order]
                number = number[order] if head is None else None
                yield _message([
                    (GRAMS, block.as_py(), int(n), 0, _pack(keys[a:b]), None if number is None else _pack_counts(number[a:b]))
                    for n, a, b in zip(bucket, edges[:-1], edges[1:], strict=True)
                ])

    return emit


def _found(table: np.ndarray, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Which keys stand in a sorted table, and where."""
    if not len(table):
        return np.zeros(len(keys), bool), np.zeros(len(keys), np.int64)
    at = np.minimum(np.searchsorted(table, keys), len(table) - 1)
    return table[at] == keys, at


def _spread(keys: np.ndarray) -> np.ndarray:
    keys = keys * np.uint64(0x9E3779B97F4A7C15)
    return keys ^ (keys >> np.uint64(29)) * np.uint64(0xBF58476D1CE4E5B9)


def _summed(keys: np.ndarray, number: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = np.argsort(keys, kind="stable")
    keys, number = keys[order], number[order]
    starts = segments(keys)
    return keys[starts], np.add.reduceat(number, starts) if len(starts) else number


def _add(messages: pd.DataFrame) -> pd.DataFrame:
    keys = np.concatenate([np.frombuffer(k, "<u8") for k in messages["keys"]])
    number = np.concatenate([np.frombuffer(c, "<i8") for c in messages["more"]])
    keys, number = _summed(keys, number)
    return pd.DataFrame([(WORDS, COUNTED, messages["bucket"].iat[0], 0, keys.tobytes(), number.tobytes())], columns=_MESSAGE.names)


def _add_grams(max_grams: int) -> Callable:
    """Byte strings of training texts and their counts."""

    def add(messages: pd.DataFrame) -> pd.DataFrame:
        keys, number = np.zeros(0, np.uint64), np.zeros(0, np.int64)
        more, size = [(keys, number)], 0
        for n, (k, c) in enumerate(zip(messages["keys"], messages["more"], strict=True), 1):
            more.append((_unpack(k), _unpack_counts(c)))
            size += len(more[-1][0])
            if size >= max(max_grams, len(keys)) or n == len(messages):
                keys, number = _summed(*(np.concatenate(x) for x in zip((keys, number), *more, strict=True)))
                more, size = [], 0
        return pd.DataFrame([(GRAMS, COUNTED, messages["bucket"].iat[0], 0, _pack(keys), _pack_counts(number))], columns=_MESSAGE.names)

    return add


def _log_kt(n0: np.ndarray, n1: np.ndarray) -> np.ndarray:
    """Natural logarithm of the Krichevsky-Trofimov probability of n0 zeros and n1 ones."""
    return _lgamma_at(n0, 0.5) + _lgamma_at(n1, 0.5) - math.log(math.pi) - _lgamma_at(n0 + n1, 1.0)


def _lgamma_at(n: np.ndarray, plus: float) -> np.ndarray:
    """Of whole numbers plus 1/2 or 1; most of them are small and looked up."""
    small = n < len(_SMALL[plus])
    out = _SMALL[plus][np.where(small, n, 0).astype(np.int64)]
    out[~small] = _lgamma(n[~small] + plus)
    return out


def _lgamma(x: np.ndarray) -> np.ndarray:
    """Stirling's series, after moving the argument up by six."""
    x = x.astype(np.float64)
    shift = np.log(x) + np.log(x + 1) + np.log(x + 2) + np.log(x + 3) + np.log(x + 4) + np.log(x + 5)
    y = x + 6
    return (y - 0.5) * np.log(y) - y + 0.5 * math.log(2 * math.pi) + 1 / (12 * y) - 1 / (360 * y**3) + 1 / (1260 * y**5) - shift


_SMALL = {plus: _lgamma(np.arange(1 << 12) + plus) for plus in (0.5, 1.0)}


def _drop_oldest(keys: np.ndarray) -> np.ndarray:
    """The same byte (or node) in the context which is one byte shorter."""
    return (keys >> np.uint64(16)) << np.uint64(8) | keys & np.uint64(0xFF)


def _node(keys: np.ndarray, bit: int) -> np.ndarray:
    """The node of a bit: the context, and the bits of the byte before it."""
    return keys & ~np.uint64(0xFF) | np.uint64(1 << bit) | (keys & np.uint64(0xFF)) >> np.uint64(8 - bit)


def _ones(keys: np.ndarray, bit: int) -> np.ndarray:
    return (keys >> np.uint64(7 - bit) & np.uint64(1)).astype(bool)


def _leaves(keys: np.ndarray, number: np.ndarray, bit: int):
    """Nodes of the longest contexts: names, zeros, ones, and the logarithm of their estimate."""
    name = _node(keys, bit)
    starts = segments(name)
    if not len(starts):
        return name, np.zeros(0), np.zeros(0), np.zeros(0)
    n1 = np.add.reduceat(np.where(_ones(keys, bit), number, 0).astype(np.float64), starts)
    n0 = np.add.reduceat(number.astype(np.float64), starts) - n1
    return name[starts], n0, n1, _log_kt(n0, n1)


class Levels:
    """Nodes of a bit with contexts of ``depth`` bytes, weighted up to those of ``stop`` bytes."""

    def __init__(self, leaves, depth: int, stop: int):
        name, n0, n1, weighted = leaves
        self.depth, self.stop = depth, stop
        self.names, self.kt, self.share = {depth: name}, {depth: (n1 + 0.5) / (n0 + n1 + 1)}, {depth: np.ones(len(name))}
        self.up = {}
        for d in range(depth - 1, stop - 1, -1):
            name, up = np.unique(_drop_oldest(name), return_inverse=True)
            n0, n1, below = (np.bincount(up, x, len(name)) for x in (n0, n1, weighted))
            log_e = _log_kt(n0, n1)
            weighted = math.log(0.5) + np.logaddexp(log_e, below)
            self.names[d], self.up[d + 1] = name, up
            self.kt[d], self.share[d] = (n1 + 0.5) / (n0 + n1 + 1), np.exp(math.log(0.5) + log_e - weighted)
        self.top = name, n0, n1, weighted

    def down(self, given: np.ndarray, rest: np.ndarray):
        """Given what shorter contexts have said and left to the nodes of ``stop``: predictions by depth, and the same for the longest."""
        predicted = {}
        for d in range(self.stop, self.depth + 1):
            if d > self.stop:
                up = self.up[d]
                share = self.share[d - 1][up]
                given, rest = given[up] + rest[up] * share * self.kt[d - 1][up], rest[up] * (1 - share)
            predicted[d] = given + rest * self.kt[d]
        return predicted, given, rest


def _roots(depth: int) -> Callable:
    """Nodes of ``TOP`` bytes by bit: names, zeros, ones and weighted logarithms."""

    def roots(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k, c in zip(batch.column(0), batch.column(1), strict=True):
                keys, number = _unpack(k.as_py()), _unpack_counts(c.as_py())
                for bit in range(8):
                    top = Levels(_leaves(keys, number, bit), depth, min(TOP, depth)).top
                    yield pa.record_batch([pa.array([bit], pa.int32()), *(pa.array([x.tobytes()]) for x in top)], names=["bit", "name", "n0", "n1", "weighted"])

    return roots


def _short_contexts(counts: DataFrame, depth: int) -> list[tuple]:
    """By bit: names and predictions of contexts shorter than ``TOP``, and for each node of ``TOP`` bytes what these said and left to it."""
    stop = min(TOP, depth)
    found = counts.select("keys", "more").mapInArrow(_roots(depth), "bit int, name binary, n0 binary, n1 binary, weighted binary").toArrow()
    parts: list[list[tuple]] = [[] for _ in range(8)]
    for bit, *arrays in zip(*(found[c].to_pylist() for c in found.column_names), strict=True):
        parts[bit].append(tuple(np.frombuffer(x, t) for x, t in zip(arrays, ("<u8", "<f8", "<f8", "<f8"), strict=True)))
    out = []
    for own in parts:
        leaves = [np.concatenate(x) for x in zip(*own, strict=True)] if own else [np.zeros(0, np.uint64), *[np.zeros(0)] * 3]
        order = np.argsort(leaves[0])
        levels = Levels([x[order] for x in leaves], stop, 0)
        n = len(levels.names[0])
        predicted, given, rest = levels.down(np.zeros(n), np.ones(n))
        out.append(([(levels.names[d], predicted[d]) for d in range(stop)], levels.names[stop], given, rest))
    return out


class Subtrees:
    """Weighted predictions of a bucket's contexts, from its strings (in order), their counts and the contexts above."""

    def __init__(self, keys: np.ndarray, number: np.ndarray, depth: int, above: list[tuple]):
        self.depth, self.codes = depth, keys
        self.tables: list[list[tuple[np.ndarray, np.ndarray]]] = []
        logs = np.zeros(len(keys))
        for bit, (short, names, given, rest) in enumerate(above):
            levels = Levels(_leaves(keys, number, bit), depth, min(TOP, depth))
            at = np.searchsorted(names, levels.names[levels.stop])
            predicted, _, _ = levels.down(given[at], rest[at])
            self.tables.append([*short, *((levels.names[d], predicted[d]) for d in range(levels.stop, depth + 1))])
            p = predicted[depth][np.searchsorted(levels.names[depth], _node(keys, bit))]
            logs += np.log10(np.where(_ones(keys, bit), p, 1 - p))
        self.logs = logs.astype(np.float32)

    def score(self, codes: np.ndarray) -> np.ndarray:
        """log10 probability of each byte in its context."""
        out = np.zeros(len(codes), np.float32)
        known = np.zeros(len(codes), bool)
        if len(self.codes):
            at = np.minimum(np.searchsorted(self.codes, codes), len(self.codes) - 1)
            known = self.codes[at] == codes
            out[known] = self.logs[at[known]]
        rare, of = np.unique(codes[~known], return_inverse=True)
        out[~known] = self.by_path(rare)[of]
        return out

    def by_path(self, codes: np.ndarray) -> np.ndarray:
        """Bytes never seen in their context: each bit by the longest context which saw the bits before it."""
        total = np.zeros(len(codes))
        for bit in range(8):
            p = np.full(len(codes), 0.5)
            open_ = np.arange(len(codes))
            prefix = _node(codes & np.uint64(0xFF), bit)
            for d in range(self.depth, -1, -1):
                context = (codes >> np.uint64(8 * (self.depth - d + 1))) << np.uint64(8)
                keys, predicted = self.tables[bit][d]
                if not len(keys) or not len(open_):
                    continue
                name = (context | prefix)[open_]
                at = np.minimum(np.searchsorted(keys, name), len(keys) - 1)
                seen = keys[at] == name
                p[open_[seen]] = predicted[at[seen]]
                open_ = open_[~seen]
            total += np.log10(np.where(_ones(codes, bit), p, 1 - p))
        return total


def _frequent(shared, depth: int, least: int) -> Callable:
    """Training strings with a count of at least ``least``, and their predictions."""

    def frequent(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k, c in zip(batch.column(0), batch.column(1), strict=True):
                keys, number = _unpack(k.as_py()), _unpack_counts(c.as_py())
                keep = number >= least
                if keep.any():
                    logs = Subtrees(keys, number, depth, shared.value).logs
                    yield pa.record_batch([pa.array([keys[keep].tobytes()]), pa.array([logs[keep].tobytes()])], names=["keys", "logs"])

    return frequent


def _frequent_strings(counts: DataFrame, shared, depth: int, head: int) -> tuple[np.ndarray, np.ndarray]:
    """At most ``head`` strings in order, and their predictions."""
    least, _ = _totals(counts, _unpack_counts)
    cut = next((k for k in range(LEVELS) if least[k] <= head), LEVELS - 1)
    rows = counts.select("keys", "more").mapInArrow(_frequent(shared, depth, 1 << cut), "keys binary, logs binary").toArrow()
    keys, logs = (
        np.concatenate([np.zeros(0, t), *[np.frombuffer(x.as_py(), t) for x in rows[c]]]) for c, t in (("keys", np.uint64), ("logs", np.float32))
    )
    order = np.argsort(keys)
    return keys[order], logs[order]


def _predict(shared, depth: int, max_grams: int) -> Callable:
    """Predictions of the strings which blocks ask for, in the order they were sent."""

    def predict(messages: pd.DataFrame) -> pd.DataFrame:
        own = messages["block"] == COUNTED
        if own.all():
            return messages.iloc[:0]
        keys, number = np.zeros(0, np.uint64), np.zeros(0, np.int64)
        if own.any():  # strings of held-out texts may meet no training text
            keys, number = _unpack(messages[own]["keys"].iat[0]), _unpack_counts(messages[own]["more"].iat[0])
        tree = Subtrees(keys, number, depth, shared.value)
        out, asked, size = [], [], 0
        bucket, sent = messages["bucket"].iat[0], messages[~own]
        for n, (block, k) in enumerate(zip(sent["block"], sent["keys"], strict=True), 1):
            asked.append((block, _unpack(k)))
            size += len(asked[-1][1])
            if size >= max_grams or n == len(sent):
                logs = tree.score(np.concatenate([k for _, k in asked]))
                parts = np.split(logs, np.cumsum([len(k) for _, k in asked])[:-1])
                out += [(GRAMS, b, bucket, 0, None, _squeeze(np.ascontiguousarray(p.astype("<f4").view(np.uint8).reshape(-1, 4).T).tobytes())) for (b, _), p in zip(asked, parts, strict=True)]
                asked, size = [], 0
        return pd.DataFrame(out, columns=_MESSAGE.names)

    return predict


def _bases(shared, buckets: int) -> Callable:
    """Word scores of all rows; rare words go to their buckets, the rest of a block to the block."""

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        head_keys, head_logs, known_end, log_end = shared.value
        for batch in batches:
            for block, text, about in zip(*(batch.column(n) for n in range(3)), strict=True):
                block = block.as_py()
                id_, held, limits = np.frombuffer(about.as_py(), "<i8").reshape(3, -1)
                stream = np.frombuffer(_widen(text.as_py()), np.uint8)
                stream = np.where(stream == END, np.uint8(0x20), stream)
                starts, ends, row = words(stream, np.append(0, limits))
                found, of = np.unique(word_hashes(stream, starts, ends), return_inverse=True)
                at = np.minimum(np.searchsorted(head_keys, found), max(len(head_keys) - 1, 0))
                known = head_keys[at] == found if len(head_keys) else np.zeros(len(found), bool)
                value = np.where(known, head_logs[at] if len(head_keys) else 0.0, 0.0)
                rows = len(id_)
                base = np.bincount(row, value[of], rows) + log_end
                n_known = np.bincount(row, known[of], rows).astype(np.int64) + known_end
                n_tokens = np.bincount(row, minlength=rows) + 1
                rare, name = found[~known], np.cumsum(~known) - 1
                tail = np.flatnonzero(~known[of])
                pairs, number = np.unique(row[tail].astype(np.uint64) << np.uint64(32) | name[of[tail]].astype(np.uint64), return_counts=True)
                bucket = bucket_of(rare, buckets)
                edges = np.append(segments(bucket), len(rare))
                out = [(WORDS, block, int(bucket[a]), int(a), rare[a:b].tobytes(), None) for a, b in zip(edges[:-1], edges[1:], strict=True)]
                about = np.stack([n_tokens.astype(np.int64), n_known, base.view(np.int64)])
                out.append((ABOUT, block, -1 - block % buckets, len(rare), about.astype("<i8").tobytes(), np.stack([pairs.astype(np.int64), number]).astype("<i8").tobytes()))
                yield _message(out)

    return emit


def _look_up(messages: pd.DataFrame) -> pd.DataFrame:
    """Counts of the words which blocks ask for."""
    if messages["bucket"].iat[0] < 0:
        return messages
    own = messages["block"] == COUNTED
    out = []
    keys, counts = np.zeros(1, np.uint64), np.zeros(1, np.int64)
    if own.any():
        keys, counts = np.frombuffer(messages[own]["keys"].iat[0], "<u8"), np.frombuffer(messages[own]["more"].iat[0], "<i8")
    for block, bucket, first, asked in messages[~own][["block", "bucket", "first", "keys"]].itertuples(index=False):
        asked = np.frombuffer(asked, "<u8")
        at = np.minimum(np.searchsorted(keys, asked), len(keys) - 1)
        out.append((WORDS, block, bucket, first, None, np.where(keys[at] == asked, counts[at], 0).tobytes()))
    return pd.DataFrame(out, columns=_MESSAGE.names)


def _sum_up(head, log_all: float, depth: int, buckets: int) -> Callable:
    def sum_up(messages: pd.DataFrame) -> pd.DataFrame:
        of_kind = {kind: rows for kind, rows in messages.groupby("kind")}
        text, about = of_kind[TEXT].iloc[0], of_kind[ABOUT].iloc[0]
        id_, held, limits = np.frombuffer(text["more"], "<i8").reshape(3, -1)
        limits = np.append(0, limits)
        codes = _all_codes(np.frombuffer(_widen(text["keys"]), np.uint8), limits, depth)
        place = np.argsort(codes)
        codes = codes[place]
        starts = segments(codes)
        frequent, at = _found(head.value[0], codes[starts])
        told = np.empty(len(starts), np.float32)
        told[frequent] = head.value[1][at[frequent]]
        if GRAMS in of_kind:
            rare = np.flatnonzero(~frequent)
            order, _, _ = _dealt(codes[starts[rare]], depth, buckets)
            told[rare[order]] = np.concatenate([_floats(x) for x in of_kind[GRAMS].sort_values("bucket")["more"]])
        logs = np.empty(len(codes))
        logs[place] = np.repeat(told, np.diff(np.append(starts, len(codes))))
        score = np.add.reduceat(logs, limits[:-1])

        n_tokens, n_known, base = np.frombuffer(about["keys"], "<i8").reshape(3, -1)
        pairs, number = np.frombuffer(about["more"], "<i8").reshape(2, -1)
        row, name = pairs >> 32, pairs & 0xFFFFFFFF
        counts = np.zeros(int(about["first"]), np.int64)
        if WORDS in of_kind:
            for first, more in zip(of_kind[WORDS]["first"], of_kind[WORDS]["more"], strict=True):
                more = np.frombuffer(more, "<i8")
                counts[first : first + len(more)] = more
        c = counts[name]
        tail = np.bincount(row, number * np.log10(c + 0.5), len(id_))
        n_known = n_known + np.bincount(row, number * (c > 0), len(id_)).astype(np.int64)
        base = base.view(np.float64) + tail - n_tokens * log_all
        return pd.DataFrame({"id": id_, "held_out": held.astype(bool), "n_tokens": n_tokens, "n_known": n_known, "base_score": base, "score": score})

    return sum_up


def _figures(unpack: Callable) -> Callable:
    """How many words (or strings) have a count of at least 2^k, and the sum of counts."""

    def figures(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for c in batch.column(0):
                number = unpack(c.as_py())
                least = [int((number >= 1 << k).sum()) for k in range(LEVELS)]
                yield pa.record_batch([pa.array([least], pa.list_(pa.int64())), pa.array([int(number.sum())], pa.int64())], names=["least", "total"])

    return figures


def _totals(counts: DataFrame, unpack: Callable = partial(np.frombuffer, dtype="<i8")) -> tuple[list[int], int]:
    figures = counts.select("more").mapInArrow(_figures(unpack), "least array<long>, total long")
    sums = figures.agg(*[F.sum(F.col("least")[k]).alias(f"k{k}") for k in range(LEVELS)], F.sum("total").alias("total")).first()
    return [sums[f"k{k}"] or 0 for k in range(LEVELS)], sums["total"] or 0


def _collect(counts: DataFrame, least: int) -> tuple[np.ndarray, np.ndarray]:
    """Words with a count of at least ``least``; the caller has checked how many there are."""

    def strip(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k, c in zip(batch.column(0), batch.column(1), strict=True):
                keys, number = np.frombuffer(k.as_py(), "<u8"), np.frombuffer(c.as_py(), "<i8")
                keep = number >= least
                if keep.any():
                    yield pa.record_batch([pa.array([keys[keep].tobytes()]), pa.array([number[keep].tobytes()])], names=["keys", "counts"])

    rows = counts.select("keys", "more").mapInArrow(strip, "keys binary, counts binary").toArrow()
    parts = [(np.frombuffer(k.as_py(), "<u8"), np.frombuffer(c.as_py(), "<i8")) for k, c in zip(rows["keys"], rows["counts"], strict=True)]
    if not parts:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    keys, number = (np.concatenate(x) for x in zip(*parts, strict=True))
    order = np.argsort(keys)
    return keys[order], number[order]


def scores(documents: DataFrame, is_held_out, depth: int = DEPTH, max_grams: int = MAX_GRAMS, head: int = HEAD) -> DataFrame:
    """Scores of all documents, learned from those which ``is_held_out`` (a condition) does not hold back; ``head`` bounds the words and the strings
    that go to the tasks."""
    spark = documents.sparkSession
    buckets = bucket_count(documents)
    gram_buckets = -(-buckets // GRAM_SHARE)
    texts = documents.select(
        F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID)).alias("id"), F.coalesce(is_held_out, F.lit(True)).alias("held_out"),
        F.coalesce(F.col("text"), F.lit("")).cast("binary").alias("text"),
    )
    blocks = write_stage(texts.mapInArrow(_blocks, MESSAGE), "blocks")
    texts_of = blocks.select("block", "keys", "more")
    with shuffles_removed(spark):
        word_counts = write_stage(texts.mapInArrow(_words(buckets), MESSAGE).groupBy("bucket").applyInPandas(_add, MESSAGE), "words")
        strings = texts_of.mapInArrow(_strings(depth, gram_buckets), MESSAGE)
        counts = write_stage(strings.groupBy("bucket").applyInPandas(_add_grams(max_grams), MESSAGE), "counts")
    above = spark.sparkContext.broadcast(_short_contexts(counts, depth))
    frequent = spark.sparkContext.broadcast(_frequent_strings(counts, above, depth, head))
    n_ends = texts.where("not held_out").count()
    least, total = _totals(word_counts)
    n, v = total + n_ends, least[0] + (n_ends > 0)
    cut = next((k for k in range(LEVELS) if least[k] <= head), LEVELS - 1)
    keys, number = _collect(word_counts, 1 << cut)
    model = spark.sparkContext.broadcast((keys, np.log10(number + 0.5), int(n_ends > 0), math.log10(n_ends + 0.5)))
    asked = texts_of.mapInArrow(_bases(model, buckets), MESSAGE)
    told = asked.unionAll(word_counts).groupBy("bucket").applyInPandas(_look_up, MESSAGE)
    asked = texts_of.mapInArrow(_strings(depth, gram_buckets, frequent), MESSAGE)
    predicted = asked.unionAll(counts).groupBy("bucket").applyInPandas(_predict(above, depth, max_grams), MESSAGE)
    done = told.unionAll(predicted).unionAll(blocks).groupBy("block").applyInPandas(
        _sum_up(frequent, math.log10(n + 0.5 * (v + 1)), depth, gram_buckets),
        "id long, held_out boolean, n_tokens long, n_known long, base_score double, score double",
    )
    return done.select(F.nullif("id", F.lit(NO_ID)).alias("doc_id"), "held_out", "n_tokens", "n_known", F.lit(n).cast("long").alias("train_tokens"), "base_score", "score")
