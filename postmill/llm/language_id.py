"""Language identification with string kernels.

The kernel of two texts is the number of byte n-grams of the blended spectrum (n = 2, 3, 4) which are present in both, divided by the
root of both numbers of n-grams. N-grams are hashed to ``SLOTS`` presence bits; A-Z are lower-cased, digits, ASCII punctuation and white
space read as one kind of gap. Landmarks drawn from the labelled sample give Nyström features; kernel ridge regression on these, one
language against the rest, is solved in closed form. Texts are scored in batches: presence matrix times landmark matrix times weights.

The classifier is fitted on a bounded sample: at most ``FIT_ROWS`` labelled texts, alike per language, the smallest hashes first; their bits
(4 KB each) reach the driver. Every text is predicted from its whole text. A text which is null or without a letter is ``und`` with score 0, as is
every text where nothing is labelled. Ties go to the language which sorts first. Rows repeat as they stand.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from postmill.llm.common import LOWER, text_blocks, whole_row
from postmill.operators.joins import first_per_key
from postmill.session import write_stage

ORDERS = (2, 3, 4)
SLOT_BITS = 15
SLOTS = 1 << SLOT_BITS
FIT_ROWS = 2400
PER_LANGUAGE = 400
LANDMARKS = 96
RIDGE = 1e-2
FLOOR = 0.5
BATCH_BYTES = 1 << 19
BATCH_ROWS = 192

_FOLD = LOWER.copy()
_FOLD[:0x80] = [c if 0x61 <= c <= 0x7A else 0x20 for c in _FOLD[:0x80]]
_FACTORS = {n: np.uint32(0x9E3779B1 + 2 * n * 0x01000193) for n in ORDERS}


def presence(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """For each row the presence of hashed n-grams, as zeros and ones."""
    rows = len(offsets) - 1
    out = np.zeros(rows * SLOTS, np.uint8)
    folded = _FOLD[data].astype(np.uint32)
    base = np.repeat(np.arange(rows, dtype=np.int64) * SLOTS, np.diff(offsets))
    left = np.repeat(offsets[1:], np.diff(offsets)) - np.arange(len(data))
    code = folded.copy()
    for n in range(2, max(ORDERS) + 1):
        code[: len(code) - n + 1] |= folded[n - 1 :] << np.uint32(8 * (n - 1)) if len(folded) >= n else 0
        if n in ORDERS:
            slot = (code * _FACTORS[n]) >> np.uint32(32 - SLOT_BITS)
            whole = left >= n
            out[(base + slot)[whole]] = 1
    return out.reshape(rows, SLOTS)


def _small_blocks(batches: Iterator[pa.RecordBatch]):
    for batch, data, offsets in text_blocks(batches, max_bytes=BATCH_BYTES):
        for a in range(0, batch.num_rows, BATCH_ROWS):
            b = min(a + BATCH_ROWS, batch.num_rows)
            yield batch.slice(a, b - a), data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a]


def _bits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch, data, offsets in _small_blocks(batches):
        bits = np.packbits(presence(data, offsets), axis=1)
        yield pa.record_batch([batch.column(0), pa.array([row.tobytes() for row in bits], pa.binary())], names=["lang", "bits"])


class Classifier:
    """Landmarks, weights and languages."""

    def __init__(self, languages: list[str], x: np.ndarray, y: np.ndarray, landmarks: int = LANDMARKS, ridge: float = RIDGE):
        order = np.concatenate([np.flatnonzero(y == n)[: -(-landmarks // len(languages))] for n in range(len(languages))])
        self.languages = languages
        self.marks = np.ascontiguousarray(x[order].T.astype(np.float32))
        self.lengths = np.sqrt(np.maximum(self.marks.sum(axis=0), 1))
        k_mm = self.kernel(x[order]).astype(np.float64)
        values, vectors = np.linalg.eigh((k_mm + k_mm.T) / 2)
        fine = values > 1e-6 * values.max()
        self.root = vectors[:, fine] / np.sqrt(values[fine])
        phi = np.concatenate([self.kernel(x[a : a + 256]).astype(np.float64) for a in range(0, len(x), 256)]) @ self.root
        share = np.bincount(y, minlength=len(languages))[y]
        w = 1.0 / share  # languages count alike
        targets = (y[:, None] == np.arange(len(languages))).astype(np.float64)
        solved = np.linalg.solve((phi * w[:, None]).T @ phi + ridge * len(languages) * np.eye(phi.shape[1]) / len(x), (phi * w[:, None]).T @ targets)
        self.weights = (self.root @ solved).astype(np.float32)
        self.floors = self._floors((phi @ solved).max(axis=1), x)

    @staticmethod
    def _floors(best: np.ndarray, x: np.ndarray) -> np.ndarray:
        """By the power of two of a text's n-grams: a share of the least score of the labelled texts of half that size or more."""
        size = np.array([int(n).bit_length() for n in x.sum(axis=1, dtype=np.int64)])
        return np.array([FLOOR * best[size >= min(k, size.max()) - 1].min() for k in range(SLOT_BITS + 2)])

    def unlike(self, x: np.ndarray, best: np.ndarray) -> np.ndarray:
        """Texts which score less than labelled texts of their size do."""
        return best < self.floors[[int(n).bit_length() for n in x.sum(axis=1, dtype=np.int64)]]

    def kernel(self, x: np.ndarray) -> np.ndarray:
        x = x.astype(np.float32)
        return x @ self.marks / (np.sqrt(np.maximum(x.sum(axis=1, keepdims=True), 1)) * self.lengths)

    def scores(self, x: np.ndarray) -> np.ndarray:
        return self.kernel(x) @ self.weights


def fit(documents: DataFrame, learn: Column, fit_rows: int = FIT_ROWS, per_language: int = PER_LANGUAGE) -> Classifier | None:
    """A classifier from rows with a language where ``learn`` holds; None without any."""
    spark = documents.sparkSession
    labelled = documents.where(learn & F.col("lang").isNotNull() & F.col("text").rlike(r"\p{L}")).select(
        F.col("lang").cast("string").alias("lang"), F.xxhash64("doc_id", "text").alias("h"), "text"
    )
    counts = write_stage(labelled.groupBy("lang").agg(F.count(F.lit(1)).alias("n")), "languages")
    number = counts.count()
    if not number:
        return None
    each = max(1, min(per_language, fit_rows // number))
    # of a frequent language only hashes below a limit can be among the smallest: four times as many as are wanted
    share = F.shiftrightunsigned("h", 1).cast("double") / F.lit(float(1 << 63))
    near = labelled.select("lang", "h").join(counts, "lang").where(share * F.col("n") < 4 * each + 40).select("lang", "h").distinct()
    chosen = first_per_key(near, ["lang"], [F.shiftrightunsigned("h", 1)], each)
    texts = labelled.join(F.broadcast(chosen), ["lang", "h"], "left_semi").dropDuplicates(["lang", "h"])
    rows = texts.select("lang", F.col("text").cast("binary").alias("text")).mapInArrow(_bits, "lang string, bits binary")
    rows = sorted((r["lang"], bytes(r["bits"])) for r in rows.collect())
    languages = sorted({lang for lang, _ in rows})
    x = np.unpackbits(np.frombuffer(b"".join(b for _, b in rows), np.uint8).reshape(len(rows), -1), axis=1)
    y = np.array([languages.index(lang) for lang, _ in rows])
    mixed = np.random.default_rng(5).permutation(len(rows))
    return Classifier(languages, x[mixed], y[mixed])


def _predict(shared, reject: bool) -> Callable:
    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for batch, data, offsets in _small_blocks(batches):
            lettered = batch.column(batch.schema.get_field_index("lettered")).to_numpy(zero_copy_only=False)
            names, best = np.full(batch.num_rows, "und", object), np.zeros(batch.num_rows)
            if model is not None:
                bits = presence(data, offsets)
                scores = model.scores(bits)
                if reject:
                    lettered = lettered & ~model.unlike(bits, scores.max(axis=1))
                names = np.where(lettered, np.array(model.languages, object)[scores.argmax(axis=1)], "und")
                best = np.where(lettered, np.clip(scores.max(axis=1), 0, 1), 0.0)
            yield pa.record_batch([batch.column(0), pa.array(names, pa.string()), pa.array(best, pa.float64())], names=["row", "lang_pred", "score"])

    return predict


def identified(documents: DataFrame, model: Classifier | None, keep: str = "doc_id", reject: bool = False) -> DataFrame:
    """Every document (the column ``keep``, or with "*" the whole row as a struct ``row``) with lang_pred and score.

    With ``reject``, texts unlike every learned language are ``und`` as well."""
    row = whole_row(documents) if keep == "*" else F.col(keep)
    lettered = F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False)).alias("lettered")
    texts = documents.select(row.alias("row"), lettered, F.coalesce(F.col("text"), F.lit("")).cast("binary").alias("text"))
    kind = texts.schema["row"].dataType.simpleString()
    return texts.mapInArrow(_predict(documents.sparkSession.sparkContext.broadcast(model), reject), f"row {kind}, lang_pred string, score double")


def held_out(doc_id: str = "doc_id") -> Column:
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % 4 == 2, F.lit(False))


def learned_from(doc_id: str = "doc_id") -> Column:
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % 4 != 2, F.lit(False))
