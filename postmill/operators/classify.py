"""Benefit phrases against few-shot categories by vector similarity."""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from postmill import fixed_values as fv
from postmill.operators.joins import lookup_by_key

MAX_PROTOTYPES = 20_000
RANKED = "array<struct<category:string,ord:int,score:double>>"
PROTOTYPE_SCHEMA = "category string, ord int, kind string, pos int, text string"


def prototype_texts(spark: SparkSession, prototypes: Sequence[tuple[str, list[str], str]] = fv.PROTOTYPES) -> DataFrame:
    """Examples and contexts of all categories as a table, ready for the embedding hook."""
    rows = []
    for n, (category, examples, context) in enumerate(prototypes):
        rows += [(category, n, "example", i, text) for i, text in enumerate(examples)]
        rows.append((category, n, "context", 0, context))
    return spark.createDataFrame(rows, PROTOTYPE_SCHEMA)


class Prototypes:
    """The embedded prototypes as matrices, in category order.

    Curated data of a checked size: it is read to the driver once and shipped
    with the scoring task. ``blocks`` cuts larger sets into several of that size.
    """

    def __init__(self, categories: list[str], ords: list[int], examples: list[np.ndarray], contexts: np.ndarray):
        self.categories, self.ords, self.examples, self.contexts = categories, ords, examples, contexts

    @classmethod
    def collect(cls, embedded: DataFrame, max_rows: int = MAX_PROTOTYPES) -> Prototypes:
        rows = embedded.select("category", "ord", "kind", "embedding").limit(max_rows + 1).collect()
        if len(rows) > max_rows:
            raise ValueError(f"more than {max_rows} prototypes; cut them with Prototypes.blocks() and use score_blocks()")
        return cls._of_rows(rows)

    @classmethod
    def blocks(cls, embedded: DataFrame, max_rows: int = MAX_PROTOTYPES) -> Iterator[Prototypes]:
        """Sets of at most ``max_rows`` examples each, read one after the other.

        Examples are dealt over the blocks in turn by category; each block brings the contexts of its categories. A category
        may stand in several blocks: its score is the largest of theirs.
        """
        examples = embedded.where(F.col("kind") == "example")
        number = examples.count()
        blocks = -(-number // max_rows) or 1
        place = F.row_number().over(Window.partitionBy("ord").orderBy(F.xxhash64("embedding"))) + F.col("ord")
        dealt = examples.withColumn("block", F.pmod(place, F.lit(blocks)))
        for block in range(blocks):
            mine = dealt.where(F.col("block") == block).drop("block")
            contexts = embedded.where(F.col("kind") == "context").join(F.broadcast(mine.select("ord").distinct()), "ord", "left_semi")
            rows = mine.unionByName(contexts).select("category", "ord", "kind", "embedding").collect()
            if rows:
                yield cls._of_rows(rows)

    @classmethod
    def _of_rows(cls, rows: list) -> Prototypes:
        ords = sorted({(r["ord"], r["category"]) for r in rows})
        examples, contexts = [], []
        for n, category in ords:
            mine = [r for r in rows if r["category"] == category]
            examples.append(_unit_rows([r["embedding"] for r in mine if r["kind"] == "example"]))
            contexts.append(_unit_rows([r["embedding"] for r in mine if r["kind"] == "context"])[0])
        return cls([c for _, c in ords], [n for n, _ in ords], examples, np.array(contexts))


def _unit_rows(vectors) -> np.ndarray:
    """Rows scaled to length one; a zero row stays zero, so that its cosine is 0."""
    matrix = np.array([np.asarray(v, dtype=np.float64) for v in vectors])
    lengths = np.linalg.norm(matrix, axis=1, keepdims=True)
    return np.divide(matrix, lengths, out=np.zeros_like(matrix), where=lengths > 0)


def _scores(prototypes: Prototypes, vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    unit = _unit_rows(vectors)
    direct = np.stack([(unit @ e.T).max(axis=1) for e in prototypes.examples], axis=1)
    context = unit @ prototypes.contexts.T
    return direct, context, fv.DIRECT_WEIGHT * direct + fv.CONTEXT_WEIGHT * context


def score_all(phrases: DataFrame, prototypes: Prototypes, phrase: str = "phrase") -> DataFrame:
    """``(phrase, category, ord, direct, context, combined)``, one row per phrase and category.

    One matrix product per Arrow batch; no pairs of phrases and prototypes are made.
    """
    field = phrases.schema[phrase]
    out = T.StructType(
        [field]
        + [T.StructField("category", T.StringType()), T.StructField("ord", T.IntegerType())]
        + [T.StructField(c, T.DoubleType()) for c in ("direct", "context", "combined")]
    )

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        width = len(prototypes.categories)
        for batch in batches:
            if len(batch):
                direct, context, combined = _scores(prototypes, batch["embedding"])
                yield pd.DataFrame(
                    {
                        phrase: np.repeat(batch[phrase].to_numpy(), width),
                        "category": prototypes.categories * len(batch),
                        "ord": prototypes.ords * len(batch),
                        "direct": direct.ravel(),
                        "context": context.ravel(),
                        "combined": combined.ravel(),
                    }
                )

    return phrases.select(phrase, "embedding").mapInPandas(run, out)


def score_ranked(phrases: DataFrame, prototypes: Prototypes, k: int = fv.TOP_K, phrase: str = "phrase") -> DataFrame:
    """Adds ``ranked``: the ``k`` best ``(category, ord, score)`` of each phrase, ties in category order.

    All other columns but the vector are kept.
    """
    kept = [f for f in phrases.schema.fields if f.name != "embedding"]
    ranked = T.ArrayType(
        T.StructType(
            [
                T.StructField("category", T.StringType()),
                T.StructField("ord", T.IntegerType()),
                T.StructField("score", T.DoubleType()),
            ]
        )
    )
    names = [f.name for f in kept]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            if len(batch):
                combined = _scores(prototypes, batch["embedding"])[2]
                best = np.argsort(-combined, axis=1, kind="stable")[:, :k]
                result = batch[names].copy()
                result["ranked"] = [
                    [
                        {"category": prototypes.categories[j], "ord": prototypes.ords[j], "score": float(row[j])}
                        for j in order
                    ]
                    for row, order in zip(combined, best)
                ]
                yield result

    embedded = phrases.where(F.col("embedding").isNotNull()).select(*names, "embedding")
    return embedded.mapInPandas(run, T.StructType(kept + [T.StructField("ranked", ranked)]))


def score_blocks(phrases: DataFrame, blocks: Iterable[Prototypes], k: int = fv.TOP_K, phrase: str = "phrase") -> DataFrame:
    """``score_ranked`` over prototypes in several blocks; the columns of the phrases are kept."""
    parts = [score_ranked(phrases.select(phrase, "embedding"), block, k, phrase) for block in blocks]
    rest = phrases.drop("embedding")
    merged = merge_ranked(parts, phrase, k)
    return rest.join(merged, phrase) if len(rest.columns) > 1 else merged


def merge_ranked(parts: Sequence[DataFrame], phrase: str = "phrase", k: int = fv.TOP_K) -> DataFrame:
    """Ranked lists of several prototype sets as one; a category of several sets counts with its largest score."""
    both = parts[0]
    for part in parts[1:]:
        both = both.unionByName(part)
    ordered = F.array_sort(
        F.flatten(F.collect_list("ranked")),
        lambda a, b: F.when(a["score"] > b["score"], -1).when(a["score"] < b["score"], 1)
        .when(a["ord"] < b["ord"], -1).when(a["ord"] > b["ord"], 1).otherwise(0),
    )
    merged = both.groupBy(phrase).agg(ordered.alias("_all"))
    first = F.filter("_all", lambda x, i: ~F.exists(F.slice("_all", 1, i), lambda y: y["ord"] == x["ord"]))
    return merged.select(phrase, F.slice(first, 1, k).alias("ranked"))


class PrototypeGroups:
    """Prototypes of which most need not be looked at: the examples of each category in groups around a centre, with the widest angle to it.

    An example of a group at angle ``a`` from a vector lies between ``a - radius`` and ``a + radius``. The bounds of all groups tell which
    categories can be among the ``k`` best, and which groups can hold their best example; only these are multiplied out.
    """

    SLACK = 1e-9

    def __init__(self, prototypes: Prototypes, rounds: int = 8, seed: int = 0):
        self.categories, self.ords, self.contexts = prototypes.categories, prototypes.ords, prototypes.contexts
        self.examples, centres, radii, owners = [], [], [], []
        for n, rows in enumerate(prototypes.examples):
            centre, member = _centres(rows, max(1, int(len(rows) ** 0.5)), rounds, np.random.default_rng(seed))
            for g in range(len(centre)):
                own = rows[member == g]
                if len(own):
                    self.examples.append(own)
                    centres.append(centre[g])
                    # a zero row has a cosine of 0 to anything, which no angle tells
                    zero = ~own.any(axis=1)
                    radii.append(np.pi if zero.any() else float(np.arccos(np.clip(own @ centre[g], -1, 1)).max()))
                    owners.append(n)
        self.centres, self.radii, self.owners = np.array(centres), np.array(radii), np.array(owners)
        self.firsts = np.flatnonzero(np.concatenate(([True], self.owners[1:] != self.owners[:-1])))

    def __len__(self) -> int:
        return sum(map(len, self.examples))

    def combined(self, vectors, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Combined scores per vector and category, -inf where a category cannot be among the ``k`` best; and how many examples each vector met."""
        unit = _unit_rows(vectors)
        angle = np.arccos(np.clip(unit @ self.centres.T, -1, 1))
        angle[~unit.any(axis=1)] = np.pi / 2
        upper, lower = np.cos(np.maximum(angle - self.radii, 0)) + self.SLACK, np.cos(np.minimum(angle + self.radii, np.pi)) - self.SLACK
        # a vector or example of zeros has a cosine of 0, whatever the angles say
        upper, lower = np.where(angle <= self.radii, np.maximum(upper, self.SLACK), upper), np.minimum(lower, np.where(self.radii >= np.pi, 0, lower))
        zero = ~unit.any(axis=1)
        upper[zero], lower[zero] = self.SLACK, -self.SLACK
        context = fv.CONTEXT_WEIGHT * (unit @ self.contexts.T)
        most = fv.DIRECT_WEIGHT * np.maximum.reduceat(upper, self.firsts, axis=1) + context
        least = fv.DIRECT_WEIGHT * np.maximum.reduceat(lower, self.firsts, axis=1) + context
        k = min(k, most.shape[1])
        alive = most >= np.partition(least, -k, axis=1)[:, -k][:, None]
        direct, met = np.full(most.shape, -np.inf), np.zeros(len(unit), np.int64)
        # each vector meets its most promising group of a category first, so that the others meet a high mark; then each group meets all
        # vectors it may still matter to in one product
        for first, end in zip(self.firsts, [*self.firsts[1:], len(self.owners)], strict=True):
            own = self.owners[first]
            best = first + upper[:, first:end].argmax(axis=1)
            for g in np.unique(best[alive[:, own]]):
                self._meet(np.flatnonzero(alive[:, own] & (best == g)), own, g, unit, direct, met)
            for g in first + np.argsort(-upper[:, first:end].max(axis=0)):
                self._meet(np.flatnonzero(alive[:, own] & (best != g) & (upper[:, g] >= direct[:, own])), own, g, unit, direct, met)
        return np.where(alive, fv.DIRECT_WEIGHT * direct + context, -np.inf), met

    def _meet(self, rows: np.ndarray, own: int, group: int, unit: np.ndarray, direct: np.ndarray, met: np.ndarray) -> None:
        """Multiply out a group for some vectors."""
        if len(rows):
            direct[rows, own] = np.maximum(direct[rows, own], (unit[rows] @ self.examples[group].T).max(axis=1))
            met[rows] += len(self.examples[group])


def _centres(rows: np.ndarray, number: int, rounds: int, rng: np.random.Generator) -> tuple[np.ndarray, np.ndarray]:
    """Unit centres and the centre nearest to each row, by rounds of nearest centre and mean."""
    centres = rows[rng.choice(len(rows), number, replace=False)]
    for _ in range(rounds):
        member = (rows @ centres.T).argmax(axis=1)
        sums = np.zeros_like(centres)
        np.add.at(sums, member, rows)
        lengths = np.linalg.norm(sums, axis=1, keepdims=True)
        centres = np.where(lengths > 0, sums / np.where(lengths > 0, lengths, 1), centres)
    return centres, (rows @ centres.T).argmax(axis=1)


def score_pruned(phrases: DataFrame, groups: PrototypeGroups, k: int = fv.TOP_K, phrase: str = "phrase", rows: int = 1024) -> DataFrame:
    """``score_ranked`` with equal results, and ``products``, the number of examples which were multiplied out, in place of all of them.

    The phrases are dealt out, as a row costs more the more prototypes there are: a task holds the phrases of two batches or so, however many come.
    """
    kept = [f for f in phrases.schema.fields if f.name != "embedding"]
    names = [f.name for f in kept]
    schema = T.StructType([*kept, T.StructField("ranked", T._parse_datatype_string(RANKED)), T.StructField("products", T.LongType())])

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for whole in batches:
            for a in range(0, len(whole), rows):
                batch = whole.iloc[a : a + rows]
                combined, met = groups.combined(batch["embedding"], k)
                best = np.argsort(-combined, axis=1, kind="stable")[:, :k]
                result = batch[names].copy()
                result["ranked"] = [
                    [{"category": groups.categories[j], "ord": groups.ords[j], "score": float(row[j])} for j in order] for row, order in zip(combined, best, strict=True)
                ]
                result["products"] = met
                yield result

    embedded = phrases.where(F.col("embedding").isNotNull()).select(*names, "embedding")
    tasks = max(phrases.sparkSession.sparkContext.defaultParallelism, -(-embedded.count() // (2 * rows)))
    return embedded.repartition(tasks).mapInPandas(run, schema)


def max_per_category(scores: DataFrame, phrase: str = "phrase", score: str = "score") -> DataFrame:
    """Highest score per phrase and category."""
    return scores.groupBy(phrase, "category").agg(F.max(score).alias(score))


def decide(ranked: DataFrame, threshold: float = fv.THRESHOLD) -> DataFrame:
    """Adds ``best_category``, ``best_score``, ``assigned``.

    Only scores above 0 can be best, and only those strictly above the threshold are assigned.
    """
    top = F.get("ranked", F.lit(0))
    positive = F.coalesce(top["score"] > 0, F.lit(False))
    decided = ranked.withColumns(
        {
            "best_category": F.when(positive, top["category"]),
            "best_score": F.when(positive, top["score"]).otherwise(F.lit(0.0)),
        }
    )
    return decided.withColumn("assigned", (F.col("best_score") > threshold).cast("int"))


def score_log(decided: DataFrame, threshold: float = fv.THRESHOLD, phrase: str = "phrase", k: int = fv.TOP_K) -> DataFrame:
    """The wide log row of each phrase; missing ranks are NULL."""
    ranks = []
    for n in range(k):
        entry = F.get("ranked", F.lit(n))
        ranks += [entry["category"].alias(f"top_{n + 1}_category"), entry["score"].alias(f"top_{n + 1}_score")]
    return decided.select(
        F.col(phrase).alias("incentive"), *ranks, "best_category", "best_score", F.lit(threshold).alias("threshold"), "assigned"
    )


def classify_distinct(
    occurrences: DataFrame,
    vectors: DataFrame,
    prototypes: Prototypes,
    spread_by: Sequence[str],
    threshold: float = fv.THRESHOLD,
    phrase: str = "phrase",
    **options,
) -> DataFrame:
    """Adds the decision to every phrase occurrence; every distinct phrase is scored once."""

    def answer(distinct: DataFrame) -> DataFrame:
        embedded = distinct.join(vectors.select(phrase, "embedding"), phrase, "left")
        return decide(score_ranked(embedded, prototypes, phrase=phrase), threshold).drop("ranked")

    return lookup_by_key(occurrences, phrase, answer, spread_by, **options)


def flags_and_unmatched(
    decided: DataFrame,
    by: Sequence[str],
    categories: Sequence[str] = fv.FLAG_COLUMNS,
    dropped: str = fv.DROPPED_CATEGORY,
    phrase: str = "phrase",
    pos: str = "pos",
) -> DataFrame:
    """Per posting: one 0/1 flag per category, and the phrases under the threshold in order.

    A phrase which the dropped category wins sets no flag and is not unmatched.
    The categories are fixed, so flags are plain conditional maxima of one aggregation.
    """
    won = F.coalesce(F.col("assigned"), F.lit(0)) == 1
    counted = won & (F.col("best_category") != dropped)
    flags = [
        F.coalesce(F.max(F.when(counted & (F.col("best_category") == c), 1)), F.lit(0)).alias(c) for c in categories
    ]
    unmatched = F.array_sort(F.collect_list(F.when(~won, F.struct(F.col(pos), F.col(phrase)))))
    return decided.groupBy(*by).agg(
        *flags, F.array_join(F.transform(unmatched, lambda u: u[phrase]), "; ").alias(fv.UNMATCHED_COLUMN)
    )


def phrase_rows(df: DataFrame, keys: Sequence[str], direct: str = "direct_benefits", found: str = "phrases") -> DataFrame:
    """One row per phrase of a posting: listed benefits first, then the ones found in answers."""
    both = F.concat(F.coalesce(direct, F.array().cast("array<string>")), F.coalesce(found, F.array().cast("array<string>")))
    rows = df.select(*keys, F.posexplode_outer(both).alias("pos", "phrase"))
    return rows.where(F.col("phrase").isNotNull())
