"""Mixing sources to target weights by iterative proportional fitting.

Documents are counted into cells (one per combination of the dimensions), weighted by tokens. Cell weights are scaled to each dimension's
target shares in turn until all fit. A document of a cell is then kept with a probability in proportion to target weight over own
weight, scaled so that the kept tokens meet the budget, and at most 1; the rest of the budget goes to the other cells. The
``weight`` of a kept document (target over probability) makes the weighted sample meet the targets. Sampling is a hash of id and text, so it
does not change on a retry, and equal rows share their fate.

Only the cell table is iterated, by Spark; sums of it reach the driver. Null values are a category of their own (``unknown``). Given columns named
like those added (``mix_…``) give way. Documents without words have no weight and are kept. An empty table gives no rows. Targets of values which do not occur are spread over the rest.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from postmill.llm.common import whole_row
from postmill.session import write_stage

SWEEPS = 50
TOLERANCE = 1e-6
BROADCAST_CELLS = 100_000


def targets_by_power(cells: DataFrame, dimension: str, power: float) -> DataFrame:
    """Target shares in proportion to a power of the tokens: below 1 it lifts what is rare."""
    sums = cells.groupBy(F.col(dimension).alias("value")).agg(F.sum("tokens").alias("tokens")).where("tokens > 0")
    return sums.select("value", F.pow(F.col("tokens").cast("double"), F.lit(power)).alias("target"))


def fitted(cells: DataFrame, dimensions: Sequence[str], targets: Mapping[str, DataFrame], sweeps: int = SWEEPS, tolerance: float = TOLERANCE) -> DataFrame:
    """Cells (dimensions, tokens) with ``weight``, their share under all targets together."""
    state = cells.where("tokens > 0")
    for d in dimensions:
        state = state.join(targets[d].select(F.col("value").alias(d), F.col("target").alias(f"target_{d}")), d)
    state = write_stage(state.withColumn("weight", F.col("tokens").cast("double")), "cells")
    if state.isEmpty():
        return state
    # shares over the values which occur
    whole = state.agg(F.sum("weight")).first()[0]
    totals = {d: state.select(d, f"target_{d}").distinct().agg(F.sum(f"target_{d}")).first()[0] for d in dimensions}
    state = state.select(
        *dimensions, "tokens", (F.col("weight") / F.lit(whole)).alias("weight"), *[(F.col(f"target_{d}") / F.lit(totals[d])).alias(f"target_{d}") for d in dimensions]
    )
    for _ in range(sweeps):
        off = F.lit(0.0)
        for d in dimensions:
            state = state.withColumn("_sum", F.sum("weight").over(Window.partitionBy(d)))
            off = F.greatest(off, F.abs(F.col(f"_was_{d}")))  # read after the sweep is written
            state = state.withColumn(f"_was_{d}", F.col("_sum") / F.col(f"target_{d}") - 1).withColumn("weight", F.col("weight") * F.col(f"target_{d}") / F.col("_sum"))
        state = write_stage(state, "cells")
        worst = state.agg(F.max(off)).first()[0]
        state = state.drop("_sum", *[f"_was_{d}" for d in dimensions])
        if worst < tolerance:
            break
    return state.select(*dimensions, "tokens", "weight")


def probabilities(cells: DataFrame, budget: float) -> DataFrame:
    """Cells with ``p``: min(1, c * target share / own share), where c makes the kept tokens ``budget`` of all."""
    total = cells.agg(F.sum("tokens")).first()[0] or 0
    lift = F.col("weight") * F.lit(float(total)) / F.col("tokens")
    scale = budget
    for _ in range(40):
        full = lift * F.lit(scale) >= 1
        row = cells.agg(F.sum(F.when(full, F.col("tokens"))).alias("full"), F.sum(F.when(~full, F.col("tokens") * lift)).alias("rest")).first()
        new = (budget * total - (row["full"] or 0)) / row["rest"] if row["rest"] else scale
        if abs(new - scale) <= 1e-9 * max(scale, 1e-9) or new <= scale:
            break
        scale = new
    return cells.withColumn("p", F.least(F.lit(1.0), lift * F.lit(scale))).withColumn("lift", lift)


def mixed(documents: DataFrame, dimensions: Mapping[str, object], tokens, targets, budget: float, seed: int = 17) -> DataFrame:
    """Every document with its dimensions, tokens, probability, weight and whether it is kept.

    ``dimensions`` maps names to columns, ``tokens`` is a column, ``targets`` maps names to functions of the cell table, or tables (value, target).
    """
    clash = {n: f"mix_{n}" for n in dimensions}
    own = (*clash.values(), "mix_tokens", "mix_probability", "mix_weight", "mix_kept")
    facts = documents.select(
        whole_row(documents, own).alias("row"), *[F.coalesce(c.cast("string"), F.lit("unknown")).alias(clash[n]) for n, c in dimensions.items()],
        F.coalesce(tokens, F.lit(0)).cast("long").alias("mix_tokens"),
        (F.shiftrightunsigned(F.xxhash64(F.lit(seed), "doc_id", "text"), 11).cast("double") / F.lit(float(1 << 53))).alias("chance"),
    )
    cells = write_stage(facts.groupBy(*clash.values()).agg(F.sum("mix_tokens").alias("tokens")), "cells")
    wanted = {clash[n]: t(cells, clash[n]) if callable(t) else t for n, t in targets.items()}
    fit = write_stage(probabilities(fitted(cells, list(clash.values()), wanted), budget).select(*clash.values(), "p", "lift"), "probabilities")
    known = F.broadcast(fit) if fit.count() <= BROADCAST_CELLS else fit
    met = facts.join(known, list(clash.values()), "left")
    p = F.when(F.col("mix_tokens") == 0, F.lit(1.0)).otherwise(F.coalesce("p", F.lit(1.0)))
    weight = F.when(F.col("mix_tokens") == 0, F.lit(0.0)).otherwise(F.coalesce(F.col("lift") / F.col("p"), F.lit(0.0)))
    return met.select("row.*", *clash.values(), "mix_tokens", p.alias("mix_probability"), weight.alias("mix_weight"), (F.col("chance") < p).alias("mix_kept"))


def words_in(text) -> object:
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(r"[^\x20\x09-\x0D]+"))


def topic(text, words) -> object:
    """A coarse topic from the shape of a text: tables, notes, articles, books."""
    return F.when(F.coalesce(text, F.lit("")).contains(" | "), "tables").when(words < 100, "notes").when(words < 1000, "articles").otherwise("books")


def standard_mix(documents: DataFrame, budget: float = 0.8) -> DataFrame:
    """The mix of the corpus: sources and languages lifted by the power 0.7, topics by 0.9."""
    words = words_in(F.col("text"))
    power = lambda x: lambda cells, d: targets_by_power(cells, d, x)
    return mixed(
        documents, {"source": F.col("source"), "lang": F.col("lang"), "topic": topic(F.col("text"), words)}, words,
        {"source": power(0.7), "lang": power(0.7), "topic": power(0.9)}, budget,
    )
