"""Resharding by minimum-cost flow: the fewest bytes move from old shards into new capacities, then only affected files are rewritten.

Rows lie in old shards, each cut into blocks by hash; ``PER_FILE`` blocks after one another make a file. Rows of equal text (a group) share
a block, but those of more than ``HOT_BLOCKS`` blocks are spread by row, so that a hot group is no block of its own.

The flow runs from old shards (supply: their bytes) to new ones (demand: their capacity); a byte which stays costs nothing, one which
moves costs 1, or what a matrix says. It is solved on the driver over pairs of shards. Its amounts are then met by whole blocks: the few far
above the mean go one by one to where most is open, all others in order, so that a flow takes neighbouring blocks and cuts few files.
The driver holds one row per block: there are at most ``BLOCKS`` or the bytes of a shard over ``BLOCK_BYTES`` of them.
``rewrite`` writes the files which lost or gained a block; all other files stay as they are.

The law is ``bytes``: shard sizes differ by little more than a block, or than the longest text. Slots number the rows of a shard without gaps, block by block,
within a block by hash and id. Null texts have size 1. Rows without an id and repeated rows take part; repeated rows of one
id and text share a block. Extra columns stay as they are. An empty table gives no rows.
"""

from __future__ import annotations

import heapq
from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from postmill.llm.common import whole_row
from postmill.operators.joins import join_small
from postmill.session import work_path, write_stage

OLD_SHARDS, NEW_SHARDS = 6, 8
BLOCKS, BLOCK_BYTES, PER_FILE = 256, 256 << 20, 4
HOT_BLOCKS = 16
"""Groups of more than so many mean blocks are spread by row."""


def least_cost_flow(supply: Sequence[int], demand: Sequence[int], cost: np.ndarray) -> np.ndarray:
    """Units to send from each source to each target, all supply into all demand at least cost (successive shortest paths with potentials)."""
    n, m = len(supply), len(demand)
    flow = np.zeros((n, m), dtype=object)
    left, open_ = [int(s) for s in supply], [int(d) for d in demand]
    if sum(left) != sum(open_):
        raise ValueError("supply and demand differ")
    potential = [0] * (n + m)
    while any(left):
        distance: list[float] = [float("inf")] * (n + m)
        before = [-1] * (n + m)
        heap = []
        for i in range(n):
            if left[i]:
                distance[i] = 0
                heapq.heappush(heap, (0, i))
        while heap:
            d, v = heapq.heappop(heap)
            if d > distance[v]:
                continue
            # along an arc to any target, or back along one in use
            steps = ((n + j, int(cost[v, j])) for j in range(m)) if v < n else ((i, -int(cost[i, v - n])) for i in range(n) if flow[i, v - n])
            for w, c in steps:
                to = d + c + potential[v] - potential[w]
                if to < distance[w]:
                    distance[w], before[w] = to, v
                    heapq.heappush(heap, (to, w))
        end = min((n + j for j in range(m) if open_[j]), key=lambda v: distance[v] + potential[v])
        reach = distance[end]
        path = [end]
        while before[path[-1]] >= 0:
            path.append(before[path[-1]])
        amount = min(left[path[-1]], open_[end - n])
        for w, v in zip(path[:-1], path[1:], strict=True):
            if v >= n:
                amount = min(amount, flow[w, v - n])
        for w, v in zip(path[:-1], path[1:], strict=True):
            if v < n:
                flow[v, w - n] += amount
            else:
                flow[w, v - n] -= amount
        left[path[-1]] -= amount
        open_[end - n] -= amount
        for v in range(n + m):
            potential[v] += min(distance[v], reach)
    return flow


def capacities(total: int, weights: Sequence[int]) -> list[int]:
    """Whole capacities in proportion to ``weights`` which add up to ``total``."""
    ends = np.cumsum(weights)
    cuts = [total * int(e) // int(ends[-1]) for e in ends]
    return [b - a for a, b in zip([0, *cuts[:-1]], cuts, strict=True)]


def keyed(documents: DataFrame, old: Column, *more: Column) -> DataFrame:
    """id, size, text_crc32, old, group, tie (and ``more``): what the plan needs of the rows of ``documents``."""
    text = F.coalesce(F.col("text"), F.lit(""))
    return documents.select(
        F.col("doc_id").cast("long").alias("id"), (F.octet_length(text) + 1).cast("long").alias("size"), F.crc32(text.cast("binary")).alias("text_crc32"),
        old.cast("int").alias("old"), F.xxhash64("text").alias("group"), F.xxhash64("doc_id", "text").alias("tie"), *more,
    )


def block_sizes(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The blocks of each old shard (old, blocks), and the pieces (old, group, pieces) of hot groups."""
    sizes = write_stage(rows.groupBy("old", "group").agg(F.sum("size").alias("bytes")), "groups")
    number = F.greatest(F.lit(BLOCKS), F.ceil(F.sum("bytes") / BLOCK_BYTES))
    shards = write_stage(sizes.groupBy("old").agg(number.cast("int").alias("blocks"), F.ceil(F.sum("bytes") / number).alias("mean")), "shards")
    # there are fewer hot groups than blocks
    hot = sizes.join(F.broadcast(shards), "old").where(F.col("bytes") > HOT_BLOCKS * F.col("mean")).select("old", "group", F.ceil(F.col("bytes") / F.col("mean")).alias("pieces"))
    return shards.select("old", "blocks"), write_stage(hot, "hot")


def with_blocks(rows: DataFrame, shards: DataFrame, hot: DataFrame) -> DataFrame:
    """``rows`` with their block: by group, and by row in a hot group."""
    dealt = join_small(rows, hot, ["old", "group"]).join(F.broadcast(shards), "old")
    piece = F.pmod("tie", F.coalesce("pieces", F.lit(1).cast("long")))
    return dealt.withColumn("block", F.pmod(F.xxhash64("group", piece), "blocks").cast("int")).drop("pieces", "blocks", "group")


def transfers(blocks: pd.DataFrame, old_shards: int, new: Sequence[int], cost: np.ndarray | None = None) -> pd.DataFrame:
    """old, block, shard, first_slot for every block (old, block, bytes, rows): the flow between shards, met by whole blocks."""
    blocks = blocks.sort_values(["old", "block"], ignore_index=True)
    supply = np.bincount(blocks["old"], weights=blocks["bytes"], minlength=old_shards).astype(np.int64)
    if cost is None:
        cost = 1 - np.eye(old_shards, len(new), dtype=np.int64)
    flow = least_cost_flow(supply, capacities(int(supply.sum()), new), cost)
    shard = np.zeros(len(blocks), np.int64)
    over = np.zeros(len(new))
    for i in range(old_shards):
        own = np.flatnonzero(blocks["old"] == i)
        if not len(own):
            continue
        size = blocks["bytes"].to_numpy()[own]
        # what earlier shards sent beyond the flow is taken back here, as far as this flow goes
        open_ = np.maximum(flow[i].astype(np.float64) - np.where(flow[i] > 0, over, 0), 0)
        open_ *= size.sum() / max(open_.sum(), 1)
        large = size > 4 * size.mean()
        for at in sorted(np.flatnonzero(large), key=lambda k: (-size[k], k)):
            target = int(np.argmax(open_))
            shard[own[at]] = target
            open_[target] -= size[at]
        rest = np.flatnonzero(~large)
        smallest = rest[np.argsort(size[rest], kind="stable")]
        fine = smallest[np.cumsum(size[smallest]) * 10 <= size[rest].sum()]
        middle = np.setdiff1d(rest, fine)
        targets = np.array(sorted(range(len(new)), key=lambda j: (j != i, j)))
        ends = np.cumsum(np.maximum(open_[targets], 0))
        ends *= size[middle].sum() / max(ends[-1], 1)
        halfway = np.cumsum(size[middle]) - size[middle] / 2
        to = targets[np.minimum(np.searchsorted(ends, halfway, "right"), len(targets) - 1)]
        shard[own[middle]] = to
        open_ -= np.bincount(to, weights=size[middle], minlength=len(new))
        for at in fine[::-1]:
            target = int(np.argmax(open_))
            shard[own[at]] = target
            open_[target] -= size[at]
        over += np.bincount(shard[own], weights=size, minlength=len(new)) - flow[i].astype(np.float64)
    blocks["shard"] = shard
    blocks["first_slot"] = blocks.groupby("shard")["rows"].cumsum() - blocks["rows"]
    return blocks[["old", "block", "shard", "first_slot"]]


def plan(rows: DataFrame, old_shards: int, new: Sequence[int], cost: np.ndarray | None = None) -> DataFrame:
    """old, block, shard, file, affected, first_slot: where each block goes, and the first slot of its file's part of that shard."""
    blocks = rows.groupBy("old", "block").agg(F.sum("size").alias("bytes"), F.count(F.lit(1)).alias("rows")).toPandas()
    moves = transfers(blocks, old_shards, new, cost)
    moves["file"] = moves["block"] // PER_FILE
    moves["affected"] = (moves["shard"] != moves["old"]).groupby([moves["old"], moves["file"]]).transform("any")
    moves["first_slot"] = moves.groupby(["shard", "old", "file"])["first_slot"].transform("min")
    schema = "old int, block int, shard int, file int, affected boolean, first_slot long"
    return rows.sparkSession.createDataFrame(moves[[c.split()[0] for c in schema.split(", ")]], schema)


def with_slots(rows: DataFrame, moves: DataFrame) -> DataFrame:
    """``rows`` with blocks, joined with ``moves``, and their slot: blocks one after the other, rows of a block by hash and id."""
    number = F.row_number().over(Window.partitionBy("shard", "old", "file").orderBy("block", "tie", "id"))
    return rows.join(F.broadcast(moves), ["old", "block"]).withColumn("slot", F.col("first_slot") + number - 1)


def rewrite(rows: DataFrame, path: str) -> DataFrame:
    """Write rows with slots anew, in the order of slots; what a new shard takes of an old file lies in one file. Read back with all columns."""
    columns = ["row", "id", "old", "file", "slot", "shard"]
    rows.select(columns).sortWithinPartitions("shard", "old", "file", "slot").write.mode("overwrite").partitionBy("shard").parquet(path)
    return rows.sparkSession.read.schema(rows.select(columns).schema).parquet(path)


def resharded(
    documents: DataFrame, old: Column | None = None, old_shards: int = OLD_SHARDS, new: Sequence[int] = (1,) * NEW_SHARDS, cost: np.ndarray | None = None
) -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot, grown_shard for every row: from the files written anew, and from those left alone.

    Without ``old``, rows lie in old shards by the hash of their text. ``new`` are the weights of the new shards.
    """
    old = F.pmod(F.xxhash64("text"), F.lit(old_shards)) if old is None else old
    narrow = write_stage(keyed(documents, old), "keyed")
    shards, hot = block_sizes(narrow)
    placed = with_blocks(narrow, shards, hot)
    moves = write_stage(plan(placed, old_shards, new, cost), "moves")
    left_alone = with_slots(placed, moves.where("not affected")).select("id", "size", "text_crc32", "shard", "slot")
    moving = with_blocks(keyed(documents, old, whole_row(documents).alias("row")), shards, hot)
    written = rewrite(with_slots(moving, moves.where("affected")), work_path(documents.sparkSession, "new_files"))
    text = F.coalesce(F.col("row.text"), F.lit(""))
    moved = written.select("id", (F.octet_length(text) + 1).cast("long").alias("size"), F.crc32(text.cast("binary")).alias("text_crc32"), "shard", "slot")
    return left_alone.unionByName(moved).select(
        F.col("id").alias("doc_id"), "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard")
    )
