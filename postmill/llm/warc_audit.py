"""Fixity audit of WARC replicas by Merkle trees over ordered offset ranges.

Records stand in files in order of their ids; a record's offset is the sum of the lengths before it. Tree levels: records, ranges of
``RANGE_BYTES`` of offsets, files, then groups of ``FAN`` files, until one root is left. A node's digest covers its children's places and
digests. Two replicas are compared from the root; only children of differing nodes are met at the next level, down to the records.

Equal records of one id are told once, with their number; their offset is that of the first, and the digests of the tree cover the number. Null urls and pages count as empty. Rows without
an id stand in a file of their own, by digest. Empty archives have no root; all records of the other are then told as missing or extra.
A missing record moves those after it in its file, which are told as moved. A record which one archive repeats more often is told as copies.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from postmill.session import write_stage

FILE_IDS = 500
RANGE_BYTES = 1 << 18
FAN = 16
NO_FILE = -1


def record(url: Column, payload: Column) -> Column:
    """A WARC response record as text."""
    url, payload = F.coalesce(url, F.lit("")), F.coalesce(payload, F.lit(""))
    head = F.concat(F.lit("WARC/1.0\r\nWARC-Type: response\r\nWARC-Target-URI: "), url, F.lit("\r\nContent-Length: "), F.octet_length(payload).cast("string"))
    return F.concat(head, F.lit("\r\n\r\n"), payload, F.lit("\r\n\r\n"))


def archive(pages: DataFrame, id_col: str = "page_id", url: str = "url", payload: str = "html") -> DataFrame:
    """Records of an archive: file, id, copies, digest, length, offset."""
    text = record(F.col(url), F.col(payload))
    facts = pages.select(F.col(id_col).cast("long").alias("id"), F.sha2(text, 256).alias("digest"), F.octet_length(text).cast("long").alias("length"))
    once = facts.groupBy("id", "digest", "length").agg(F.count(F.lit(1)).alias("copies"))
    placed = once.withColumn("file", F.coalesce(F.floor(F.col("id") / FILE_IDS), F.lit(NO_FILE)))
    before = Window.partitionBy("file").orderBy("id", "digest").rowsBetween(Window.unboundedPreceding, -1)
    return placed.withColumn("offset", F.coalesce(F.sum(F.col("length") * F.col("copies")).over(before), F.lit(0)))


def _folded(children: DataFrame, node: Column, place: str) -> DataFrame:
    """Parents of nodes: the digest of their children's places and digests, in order."""
    parts = F.transform(F.sort_array(F.collect_list(F.struct(place, "digest"))), lambda c: F.concat_ws(":", c[place].cast("string"), c["digest"]))
    return children.groupBy(node.alias("node")).agg(F.sha2(F.array_join(parts, "\n"), 256).alias("digest"))


def tree(records: DataFrame) -> list[DataFrame]:
    """Levels from ranges (file, range) and files up to the root; each as (node, parent, digest)."""
    ranged = records.withColumn("node", F.struct("file", F.floor(F.col("offset") / RANGE_BYTES).alias("range")))
    ranged = ranged.withColumn("digest", F.concat_ws("x", F.col("copies").cast("string"), "digest"))
    ranges = write_stage(_folded(ranged, F.col("node"), "offset").select(F.col("node.file").alias("file"), F.col("node.range").alias("range"), "digest"), "ranges")
    files = write_stage(_folded(ranges, F.col("file"), "range"), "files")
    levels = [ranges.select(F.struct("file", "range").alias("node"), F.col("file").alias("parent"), "digest")]
    nodes = files
    while nodes.limit(FAN + 1).count() > FAN:
        levels.append(nodes.select("node", F.floor(F.col("node") / FAN).alias("parent"), "digest"))
        nodes = write_stage(_folded(nodes, F.floor(F.col("node") / FAN), "node"), "nodes")
    levels.append(nodes.select("node", F.lit(0).cast("long").alias("parent"), "digest"))
    levels.append(_folded(nodes, F.lit(0).cast("long"), "node").select("node", F.lit(0).cast("long").alias("parent"), "digest"))
    return levels


def _differing(a: DataFrame, b: DataFrame, parents: DataFrame | None) -> DataFrame:
    """Nodes of one level, below the differing ``parents``, whose digests differ or which one replica lacks."""
    if parents is not None:
        a, b = a.join(parents, "parent", "left_semi"), b.join(parents, "parent", "left_semi")
    met = a.select("node", F.col("digest").alias("x")).join(b.select("node", F.col("digest").alias("y")), "node", "full")
    return met.where(~F.col("x").eqNullSafe(F.col("y"))).select(F.col("node").alias("parent"))


def audit(left: DataFrame, right: DataFrame) -> DataFrame:
    """Records in which two archives differ: id, file, both offsets, lengths and digests, and what happened."""
    left, right = write_stage(left, "left"), write_stage(right, "right")
    trees = [tree(left), tree(right)]
    # trees of unequal heights have no comparable levels above their files
    top = len(trees[0]) if len(trees[0]) == len(trees[1]) else 2
    differing = None
    for level in range(top - 1, -1, -1):
        differing = write_stage(_differing(trees[0][level], trees[1][level], differing), "differing")
    ranges = differing.select("parent.file", "parent.range")
    of = lambda r: r.withColumn("range", F.floor(F.col("offset") / RANGE_BYTES)).join(ranges, ["file", "range"], "left_semi")
    side = lambda r, s: of(r).select("file", "id", *[F.col(c).alias(f"{c}_{s}") for c in ("digest", "length", "offset", "copies")])
    a, b = side(left, "a"), side(right, "b")
    same = (a["file"] == b["file"]) & a["id"].eqNullSafe(b["id"]) & (a["digest_a"] == b["digest_b"]) & (a["offset_a"] == b["offset_b"]) & (a["copies_a"] == b["copies_b"])
    only_a, only_b = a.join(b, same, "left_anti"), b.join(a, same, "left_anti")
    # records of one id meet in order of digest
    key = lambda d, s: d.withColumn("n", F.row_number().over(Window.partitionBy("file", "id").orderBy(f"digest_{s}")))
    x, y = key(only_a, "a").alias("x"), key(only_b, "b").alias("y")
    met = x.join(y, (F.col("x.file") == F.col("y.file")) & F.col("x.id").eqNullSafe(F.col("y.id")) & (F.col("x.n") == F.col("y.n")), "full")
    kind = (
        F.when(F.col("y.file").isNull(), "missing").when(F.col("x.file").isNull(), "extra")
        .when(F.col("digest_a") != F.col("digest_b"), "changed").when(F.col("copies_a") != F.col("copies_b"), "copies").otherwise("moved")
    )
    return met.select(
        F.coalesce("x.id", "y.id").alias("id"), F.coalesce("x.file", "y.file").alias("file"), "offset_a", "offset_b", "length_a", "length_b", "digest_a", "digest_b", kind.alias("kind")
    )
