"""Sharding by a k-d tree over document metadata.

The tree cuts recursively at the distributed weighted median (by bytes) along
the dimension that is widest in the node, measured against its width at the
root, until every leaf holds the target bytes. A cut position is found digit
by digit: one aggregation per digit gives each open node a histogram of at
most `1 << 11` bins. Only node rows, at most one per shard, reach the driver.

Equal texts stay in one shard as long as that leaves the shards even: a group
of copies up to `TOGETHER` of a shard has one place in the tree, a larger one
is spread like other rows.
"""

from __future__ import annotations

import math

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from tidings.llm.common import read
from tidings.operators.sampling import ranked
from tidings.session import written

# A cut key has 32 bits: 16 of the dimension's code, 16 of the row's hash, which orders equal codes.
DIGITS = ((21, 11), (10, 11), (0, 10))
# The rows are written anew after so many levels, so that a plan holds few joins.
LEVELS_PER_PLAN = 6
# The largest group of equal texts that stays in one shard, as a share of it.
TOGETHER = 1 / 16


def text_bytes(text: Column) -> Column:
    return F.coalesce(F.octet_length(text), F.lit(0)).cast("long")


def metadata_codes(docs: DataFrame, *, shards: int | None = None, target_bytes: int | None = None, keep: bool = False) -> DataFrame:
    """doc_id, size, text_crc32, four 16-bit metadata codes and a 16-bit tie per row; with `keep` also `doc`, the whole row.

    Language and source are categories: their code is a hash, so that equal
    values stay neighbours without a dictionary. Length is on a log scale.
    Small groups of equal texts take the codes of their least row.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    category = lambda c, seed: F.pmod(F.xxhash64(F.lit(seed), F.coalesce(F.col(c), F.lit(""))), F.lit(65536))
    rows = docs.select(
        "doc_id",
        (text_bytes(F.col("text")) + 8).alias("size"),
        F.crc32(F.encode(text, "UTF-8")).alias("text_crc32"),
        category("lang", 1).alias("d0"),
        category("source", 2).alias("d1"),
        F.least(F.log2(text_bytes(F.col("text")) + 1) * 1600, F.lit(65535)).cast("long").alias("d2"),
        F.xxhash64(F.lit(3), text).alias("text_key"),
        F.pmod(F.xxhash64(F.lit(4), F.col("doc_id"), F.col("source"), text), F.lit(65536)).alias("own_tie"),
        *([F.struct(*docs.columns).alias("doc")] if keep else []),
    )
    own = rows.select("doc_id", "size", "text_crc32", "d0", "d1", "text_key")
    total = own.agg(F.coalesce(F.sum("size"), F.lit(0))).first()[0]
    limit = TOGETHER * (target_bytes or total / (shards or 1))
    least = F.min(F.struct(F.col("doc_id"), F.col("d0").alias("g0"), F.col("d1").alias("g1"))).alias("least")
    groups = own.groupBy("text_key", "text_crc32", "size").agg(least, F.count("*").alias("n"))
    groups = groups.where((F.col("n") > 1) & (F.col("n") * F.col("size") <= limit)).select("text_key", "text_crc32", "size", "least.g0", "least.g1")
    hashed = F.pmod(F.col("text_key"), F.lit(65536))
    return rows.join(groups, ["text_key", "text_crc32", "size"], "left").select(
        "doc_id", "size", "text_crc32", F.coalesce("g0", "d0").alias("d0"), F.coalesce("g1", "d1").alias("d1"), "d2", hashed.alias("d3"),
        F.when(F.col("g0").isNotNull(), F.pmod(F.shiftright("text_key", 16), F.lit(65536))).otherwise(F.col("own_tie")).alias("tie"),
        *(["doc"] if keep else []),
    )


def _local(spark: SparkSession, rows: list[dict], **kinds) -> DataFrame:
    """At most one row per shard, as a table that is part of the plan."""
    return F.broadcast(spark.createDataFrame(pa.table({c: pa.array([r[c] for r in rows], kind) for c, kind in kinds.items()})))


def _cuts(rows: DataFrame, plan: list[dict]) -> list[dict]:
    """Add the cut key to every planned node: rows below it go left."""
    spark = rows.sparkSession
    for node in plan:
        node |= {"prefix": 0, "before": 0}
    key = F.element_at(F.array("d0", "d1", "d2", "d3"), F.col("dim") + 1) * 65536 + F.col("tie")
    for shift, width in DIGITS:
        nodes = _local(spark, plan, shard=pa.int32(), dim=pa.int32(), goal=pa.int64(), prefix=pa.int64(), before=pa.int64())
        bins = (
            rows.join(nodes, "shard")
            .withColumn("_key", key)
            .where(F.shiftright("_key", shift + width) == F.col("prefix"))
            .groupBy("shard", F.shiftright("_key", shift).alias("digit"))
            .agg(F.sum("size").alias("bytes"), F.first("goal").alias("goal"), F.first("before").alias("before"))
        )
        upto = F.sum("bytes").over(Window.partitionBy("shard").orderBy("digit"))
        crossing = (
            bins.withColumn("upto", F.col("before") + upto)
            .where("upto >= goal and upto - bytes < goal")
            .select("shard", "digit", (F.col("upto") - F.col("bytes")).alias("below"), "upto")
            .collect()
        )
        found = {r.shard: r for r in crossing}
        for node in plan:
            r = found[node["shard"]]
            node |= {"prefix": r.digit, "before": r.below, "upto": r.upto}
    for node in plan:
        nearer = node["goal"] - node["before"] > node["upto"] - node["goal"]
        node["cut"] = node["prefix"] + int(nearer)
    return plan


def kd_cuts(rows: DataFrame, *, shards: int | None = None, target_bytes: int | None = None) -> list[list[dict]]:
    """The tree over the rows of `metadata_codes`, level by level: shard, dim, cut, left per cut node.

    Give the number of shards or their target bytes. Shards are near equal in
    bytes: a cut lies within half the bytes of one key of its goal. A key is
    one document or one small group of copies; rows equal in id, source and
    text stay together too. No rows: no cuts.
    """
    dims = ["d0", "d1", "d2", "d3"]
    ends = [f(d).alias(f"{n}_{d}") for d in dims for n, f in (("lo", F.min), ("hi", F.max))]
    rows = rows.select("size", *dims, "tie").withColumn("shard", F.lit(0))
    root = rows.agg(F.coalesce(F.sum("size"), F.lit(0)).alias("total"), *ends).first()
    if not root.total:
        return []
    wide = {d: max(1, root[f"hi_{d}"] - root[f"lo_{d}"]) for d in dims}
    open_nodes, levels = {0: shards or max(1, math.ceil(root.total / target_bytes))}, []
    while any(n > 1 for n in open_nodes.values()):
        stats = {r.shard: r for r in rows.groupBy("shard").agg(F.sum("size").alias("total"), *ends).collect()}
        plan = []
        for shard, n in open_nodes.items():
            if n > 1 and shard in stats:
                r = stats[shard]
                dim = max(range(len(dims)), key=lambda i, r=r: ((r[f"hi_{dims[i]}"] - r[f"lo_{dims[i]}"]) / wide[dims[i]], -i))
                plan.append({"shard": shard, "dim": dim, "goal": max(1, r.total * (n // 2) // n), "left": n // 2})
        _cuts(rows, plan)
        levels.append(plan)
        rows = place(rows, [plan])
        if len(levels) % LEVELS_PER_PLAN == 0:
            rows = written(rows, "shards")
        nodes, open_nodes = open_nodes, {}
        for shard, n in nodes.items():
            open_nodes[shard] = n // 2 if n > 1 else n
            if n > 1:
                open_nodes[shard + n // 2] = n - n // 2
    return levels


def place(rows: DataFrame, levels: list[list[dict]]) -> DataFrame:
    """Move the rows (codes and `shard`) down the given levels of the tree."""
    key = F.element_at(F.array("d0", "d1", "d2", "d3"), F.col("dim") + 1) * 65536 + F.col("tie")
    for plan in levels:
        cuts = _local(rows.sparkSession, plan, shard=pa.int32(), dim=pa.int32(), cut=pa.int64(), left=pa.int32())
        rows = (
            rows.join(cuts, "shard", "left")
            .withColumn("shard", F.col("shard") + F.when(key >= F.col("cut"), F.col("left")).otherwise(0))
            .drop("dim", "cut", "left")
        )
    return rows


def kd_shards(rows: DataFrame, *, shards: int | None = None, target_bytes: int | None = None) -> DataFrame:
    """Add `shard` (0 ... n-1) to the rows of `metadata_codes`, by the tree of `kd_cuts`; no rows give an empty result."""
    return place(rows.withColumn("shard", F.lit(0)), kd_cuts(rows, shards=shards, target_bytes=target_bytes))


def shard_documents(docs: DataFrame, *, shards: int = 24, keep: bool = False) -> DataFrame:
    """doc_id, size, text_crc32, shard and slot (gapless from 0 in each shard); with `keep` the docs' columns, shard and slot.

    A null text counts as empty, null metadata as a value of its own. Rows of
    one id, and copies of one row, all get a shard and a slot of their own. An
    empty table gives an empty result; docs' columns may have any names but
    `shard` and `slot`, which are replaced.
    """
    codes = written(metadata_codes(docs, shards=shards), "metadata")
    levels = kd_cuts(codes, shards=shards)
    rows = metadata_codes(docs, shards=shards, keep=True) if keep else codes
    placed = place(rows.withColumn("shard", F.lit(0)), levels).drop("d0", "d1", "d2", "d3", "tie")
    slots = ranked(placed, ["shard"], ["doc_id", "text_crc32"], 9).withColumn("slot", F.col("_rank").cast("long"))
    if not keep:
        return slots.select("doc_id", "size", "text_crc32", "shard", "slot")
    kept = [F.col("doc")[c].alias(c) for c in docs.columns if c not in ("shard", "slot")]
    return slots.select(*kept, "shard", "slot")


def op9_kd_sharding(spark: SparkSession, folder: str) -> DataFrame:
    return shard_documents(read(spark, folder, "documents")).select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


def shard_stage(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """All rows with all their columns, each with its shard and its slot there.

    Copies that the mix made are rows of their own and differ in their slot.
    Null texts and metadata, rows that repeat an id, an empty table and clashing
    columns: as `shard_documents` says.
    """
    return shard_documents(docs, keep=True)
