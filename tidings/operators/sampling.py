"""Seeded sampling, splitting, oversampling and row numbering.

All draws come from a hash of the row's own content, so they do not change
with partitioning or with a task that runs again.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import DataFrame, Window, functions as F

from tidings.functions.hashing import seeded_hash
from tidings.session import fresh_path

# A hash is cut into this many ranges; a range of one group is one sort.
RANGES = 1 << 16
# Draws and copies per generated row, so that no row explodes into too many.
CHUNK = 1 << 16


def ranked(df: DataFrame, by: Sequence[str], key: Sequence[str], seed: int) -> DataFrame:
    """Add `_rank`, from 0, in hash order within the groups of `by`.

    `key` identifies a row. A group may hold most of the table: it is cut into
    hash ranges that are ranked in parallel, and a histogram of the ranges
    gives each one its first rank.
    """
    hashed = df.withColumn("_hash", seeded_hash(seed, *[F.col(k) for k in key])).withColumn(
        "_range", F.shiftright("_hash", 60 - int(math.log2(RANGES)))
    )
    group = [*by, "_range"]
    before = F.sum("_in_range").over(
        Window.partitionBy(*by or [F.lit(0)])
        .orderBy("_range")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    first_rank = (
        hashed.groupBy(*group)
        .agg(F.count("*").alias("_in_range"))
        .select(*group, F.coalesce(before, F.lit(0)).alias("_first"))
        # Else the planner would deal all rows by the group alone, as this window is dealt.
        .repartition(*group)
    )
    place = F.row_number().over(Window.partitionBy(*group).orderBy("_hash", *key))
    return (
        hashed.withColumn("_place", place)
        .join(first_rank, group)
        .withColumn("_rank", F.col("_first") + F.col("_place") - 1)
        .drop("_hash", "_range", "_place", "_first")
    )


def _quotas(counts: DataFrame, label: str, n: int, n_test: int) -> DataFrame:
    """Test rows per label: the exact share rounded by largest remainder."""
    share = F.col("_n").cast("decimal(18,0)") * F.lit(n_test).cast("decimal(18,0)")
    whole = F.expr(f"cast(_n as decimal(18,0)) * cast({n_test} as decimal(18,0)) div {n}")
    everywhere = Window.partitionBy(F.lit(0))
    order = everywhere.orderBy(F.desc("_rest"), label)
    return (
        counts.withColumns({"_whole": whole, "_rest": share % F.lit(n).cast("decimal(18,0)")})
        .withColumn("_left", F.lit(n_test) - F.sum("_whole").over(everywhere))
        .withColumn("_quota", F.col("_whole") + (F.row_number().over(order) <= F.col("_left")).cast("int"))
        .select(label, "_quota")
    )


def stratified_split(
    df: DataFrame,
    *,
    test_size: float = 0.2,
    seed: int = 42,
    label: str = "label",
    key: Sequence[str] = ("label", "sentence"),
    stratify: bool = True,
) -> DataFrame:
    """Add `is_test`; exactly ceil(test_size * n) rows are test rows.

    Labels keep their share. When that is impossible (a label with one row, or
    fewer rows on a side than labels) the rows are split without regard to it.
    The label counts, one row per label, are the only thing gathered first.
    """
    counts = df.groupBy(label).agg(F.count("*").alias("_n"))
    shape = counts.agg(
        F.coalesce(F.sum("_n"), F.lit(0)).alias("n"),
        F.count("*").alias("labels"),
        F.min("_n").alias("least"),
    ).first()
    n_test = math.ceil(test_size * shape.n)
    possible = (
        stratify
        and shape.n > 0
        and shape.least >= 2
        and min(n_test, shape.n - n_test) >= shape.labels
    )
    if not possible:
        return ranked(df, (), key, seed).withColumn("is_test", F.col("_rank") < n_test).drop("_rank")
    return (
        ranked(df, (label,), key, seed)
        .join(_quotas(counts, label, shape.n, n_test), label)
        .withColumn("is_test", F.col("_rank") < F.col("_quota"))
        .drop("_rank", "_quota")
    )


def _spread(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def oversample(
    df: DataFrame,
    *,
    seed: int = 42,
    label: str = "label",
    key: Sequence[str] = ("label", "sentence"),
) -> DataFrame:
    """Add `copies`: 1 plus the times a row was drawn to fill up its label.

    Each label is topped up to the largest one by draws with replacement. The
    copies stay a number, which a fit takes as weight; `expand_copies` writes
    them out.
    """
    counts = df.groupBy(label).agg(F.count("*").alias("_n"))
    largest = F.max("_n").over(Window.partitionBy(F.lit(0)))
    lacking = counts.withColumn("_lack", largest - F.col("_n")).where("_lack > 0")
    chunks = lacking.select(
        label,
        "_n",
        "_lack",
        F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("_lack") - 1, F.lit(CHUNK).cast("bigint"))).alias("_from"),
    ).repartition(_spread(df), label, "_from")
    draws = chunks.select(
        label,
        "_n",
        F.explode(
            F.sequence("_from", F.least(F.col("_from") + CHUNK, F.col("_lack")) - 1)
        ).alias("_k"),
    ).select(label, F.pmod(seeded_hash(seed, F.col(label), F.col("_k")), F.col("_n")).alias("_rank"))
    drawn = draws.groupBy(label, "_rank").agg(F.count("*").alias("_drawn"))
    return (
        ranked(df, (label,), key, seed)
        .join(drawn, [label, "_rank"], "left")
        .withColumn("copies", F.coalesce(F.col("_drawn"), F.lit(0)) + 1)
        .drop("_rank", "_drawn")
    )


def expand_copies(df: DataFrame) -> DataFrame:
    """One row per copy, written out in chunks that are spread over the tasks."""
    parts = df.withColumn(
        "_part",
        F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("copies"), F.lit(CHUNK).cast("bigint"))),
    ).repartition(_spread(df))
    return parts.withColumn(
        "_copy",
        F.explode(F.sequence("_part", F.least(F.col("_part") + CHUNK - 1, F.col("copies")))),
    ).drop("_part", "_copy", "copies")


def with_row_index(df: DataFrame, order: Sequence[str], index: str = "idx") -> DataFrame:
    """Number the rows from 0 in the given order, in parallel.

    Ties follow a hash of the whole row; rows that are equal in that too are
    copies and get neighbouring numbers. Only the order columns and the hash
    are counted, sorted and written to the shared folder, where file name and
    row position are fixed and file sizes give each file its first number; the
    rows themselves move once, to their number. Any column type may be among
    the columns outside the order.
    """
    spark = df.sparkSession
    keys = [f"_k{i}" for i in range(len(order))]
    tie = F.md5(F.to_json(F.struct(*df.columns)))
    row = df.select(*[F.col(c).alias(k) for c, k in zip(order, keys)], tie.alias("_tie"), F.struct(*df.columns).alias("_row"))
    path = fresh_path(spark, "numbered")
    row.groupBy(*keys, "_tie").agg(F.count("*").alias("_n")).orderBy(*keys, "_tie").write.parquet(path)
    stored = spark.read.parquet(path).select(
        "*",
        F.col("_metadata.file_name").alias("_file"),
        F.col("_metadata.row_index").alias("_at"),
    )
    files = stored.groupBy("_file").agg(F.sum("_n").alias("_rows"), F.max("_n").alias("_most"))
    # One row per written file; the task number in the name is the sort position.
    task = F.regexp_extract("_file", r"part-(\d+)", 1).cast("int")
    by_name = (
        Window.partitionBy(F.lit(0))
        .orderBy(task, "_file")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    firsts = files.select("_file", F.coalesce(F.sum("_rows").over(by_name), F.lit(0)).alias("_first"))
    inside = Window.partitionBy("_file").orderBy("_at").rowsBetween(Window.unboundedPreceding, -1)
    starts = stored.withColumn("_skip", F.coalesce(F.sum("_n").over(inside), F.lit(0))).join(firsts, "_file")
    starts = starts.withColumn("_start", F.col("_first") + F.col("_skip"))
    # Keys may be null; the hash alone names a row's content.
    single = row.join(starts.where("_n = 1").select("_tie", "_start"), "_tie").select(F.col("_start").alias(index), "_row")
    # Of copies one row is kept and written out again in chunks.
    one = row.join(starts.where("_n > 1").select("_tie", "_start", "_n"), "_tie").groupBy("_tie", "_start", "_n").agg(F.first("_row").alias("_row"))
    chunks = one.withColumn(
        "_from",
        F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("_n") - 1, F.lit(CHUNK).cast("bigint"))),
    )
    copies = F.sequence("_from", F.least(F.col("_from") + CHUNK, F.col("_n")) - 1)
    copied = chunks.select("_start", "_row", F.explode(copies).alias("_c")).select((F.col("_start") + F.col("_c")).alias(index), "_row")
    return single.union(copied).select(index, "_row.*")


def head_n(df: DataFrame, n: int, order: Sequence[str]) -> DataFrame:
    """The first n rows in the given order, ties by a hash of the row: one way for every n."""
    return with_row_index(df, order, "_idx").where(F.col("_idx") < n).drop("_idx")


def sample_n(df: DataFrame, n: int, key: Sequence[str], seed: int = 42) -> DataFrame:
    """Exactly n rows (or all when fewer), the same ones for the same seed."""
    drawn = df.withColumn("_draw", seeded_hash(seed, *[F.col(k) for k in key]))
    return head_n(drawn, n, ["_draw", *key]).drop("_draw")


def limit_rows(
    df: DataFrame, limit: int, *, sample: bool, key: Sequence[str], seed: int = 42
) -> DataFrame:
    """No limit when 0; otherwise the head or a sample."""
    if limit <= 0:
        return df
    return sample_n(df, limit, key, seed) if sample else head_n(df, limit, key)
