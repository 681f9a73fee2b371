"""Shard rows by extendible hashing (DataFrame operations only).

The directory is indexed by the leading bits of a row's hash. A bucket whose bytes
exceed the limit is split on another bit, and only such a bucket, until every shard
fits. Sizes are summed per hash prefix before anything is compared, eight bits a
round; each round reads only the rows of buckets that are still too large.

Rows of one key share their hash: once an oversized bucket holds a single key, its
rows go on splitting by a second hash of a row number fixed when the rows are
written, so a hot key spreads over shards. A single row above the limit is a shard
of its own and is marked.

Defined cases: a null payload has 0 bytes; a null key hashes as its own key; rows
of 0 bytes go where their hash says; an empty table gives no shards; other columns
are carried in the struct ``doc`` and cannot clash.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from catalograph.llm.common import written

BITS = 60  # bits of a hash; fixed by 15 hex digits
ROUND = 8  # bits looked at in one round
ROUNDS = 15  # 60 bits of the key's hash, 60 of the row's


def hash_bits(value: Column) -> Column:
    """60 bits of a text's MD5 as '0' and '1'; a null is hashed as a text that no number has."""
    digits = F.substring(F.md5(F.coalesce(value.cast("string"), F.lit("null"))), 1, BITS // 4)
    return F.lpad(F.conv(digits, 16, 2), BITS, "0")


def shard(docs: DataFrame, key: Column, n_bytes: Column, limit: int) -> DataFrame:
    """``doc`` (struct of all columns), ``n_bytes``, ``shard`` (its hash prefix), ``depth``,
    ``shard_bytes``, ``shard_rows`` and ``oversized`` of every row."""
    rows = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc"),
        n_bytes.cast("long").alias("n_bytes"),
        hash_bits(key).alias("bits"),
        F.monotonically_increasing_id().alias("row"),
    )
    rows = written(rows.withColumn("n_bytes", F.coalesce("n_bytes", F.lit(0).cast("long"))), "shard-rows")
    left, found = rows, []
    for r in range(ROUNDS):
        at = ROUND * (r + 1)
        left = left.withColumn("cell", F.substring("bits", 1, at))
        cells = left.groupBy("cell").agg(F.sum("n_bytes").alias("b"), F.count("*").alias("n"), F.min("bits").alias("lo"), F.max("bits").alias("hi"))
        cells = written(cells, "shard-cells")
        depths = F.sequence(F.lit(0 if r == 0 else at - ROUND + 1), F.lit(at))
        sums = (
            cells.select("*", F.explode(depths).alias("depth"))
            .groupBy("depth", F.expr("substring(cell, 1, depth)").alias("shard"))
            .agg(F.sum("b").alias("shard_bytes"), F.sum("n").alias("shard_rows"), F.min("lo").alias("lo"), F.max("hi").alias("hi"), F.collect_list("cell").alias("of"))
        )
        # The first prefix on the way down that fits; one row is never split.
        fits = sums.where((F.col("shard_bytes") <= limit) | (F.col("shard_rows") == 1))
        chosen = fits.select(F.explode("of").alias("cell"), "depth", "shard", "shard_bytes", "shard_rows")
        chosen = chosen.groupBy("cell").agg(F.min(F.struct("depth", "shard", "shard_bytes", "shard_rows")).alias("at"))
        cells = written(cells.join(chosen, "cell", "left"), "shard-directory")
        placed = left.join(cells.select("cell", "at", (F.col("lo") == F.col("hi")).alias("one_key")), "cell")
        found.append(placed.where("at IS NOT NULL").select("doc", "n_bytes", "at.*"))
        if cells.where("at IS NULL").isEmpty():
            break
        rest = placed.where("at IS NULL")
        # One key left in the bucket: from here on the row decides.
        salted = F.concat("cell", F.substring(hash_bits(F.concat(F.lit("row "), F.col("row"))), 1, 2 * BITS))
        spread = F.when(F.col("one_key") & (F.length("bits") == BITS), salted).otherwise(F.col("bits"))
        left = written(rest.select("doc", "n_bytes", spread.alias("bits"), "row"), "shard-left")
    out = reduce(DataFrame.unionAll, found)
    return out.withColumn("oversized", F.col("shard_bytes") > limit)


def directory(shards: DataFrame) -> DataFrame:
    """One row per shard of :func:`shard`'s result."""
    return shards.groupBy("shard", "depth").agg(F.sum("n_bytes").alias("n_bytes"), F.count("*").alias("n_rows"))
