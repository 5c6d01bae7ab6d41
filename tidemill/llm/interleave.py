"""Sharding by proportional stratified interleaving.

Rows are shuffled by a seeded hash within their source; a row's fractional rank is its place there over the source's
size. Sorted by fractional rank, any run of rows has the sources in proportion, so equal cuts give shards that all match
the mixture. Both rankings are made from the counts of small cells, so no source and no global sort meets in one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Rows of a cell of hashes or of fractional ranks, on average; the numbers of cells follow from the rows.
CELL_ROWS = 50_000


def interleave(rows: DataFrame, shards: int, stratum: str | Column = "source", key: str | Column = "doc_id", seed: str = "1", tie: Column | None = None) -> DataFrame:
    """Add ``shard`` (0 to shards - 1) and ``slot`` (long, gapless from 0 in each shard) to every row, in place of columns of these names.

    Shard sizes differ by one row at most. Rows are ordered within a stratum by md5 of the seed and the key, then by the key,
    then by ``tie``; equal fractional ranks are ordered by stratum. A null stratum is a stratum of its own, ahead of all others; a
    null key counts as the empty text. Rows equal in stratum, key and tie may take each other's places. An empty table gives no rows.
    """
    names = [c for c in rows.columns if c not in ("shard", "slot")]
    as_column = lambda c: F.col(f"`{c}`") if isinstance(c, str) else c
    stratum, key = as_column(stratum), as_column(key)
    # The row itself is kept apart, so that its columns may have any names.
    rows = rows.select(
        F.struct(*(F.col(f"`{c}`") for c in names)).alias("row"), F.struct(stratum.alias("s")).alias("stratum"), key.alias("key"), (F.lit(0) if tie is None else tie).alias("tie"),
        F.md5(F.concat(F.lit(seed + ":"), F.coalesce(key.cast("string"), F.lit("")))).alias("hash"),
    )
    cells_of = rows.count() // CELL_ROWS + 1
    number = F.conv(F.substring("hash", 1, 13), 16, 10).cast("double") / F.lit(float(2**52))
    rows = rows.withColumn("cell", F.floor(number * cells_of))
    cells = rows.groupBy("stratum", "cell").agg(F.count("*").alias("size"))
    # A stratum has at most as many cells as there are, each of one row here.
    within = Window.partitionBy("stratum")
    cells = cells.withColumn("before", F.sum("size").over(within.orderBy("cell")) - F.col("size")).withColumn("all", F.sum("size").over(within))
    order = ["hash", "key", "tie"]
    ranked = rows.join(cells.drop("size"), ["stratum", "cell"])
    ranked = ranked.withColumn("rank", F.col("before") + F.row_number().over(Window.partitionBy("stratum", "cell").orderBy(*order)))
    ranked = ranked.withColumn("part", (F.col("rank") - F.lit(0.5)) / F.col("all"))
    ranked = ranked.withColumn("cell", F.floor(F.col("part") * cells_of)).drop("before", "all")
    cells = ranked.groupBy("cell").agg(F.count("*").alias("size"))
    # One row here for CELL_ROWS rows of the table.
    cells = cells.withColumn("start", F.sum("size").over(Window.orderBy("cell")) - F.col("size")).withColumn("total", F.sum("size").over(Window.partitionBy()))
    out = ranked.join(cells.drop("size"), "cell")
    out = out.withColumn("place", F.col("start") + F.row_number().over(Window.partitionBy("cell").orderBy("part", "stratum", *order)) - 1)
    out = out.withColumn("shard", F.expr(f"cast(({shards} * (place + 1) - 1) div total as int)"))
    out = out.withColumn("slot", F.expr(f"place - shard * total div {shards}"))
    return out.select(*(F.col("row").getField(c).alias(c) for c in names), "shard", "slot")


def shard_documents(docs: DataFrame, shards: int = 40, seed: str = "1") -> DataFrame:
    """The whole table of documents with ``shard`` and ``slot``, which take the place of columns of these names. Texts with the same id, if any, are ordered by their content."""
    return interleave(docs, shards, seed=seed, tie=F.crc32(F.coalesce(F.col("text"), F.lit(""))))


def assignments(docs: DataFrame, shards: int = 40, seed: str = "1") -> DataFrame:
    """Where every document goes: ``doc_id``, ``size`` (UTF-8 bytes of the text, none if null, and 16), ``text_crc32``, ``law``, ``shard``, ``slot``,
    ``grown_shard`` (null: adding a shard moves rows everywhere under the law of equal row counts)."""
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.select("doc_id", "source", (F.octet_length(text) + 16).cast("long").alias("size"), F.crc32(text).alias("text_crc32"))
    out = interleave(rows, shards, seed=seed, tie=F.col("text_crc32"))
    return out.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))
