"""Mixing sources to target weights by iterative proportional fitting, with DataFrame functions only.

Documents are summed to cells (source, language, topic). The cells' token weights are raked: scaled to the target of one
margin after the other until all three hold. Documents are then sampled with the calibrated probability of their cell.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemill.llm.stage import drop, settle

MARGINS = ("source", "lang", "topic")
#: Rounds of raking. Each multiplies the remaining error of a connected table by a factor below 1.
ROUNDS = 8
#: Cells that are joined to the documents by broadcast at most (about 20 MB); more are joined by a shuffle.
BROADCAST_CELLS = 200_000
#: Target of a margin: shares by value, or an exponent that flattens (below 1) the tokens the corpus has.
Target = Mapping[str, float] | float
FLATTENED: dict[str, Target] = {"source": 0.5, "lang": 0.7, "topic": 0.9}


def topic() -> Column:
    """A coarse topic of the column ``text`` by its form: empty, table, markup, capitals, short or prose."""
    return (
        F.when(F.coalesce(F.col("text"), F.lit("")) == "", "empty")
        .when(F.contains("text", F.lit(" | ")), "table")
        .when(F.col("text").rlike("[#*$%&|<>]{3}"), "markup")
        .when(~F.col("text").rlike("[a-z]"), "capitals")
        .when(F.char_length("text") < 500, "short")
        .otherwise("prose")
    )


def tokens() -> Column:
    """Words of the column ``text``: runs of characters other than white space; none if it is null."""
    return F.coalesce(F.regexp_count("text", F.lit(r"[^\x20\x09-\x0D]++")), F.lit(0)).cast("long")


def _wanted(margin: str, target: Target) -> Column:
    """A value's unscaled target. Shares by value: a value without one keeps what it has of the rest."""
    own = F.sum("tokens").over(Window.partitionBy(margin))
    if isinstance(target, Mapping):
        named = [x for k, v in target.items() for x in (F.lit(k), F.lit(float(v)))]
        share = F.create_map(*named)[F.col(margin)] if named else F.lit(None)
        rest = max(0.0, 1.0 - sum(target.values()))
        other = F.sum(F.when(share.isNull(), F.col("tokens"))).over(Window.partitionBy(F.lit(1)))
        return F.coalesce(share, F.lit(rest) * own / other)
    return F.pow(own.cast("double"), F.lit(float(target)))


def rake(cells: DataFrame, targets: Mapping[str, Target] = FLATTENED, rounds: int = ROUNDS) -> DataFrame:
    """Add ``weight`` to a table of cells (the margins and ``tokens``): tokens times weight have every margin in proportion to its target.

    Cells without tokens get weight 1. Margins without any token, or with a target of 0, get weight 0.
    """
    for margin in targets:
        cells = cells.withColumn(f"_{margin}", _wanted(margin, targets[margin]))
    cells = settle(cells.withColumn("weight", F.lit(1.0)))
    for _ in range(rounds):
        now = cells
        for margin in targets:
            has = F.sum(F.col("tokens") * F.col("weight")).over(Window.partitionBy(margin))
            now = now.withColumn("weight", F.when(has > 0, F.col("weight") * F.col(f"_{margin}") / has).otherwise(F.col("weight")))
        now = settle(now)
        drop(cells)
        cells = now
    return cells.drop(*(f"_{m}" for m in targets))


def calibrate(cells: DataFrame, share: float) -> DataFrame:
    """Add ``p``, the least of 1 and a multiple of the weight, so that the expected tokens are ``share`` of all. Cells without tokens get 1."""
    some = cells.filter("tokens > 0")
    order = Window.partitionBy(F.lit(1)).orderBy(F.desc("weight"), *MARGINS)
    ahead = order.rowsBetween(Window.unboundedPreceding, -1)
    behind = order.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    everything = F.sum("tokens").over(Window.partitionBy(F.lit(1)))
    factor = (F.lit(share) * everything - F.coalesce(F.sum("tokens").over(ahead), F.lit(0))) / F.sum(F.col("tokens") * F.col("weight")).over(behind)
    factors = some.withColumn("_factor", factor)
    # The first cell, by weight, that its factor does not fill; all cells if none is filled up to there.
    chosen = factors.filter("_factor * weight <= 1").agg(F.max_by("_factor", "weight").alias("_by"), F.count("*").alias("_found"))
    out = cells.crossJoin(F.broadcast(chosen))  # one row
    return out.withColumn("p", F.when((F.col("tokens") == 0) | (F.col("_found") == 0), 1.0).otherwise(F.least(F.lit(1.0), F.col("weight") * F.col("_by")))).drop("_by", "_found")


def mix(docs: DataFrame, targets: Mapping[str, Target] = FLATTENED, share: float = 0.8, rounds: int = ROUNDS, seed: str = "7", by_topic: Column | None = None) -> DataFrame:
    """Sample documents so that source, language and topic meet their target shares of tokens. ``by_topic`` is a column of topics (text); by default
    the form of the text, as a table without topics has nothing else.

    Returns every document: ``doc_id``, ``source``, ``lang``, ``topic``, ``tokens``, ``weight`` and ``p`` (of its cell, to six decimals)
    and ``kept``: whether a hash of seed and id, as a number from 0 to 1, is below ``p``. Rows with one id share that number.

    A null source or language is a value of its own, returned as null. A null or empty text has no tokens and is kept. Other columns are ignored; an empty
    table gives no rows. A margin's target is met as far as the cells that exist and the cap of 1 on a probability allow.
    """
    blank = "\x00"
    rows = docs.select("doc_id", *(F.coalesce(c, F.lit(blank)).alias(c) for c in ("source", "lang")), (topic() if by_topic is None else F.coalesce(by_topic, F.lit(blank))).alias("topic"), tokens().alias("tokens"))
    rows = settle(rows)
    cells = rows.groupBy(*MARGINS).agg(F.sum("tokens").alias("tokens"))
    cells = settle(calibrate(rake(cells, targets, rounds), share).select(*MARGINS, F.round("weight", 6).alias("weight"), F.round("p", 6).alias("p")))
    if cells.count() <= BROADCAST_CELLS:
        cells = F.broadcast(cells)
    luck = F.conv(F.substring(F.md5(F.concat(F.lit(seed + ":"), F.coalesce(F.col("doc_id").cast("string"), F.lit("")))), 1, 13), 16, 10).cast("double") / F.lit(float(2**52))
    back = (F.when(F.col(c) != blank, F.col(c)).alias(c) for c in ("source", "lang"))
    return rows.join(cells, list(MARGINS)).select("doc_id", *back, "topic", "tokens", "weight", "p", (luck < F.col("p")).alias("kept"))


def mix_sql(targets: Mapping[str, float] = FLATTENED, share: float = 0.8, rounds: int = ROUNDS, seed: str = "7") -> str:
    """DuckDB SQL of ``mix`` over the table documents, for targets that are exponents."""
    word = r"[^\x20\x09-\x0D]+"
    ctes = [
        f"""d AS (SELECT doc_id, coalesce(source, chr(1)) AS source, coalesce(lang, chr(1)) AS lang,
  CASE WHEN coalesce(text, '') = '' THEN 'empty' WHEN contains(text, ' | ') THEN 'table' WHEN regexp_matches(text, '[#*$%&|<>]{{3}}') THEN 'markup'
    WHEN NOT regexp_matches(text, '[a-z]') THEN 'capitals' WHEN length(text) < 500 THEN 'short' ELSE 'prose' END AS topic,
  coalesce(len(regexp_extract_all(text, '{word}')), 0)::BIGINT AS tokens FROM documents)""",
        "c AS (SELECT source, lang, topic, sum(tokens)::BIGINT AS tokens FROM d GROUP BY ALL)",
        "w0 AS (SELECT *, " + ", ".join(f"pow(sum(tokens) OVER (PARTITION BY {m})::DOUBLE, {t}) AS t_{m}" for m, t in targets.items()) + ", 1.0::DOUBLE AS weight FROM c)",
    ]
    at = 0
    for _ in range(rounds):
        for m in targets:
            scaled = f"CASE WHEN h > 0 THEN weight * t_{m} / h ELSE weight END"
            summed = f"SELECT *, sum(tokens * weight) OVER (PARTITION BY {m}) AS h FROM w{at}"
            ctes.append(f"w{at + 1} AS MATERIALIZED (SELECT * EXCLUDE (h) REPLACE ({scaled} AS weight) FROM ({summed}))")
            at += 1
    ctes += [
        f"f AS (SELECT *, ({share} * sum(tokens) OVER () - coalesce(sum(tokens) OVER (ORDER BY weight DESC, source, lang, topic ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))"
        f" / sum(tokens * weight) OVER (ORDER BY weight DESC, source, lang, topic ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS factor FROM w{at} WHERE tokens > 0)",
        "g AS (SELECT max_by(factor, weight) AS by_, count(*) AS found FROM f WHERE factor * weight <= 1)",
        f"p AS (SELECT source, lang, topic, round(weight, 6) AS weight, round(CASE WHEN tokens = 0 OR found = 0 THEN 1.0::DOUBLE ELSE least(1.0, weight * by_) END, 6) AS p FROM w{at}, g)",
    ]
    return "WITH " + ",\n".join(ctes) + f"""
SELECT doc_id, nullif(source, chr(1)) AS source, nullif(lang, chr(1)) AS lang, topic, tokens, weight, p,
  ('0x' || substr(md5('{seed}:' || coalesce(doc_id::VARCHAR, '')), 1, 13))::BIGINT / 4503599627370496.0::DOUBLE < p AS kept
FROM d JOIN p USING (source, lang, topic)"""
