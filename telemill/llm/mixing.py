"""A low-discrepancy schedule that mixes sources to target weights."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from telemill.llm.words import kept, word_array

SHARE = 1.5
WEIGHTS = (5, 2, 1)
LAPS = 2
BLOCK_WORDS = 8192
LEAST_BLOCKS = 128
#: Fixed value: the golden ratio's fractional part.
GOLDEN = 0.6180339887498949
CELLS = 1024
SLOT_CHUNK = 1 << 16


def running(df: DataFrame, keys: Sequence[str], coarse: Column, order: Sequence[str], value: Column, name: str) -> DataFrame:
    """Sum of ``value`` over earlier rows of the same ``keys``.

    Totals of the coarse parts are added up first, so no task sorts all rows of one key. ``coarse``
    has to agree with ``order``.
    """
    df = df.withColumn("coarse", coarse)
    parts = df.groupBy(*keys, "coarse").agg(F.sum(value).alias("part"))
    before = Window.partitionBy(*keys).orderBy("coarse").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.select(*keys, "coarse", F.coalesce(F.sum("part").over(before), F.lit(0).cast("long")).alias("base"))
    inner = Window.partitionBy(*keys, "coarse").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    own = F.coalesce(F.sum(value).over(inner), F.lit(0).cast("long"))
    return df.join(parts, [*keys, "coarse"]).withColumn(name, F.col("base") + own).drop("base", "coarse")


def source_targets(sizes: DataFrame, share: float = SHARE, weights: Sequence[int] = WEIGHTS, laps: int = LAPS) -> DataFrame:
    """``sid, source, source_size, target``: one row per source, in code point order, null last.

    ``share`` times all words is dealt out by weight. Sources whose part would exceed ``laps``
    times their size get just that; the level of the others is found from sums over the sources
    in the order in which they fill up.
    """
    totals = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    order = Window.orderBy(F.col("source").asc_nulls_last())
    totals = totals.withColumn("sid", F.row_number().over(order))
    weight = F.element_at(F.array(*[F.lit(w) for w in weights]), ((F.col("sid") - 1) % len(weights) + 1).cast("int"))
    totals = totals.withColumn("weight", weight).withColumn("cap", laps * F.col("source_size"))
    fill = Window.orderBy(F.col("cap") / F.col("weight"), "sid")
    everything = Window.orderBy(F.col("cap") / F.col("weight"), "sid").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    full = F.coalesce(F.sum("cap").over(fill.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    open_ = F.sum("weight").over(fill.rowsBetween(0, Window.unboundedFollowing))
    level = (F.lit(share) * F.sum("source_size").over(everything) - full) / open_
    totals = totals.withColumn("own_level", level)
    fits = F.when(F.col("cap") / F.col("weight") >= F.col("own_level"), F.col("own_level"))
    totals = totals.withColumn("level", F.first(fits, ignorenulls=True).over(everything))
    part = F.col("level") * F.col("weight")
    target = F.when(part < F.col("cap"), part).otherwise(F.col("cap").cast("double"))
    return totals.select("sid", "source", "source_size", target.alias("target"))


def schedule(blocks: DataFrame) -> DataFrame:
    """``sid, slot, rank``: which source each slot of the mix takes its next block from.

    ``blocks`` has ``sid, target, block``. Slot i stands at the fractional part of (i + 0.5) times
    the golden ratio, in the interval of its source; the widths are the sources' numbers of slots.
    Any stretch of the schedule therefore has the sources nearly in proportion.
    """
    wanted = F.col("target") / F.col("block")
    order = Window.orderBy("sid").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    everything = Window.orderBy("sid").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    high = F.sum(wanted).over(order) / F.sum(wanted).over(everything)
    spans = blocks.filter("target > 0").select("sid", wanted.alias("wanted"), high.alias("high"))
    low = F.coalesce(F.lag("high").over(Window.orderBy("sid")), F.lit(0.0))
    spans = kept(spans.withColumn("low", low), "spans")
    slots = spans.agg(F.round(F.sum("wanted")).cast("long")).first()[0] or 0
    cells = F.sequence(F.floor(F.col("low") * CELLS), F.floor(F.col("high") * CELLS))
    spans = spans.withColumn("cell", F.explode(cells)).withColumn("last", F.col("high") == 1.0)
    at = (F.col("slot") + F.lit(0.5)) * GOLDEN
    points = blocks.sparkSession.range(slots).withColumnRenamed("id", "slot")
    points = points.withColumn("at", at - F.floor(at)).withColumn("cell", F.floor(F.col("at") * CELLS))
    inside = (F.col("at") >= F.col("low")) & ((F.col("at") < F.col("high")) | F.col("last"))
    drawn = points.join(spans, "cell").filter(inside).select("sid", "slot")
    coarse = F.floor(F.col("slot") / SLOT_CHUNK)
    return running(drawn, ["sid"], coarse, ["slot"], F.lit(1).cast("long"), "rank")


def mix(
    docs: DataFrame,
    share: float = SHARE,
    weights: Sequence[int] = WEIGHTS,
    laps: int = LAPS,
    block_words: int = BLOCK_WORDS,
    least_blocks: int = LEAST_BLOCKS,
    row: str | None = None,
) -> DataFrame:
    """What a mix of ``share`` times all words takes of each row of ``docs``.

    Columns ``doc_id, size, source_size, target, taken, by_lap`` and ``row``, if named. Each
    source's documents, shuffled by the MD5 of their id, form one stream, cut into blocks of equal
    numbers of words (the last may be shorter): ``block_words``, or less where a source would have
    under ``least_blocks``. The schedule's slots take the blocks in order, in at most ``laps``
    rounds; ``by_lap`` has the words of each round, always the document's first ones.

    Null texts and texts without words have size 0 and give nothing; null is a source too, repeated
    rows count each, an empty table gives an empty result. Reruns agree, whatever the partitions:
    only equal rows can change places.
    """
    words = F.regexp_count(F.coalesce("text", F.lit("")), F.lit(r"[^\x20\x09-\x0D]+")).cast("long")
    number = F.col(row) if row else F.monotonically_increasing_id()
    key = F.md5(F.coalesce(F.col("doc_id").cast("string"), F.lit("")))
    sizes = kept(docs.select(number.alias("row"), "doc_id", "source", words.alias("size"), key.alias("key")), "sizes")
    targets = source_targets(sizes, share, weights, laps)
    block = F.greatest(F.lit(1), F.least(F.lit(block_words), F.floor(F.col("source_size") / least_blocks)))
    sources = kept(targets.withColumn("block", block.cast("long")), "sources")

    named = sources.withColumnRenamed("source", "of")
    placed = sizes.join(named, sizes["source"].eqNullSafe(named["of"])).drop("of", "source")
    placed = running(placed, ["sid"], F.substring("key", 1, 3), ["key", "size", "row"], F.col("size"), "start")
    placed = kept(placed.drop("key"), "placed")
    end = F.col("start") + F.col("size")
    first, last = F.expr("start div block"), F.expr("(start + size - 1) div block")
    pieces = placed.filter("size > 0").withColumn("block_no", F.explode(F.sequence(first, last)))
    begin, stop = F.col("block_no") * F.col("block"), (F.col("block_no") + 1) * F.col("block")
    words_in = (F.least(end, stop) - F.greatest(F.col("start"), begin)).alias("words")
    pieces = pieces.select("row", "sid", "block_no", words_in)

    counts = F.ceil(F.col("source_size") / F.col("block"))
    rounds = schedule(sources).join(sources.select("sid", counts.alias("blocks")), "sid")
    rounds = rounds.filter(F.col("rank") < F.col("blocks") * laps)
    rounds = rounds.groupBy("sid", (F.col("rank") % F.col("blocks")).alias("block_no")).agg(F.count("*").alias("times"))
    per_lap = [F.sum(F.when(F.col("times") > i, F.col("words")).otherwise(0)).alias(f"lap{i}") for i in range(laps)]
    taken = pieces.join(rounds, ["sid", "block_no"]).groupBy("row").agg(*per_lap)
    zero = F.lit(0).cast("long")
    by_lap = F.array(*[F.coalesce(f"lap{i}", zero) for i in range(laps)])
    return placed.join(taken, "row", "left").select(
        *([F.col("row").alias(row)] if row else []),
        "doc_id",
        "size",
        "source_size",
        "target",
        F.aggregate(by_lap, zero, lambda a, n: a + n).alias("taken"),
        by_lap.alias("by_lap"),
    )


def mixed_documents(docs: DataFrame, **settings) -> DataFrame:
    """The mix as documents: one row for each document and round that takes words of it.

    Whole documents stay as they are; of others the first words remain, joined by single spaces,
    and ``n_chars`` is their new length. Documents of which nothing is taken are absent. Names of
    columns that begin with two underscores are reserved.
    """
    rows = kept(docs.withColumn("__row", F.monotonically_increasing_id()), "mix_rows")
    taken = mix(rows, row="__row", **settings).select("__row", F.col("size").alias("__size"), F.explode("by_lap").alias("__words"))
    whole = F.col("__words") == F.col("__size")
    part = F.array_join(F.slice(word_array(F.col("text")), F.lit(1), F.col("__words").cast("int")), " ")
    cut = rows.join(taken.filter("__words > 0"), "__row").withColumn("text", F.when(whole, F.col("text")).otherwise(part))
    return cut.withColumn("n_chars", F.char_length("text").cast("long")).select(*docs.columns)


SQL = r"""
WITH z AS (
  SELECT doc_id, source, md5(coalesce(CAST(doc_id AS VARCHAR), '')) AS key,
         CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size FROM documents),
a AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM z GROUP BY source),
b AS (SELECT *, row_number() OVER (ORDER BY source NULLS LAST) AS sid FROM a),
c AS (SELECT *, CASE (sid - 1) % 3 WHEN 0 THEN 5 WHEN 1 THEN 2 ELSE 1 END AS weight, 2 * source_size AS cap FROM b),
d AS (
  SELECT *, (1.5::DOUBLE * (SELECT CAST(sum(source_size) AS BIGINT) FROM c)
             - coalesce(CAST(sum(cap) OVER (ORDER BY cap::DOUBLE / weight, sid
                        ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS BIGINT), 0))
            / CAST(sum(weight) OVER (ORDER BY cap::DOUBLE / weight, sid
                   ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS BIGINT) AS own FROM c),
e AS (SELECT own AS level FROM d WHERE cap::DOUBLE / weight >= own ORDER BY cap::DOUBLE / weight, sid LIMIT 1),
f AS (
  SELECT sid, source, source_size, CASE WHEN level * weight < cap THEN level * weight ELSE cap::DOUBLE END AS target,
         greatest(1, least(8192, source_size // 128)) AS block FROM d CROSS JOIN e),
g AS (
  SELECT sid, target / block AS wanted, sum(target / block) OVER (ORDER BY sid) / (SELECT sum(target / block) FROM f) AS high
  FROM f WHERE target > 0),
h AS (SELECT *, coalesce(lag(high) OVER (ORDER BY sid), 0) AS low, sid = (SELECT max(sid) FROM g) AS top FROM g),
i AS (SELECT unnest(range(0, (SELECT CAST(round(sum(wanted)) AS BIGINT) FROM g))) AS slot),
j AS (SELECT slot, (slot + 0.5::DOUBLE) * 0.6180339887498949::DOUBLE
             - floor((slot + 0.5::DOUBLE) * 0.6180339887498949::DOUBLE) AS at FROM i),
k AS (
  SELECT h.sid, row_number() OVER (PARTITION BY h.sid ORDER BY slot) - 1 AS rank
  FROM j JOIN h ON j.at >= h.low AND (j.at < h.high OR h.top)),
l AS (
  SELECT k.sid, rank % CAST(ceil(source_size / block) AS BIGINT) AS block_no, count(*) AS times
  FROM k JOIN f USING (sid) WHERE rank < 2 * CAST(ceil(source_size / block) AS BIGINT) GROUP BY ALL),
m AS (
  SELECT doc_id, size, sid, source_size, target, block,
         CAST(coalesce(sum(size) OVER (PARTITION BY sid ORDER BY key, size
              ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS start
  FROM z JOIN f ON z.source IS NOT DISTINCT FROM f.source),
n AS (SELECT *, unnest(range(start // block, (start + size - 1) // block + 1)) AS block_no FROM m WHERE size > 0),
o AS (
  SELECT doc_id, sum(times * (least(start + size, (block_no + 1) * block) - greatest(start, block_no * block))) AS taken
  FROM n JOIN l USING (sid, block_no) GROUP BY doc_id)
SELECT doc_id, size, source_size, target, CAST(coalesce(taken, 0) AS BIGINT) AS taken FROM m LEFT JOIN o USING (doc_id)
"""
