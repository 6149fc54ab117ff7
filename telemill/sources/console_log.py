"""Reads window rows back out of console-sink logs (``Batch: N`` headings and piped tables).

Logs are read as splittable text. A row belongs to the last heading above it in its file, which
may lie in an earlier split of that file. So each split is summarised to its last heading, those
few summary rows are carried forward per file, and inside a split the heading is filled forward:
no task ever holds more than one split, however large a single log is.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from telemill.config import DEFAULT_RULES, RuleSet
from telemill.functions.numbers import numeric
from telemill.functions.text import strip
from telemill.operators.changelog import latest_window_state
from telemill.schema import WINDOW_COLUMNS, WINDOW_KEY

_SPLIT = ("file", "start")
_CELL_TYPES = dict(zip(WINDOW_COLUMNS, ["string"] * 3 + ["double"] * 3 + ["bigint"] * 2))


def _lines(spark: SparkSession, path: str) -> DataFrame:
    text = spark.read.text(path)
    return text.select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("start"),
        # Ids grow along a split; only their order within one split is used.
        F.monotonically_increasing_id().alias("pos"),
        strip(F.col("value")).alias("line"),
    ).withColumn("heading", F.regexp_extract("line", r"\ABatch:\s*([0-9]+)\s*\z", 1).try_cast("bigint"))


def _cells() -> Column:
    """Cells between the outer bars, stripped."""
    inner = F.regexp_extract("line", r"\A\|(.*)\|\z", 1)
    return F.transform(F.split(inner, r"\|", -1), lambda cell: strip(cell))


def _typed(cell: Column, kind: str) -> Column:
    return numeric(cell) if kind == "double" else cell.try_cast(kind)


def read_changelog_text(
    spark: SparkSession, path: str, rules: RuleSet = DEFAULT_RULES, places: bool = False
) -> DataFrame:
    """Every window row of the logs under ``path`` with the batch it was printed in.

    Lines that are not complete window rows are skipped. ``places`` adds where a row stands:
    ``file``, ``start`` of its split and ``pos`` in it. Compact with ``latest_printed_state``.
    """
    lines = _lines(spark, path)

    carried = Window.partitionBy("file").orderBy("start").rowsBetween(Window.unboundedPreceding, -1)
    ends = lines.groupBy(*_SPLIT).agg(F.max_by("heading", F.when(F.col("heading").isNotNull(), F.col("pos"))).alias("end"))
    starts = ends.select(*_SPLIT, F.last("end", ignorenulls=True).over(carried).alias("carried"))

    within = Window.partitionBy(*_SPLIT).orderBy("pos").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    relevant = lines.filter(F.col("heading").isNotNull() | F.col("line").startswith("|"))
    filled = relevant.withColumn("printed", F.last("heading", ignorenulls=True).over(within))

    rows = (
        filled.filter(F.col("heading").isNull())
        .join(starts, list(_SPLIT), "left")
        .withColumn("cells", _cells())
        .filter((F.size("cells") >= len(WINDOW_COLUMNS)) & F.col("cells")[0].startswith(rules.id_prefix))
        .select(
            *[_typed(F.get("cells", F.lit(i)), t).alias(c) for i, (c, t) in enumerate(_CELL_TYPES.items())],
            F.coalesce("printed", "carried").alias("batch_id"),
            *(["file", "start", "pos"] if places else []),
        )
    )
    complete = rows.na.drop(subset=[c for c, t in _CELL_TYPES.items() if t != "string"])
    stamps = {c: F.col(c).try_cast("timestamp") for c in ("window_start", "window_end")}
    return complete.withColumns(stamps)


def latest_printed_state(spark: SparkSession, path: str, rules: RuleSet = DEFAULT_RULES) -> DataFrame:
    """Latest row per window. Within a log the later line wins, since batch ids start again when the
    job gets a fresh checkpoint; between logs the larger batch id does."""
    rows = read_changelog_text(spark, path, rules, places=True)
    latest = Window.partitionBy("file", *WINDOW_KEY).orderBy(F.desc("start"), F.desc("pos"))
    return latest_window_state(rows.withColumn("_nth", F.row_number().over(latest)).filter("_nth = 1"))
