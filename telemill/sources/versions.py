"""Stored versions of the compacted state, with per-vehicle rollups, and their retention.

Under ``compacted/telemetry`` every compaction writes the event dates it touched into folders of its own
(``date=D/version=V``), rollups of them next to it, and then one manifest that names the folder of every
date. The manifest appears under its number by a single rename that fails if the number is taken, so
a version is there as a whole or not at all, and of two compactions at once one fails. Readers take the
newest manifest and list only the folders it names.

A manifest also tells which batches it holds, batch by batch and not by a largest number, so batches of
an older run that come later are still merged. Merging is idempotent: of each window the row of the
largest batch wins.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Iterable
from dataclasses import asdict, dataclass, field
from functools import reduce
from operator import or_

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import StringType, StructField, StructType

from telemill.operators import changelog as cl, rollups
from telemill.schema import CHANGELOG, WINDOW_COLUMNS
from telemill.sources.curated import CURATED_DIR, event_date, read_curated

COMPACTED_DIR = "compacted/telemetry"
ROLLUP_DIR = "rollup/telemetry"
_PLACE = [StructField("date", StringType()), StructField("version", StringType())]
COMPACTED = StructType([*CHANGELOG.fields, *_PLACE])
ROLLUP = StructType([*rollups.ROLLUP.fields, *_PLACE])


class VersionConflict(RuntimeError):
    """Another compaction committed this version first."""


@dataclass(frozen=True)
class DateEntry:
    """What a version has of one event date: its folder, and facts by which readers skip it."""

    version: str
    windows: int
    fault_windows: int
    last_end: float | None


@dataclass(frozen=True)
class Batches:
    """Batches ``first`` to ``last``, all of them merged as of ``changed`` (milliseconds)."""

    first: int
    last: int
    changed: int


@dataclass(frozen=True)
class Version:
    number: int = 0
    dates: dict[str, DateEntry] = field(default_factory=dict)
    batches: list[Batches] = field(default_factory=list)

    def holds(self, batch_id: int, changed: int) -> bool:
        """Whether a batch is merged, as it stands: one written again later is not."""
        return any(b.first <= batch_id <= b.last and changed <= b.changed for b in self.batches)

    @classmethod
    def parse(cls, text: str) -> Version:
        raw = json.loads(text)
        dates = {d: DateEntry(**e) for d, e in raw["dates"].items()}
        return cls(raw["number"], dates, [Batches(**b) for b in raw["batches"]])


# --- manifests ---------------------------------------------------------------------------------


def _manifests(base: str) -> str:
    return f"{base}/{COMPACTED_DIR}/_manifests"


def _path(spark: SparkSession, path: str):
    return spark._jvm.org.apache.hadoop.fs.Path(path)


def _fs(spark: SparkSession, path: str):
    return _path(spark, path).getFileSystem(spark._jsc.hadoopConfiguration())


def _delete(spark: SparkSession, path: str) -> None:
    _fs(spark, path).delete(_path(spark, path), True)


def version_numbers(spark: SparkSession, base: str) -> list[int]:
    """Numbers of the versions that can be read, in order."""
    fs, folder = _fs(spark, base), _path(spark, _manifests(base))
    names = [s.getPath().getName() for s in fs.listStatus(folder)] if fs.exists(folder) else []
    return sorted(int(n.removesuffix(".json")) for n in names if n.endswith(".json"))


def read_version(spark: SparkSession, base: str, number: int | None = None) -> Version:
    """The manifest of a version, the newest unless told; without any, the empty version 0."""
    numbers = version_numbers(spark, base)
    if number == 0 or (number is None and not numbers):
        return Version()
    if number is not None and number not in numbers:
        raise ValueError(f"there is no version {number}; there are {numbers}")
    stream = _fs(spark, base).open(_path(spark, f"{_manifests(base)}/{number or numbers[-1]:010d}.json"))
    try:
        return Version.parse(spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
    finally:
        stream.close()


def _commit(spark: SparkSession, base: str, version: Version) -> None:
    fs, own = _fs(spark, base), f"{_manifests(base)}/_{uuid.uuid4().hex}"
    stream = fs.create(_path(spark, own), False)
    stream.write(bytearray(json.dumps(asdict(version)).encode()))
    stream.close()
    context = spark._jvm.org.apache.hadoop.fs.FileContext.getFileContext(fs.getUri(), spark._jsc.hadoopConfiguration())
    options = spark.sparkContext._gateway.new_array(spark._jvm.org.apache.hadoop.fs.Options.Rename, 0)
    try:
        context.rename(_path(spark, own), _path(spark, f"{_manifests(base)}/{version.number:010d}.json"), options)
    except Exception as e:
        _delete(spark, own)
        if "FileAlreadyExists" in str(e):
            raise VersionConflict(f"version {version.number} is there already") from None
        raise


# --- batches -------------------------------------------------------------------------------------


def stored_batches(spark: SparkSession, base: str) -> dict[int, int]:
    """The changelog's batches that still have files, with the time of the newest (milliseconds).

    Only the listing is read, no file. Retention bounds how many there are.
    """
    try:
        files = spark.read.format("binaryFile").load(f"{base}/{CURATED_DIR}")
    except AnalysisException as e:
        if "PATH_NOT_FOUND" not in str(e):
            raise
        return {}
    if "batch_id" not in files.columns:
        return {}
    changed = F.max(F.unix_millis("modificationTime")).alias("changed")
    return {r.batch_id: r.changed for r in files.groupBy(F.col("batch_id").cast("bigint")).agg(changed).collect()}


def pending_batches(spark: SparkSession, base: str, version: Version) -> dict[int, int]:
    """Stored batches that ``version`` does not hold."""
    return {b: t for b, t in stored_batches(spark, base).items() if not version.holds(b, t)}


def _runs(ids: Iterable[int]) -> list[tuple[int, int]]:
    """Consecutive numbers as first and last."""
    found: list[tuple[int, int]] = []
    for i in sorted(ids):
        if found and found[-1][1] == i - 1:
            found[-1] = (found[-1][0], i)
        else:
            found.append((i, i))
    return found


def _changes(spark: SparkSession, base: str, batches: Iterable[int]) -> DataFrame:
    """Rows of some batches with their event date; other batches' folders are pruned."""
    runs = _runs(batches)
    if not runs:
        rows = spark.createDataFrame([], CHANGELOG)
    else:
        wanted = reduce(or_, [F.col("batch_id").between(a, b) for a, b in runs])
        rows = read_curated(spark, base).filter(wanted).select(*WINDOW_COLUMNS, "batch_id")
    return rows.withColumn("date", F.coalesce(event_date(), F.lit("unknown")))


# --- reading -------------------------------------------------------------------------------------


def _stored(spark: SparkSession, base: str, folder: str, schema: StructType, dates: dict[str, DateEntry]) -> DataFrame:
    root = f"{base}/{folder}"
    if not dates:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).option("basePath", root).parquet(*[f"{root}/date={d}/version={e.version}" for d, e in dates.items()])


def _only(version: Version, wanted: Callable[[str], bool]) -> dict[str, DateEntry]:
    return {d: e for d, e in version.dates.items() if wanted(d)}


def read_stored(spark: SparkSession, base: str, number: int | None = None) -> DataFrame:
    """The state exactly as one version has it, without batches that came since."""
    version = read_version(spark, base, number)
    return _stored(spark, base, COMPACTED_DIR, COMPACTED, version.dates).select(*WINDOW_COLUMNS, "batch_id")


def _merged(spark: SparkSession, base: str, version: Version, wanted: Callable[[str], bool], pending: Iterable[int], only: Column | None = None) -> DataFrame:
    changes = _changes(spark, base, pending)
    rows = _stored(spark, base, COMPACTED_DIR, COMPACTED, _only(version, wanted)).select(*changes.columns)
    rows = rows.unionByName(changes) if pending else rows
    return rows if only is None else rows.filter(only)


def read_compacted_state(spark: SparkSession, base: str, dates: tuple[str, str] | None = None) -> DataFrame:
    """Latest state per window: the newest version and the batches it does not hold yet.

    ``dates`` (first, last) selects event dates; folders of others are not listed.
    """
    version = read_version(spark, base)
    inside = (lambda d: dates[0] <= d <= dates[1]) if dates else lambda d: True
    only = F.col("date").between(*dates) if dates else None
    return cl.latest_window_state(_merged(spark, base, version, inside, pending_batches(spark, base, version), only))


# --- compaction ----------------------------------------------------------------------------------


def compact(spark: SparkSession, base: str, up_to_batch: int | None = None) -> Version:
    """Merge the batches the newest version does not hold into a new one; returns the version.

    ``up_to_batch`` leaves larger batches for later. Only the event dates that the batches touch are
    read and written again. Nothing pending: no new version. A compaction that fails leaves folders
    that no manifest names, for ``expire`` to remove.
    """
    old, stored = read_version(spark, base), stored_batches(spark, base)
    pending = {b: t for b, t in stored.items() if not old.holds(b, t) and (up_to_batch is None or b <= up_to_batch)}
    if not pending:
        return old
    touched = {r.date for r in _changes(spark, base, pending).select("date").distinct().collect()}
    rows = cl.latest_window_state(_merged(spark, base, old, touched.__contains__, pending))
    name = f"{old.number + 1:010d}-{uuid.uuid4().hex[:8]}"
    place = {"date": F.coalesce(event_date(), F.lit("unknown")), "version": F.lit(name)}
    # ranges of the whole key: a large date has several files, a small one shares a task with others
    laid_out = rows.withColumns(place).repartitionByRange("date", "window_start", "vehicle_id")
    laid_out = laid_out.sortWithinPartitions("date", "window_start", "vehicle_id")
    laid_out.write.mode("append").partitionBy("date", "version").parquet(f"{base}/{COMPACTED_DIR}")

    fresh = {d: DateEntry(name, 0, 0, None) for d in touched}
    state = _stored(spark, base, COMPACTED_DIR, COMPACTED, fresh)
    summed = rollups.vehicle_rollups(state, "date").withColumn("version", F.lit(name))
    summed = summed.repartitionByRange("date", "vehicle_id").sortWithinPartitions("date", "vehicle_id")
    summed.write.mode("append").partitionBy("date", "version").parquet(f"{base}/{ROLLUP_DIR}")
    facts = _stored(spark, base, ROLLUP_DIR, ROLLUP, fresh).groupBy("date").agg(
        F.sum("windows").alias("windows"), F.sum("fault_windows").alias("fault_windows"), F.unix_micros(F.max("last_end")).alias("last_end")
    )
    fresh = {r.date: DateEntry(name, r.windows, r.fault_windows, None if r.last_end is None else r.last_end / 1e6) for r in facts.collect()}
    # batches whose folders are gone need no mention: if one came back, merging it again would change nothing
    held = [b for b in old.batches if any(b.first <= i <= b.last for i in stored.keys() - pending.keys())]
    held += [Batches(a, b, max(pending[i] for i in range(a, b + 1))) for a, b in _runs(pending)]
    new = Version(old.number + 1, old.dates | fresh, held)
    _commit(spark, base, new)
    return new


def expire(spark: SparkSession, base: str, keep: int = 1, batches: bool = True) -> list[str]:
    """Remove what the newest ``keep`` versions do not need; returns the folders removed.

    Older manifests go first, then folders of dates that no kept manifest names, those of failed
    compactions included, and, unless ``batches`` is false, folders of the changelog that every kept
    version holds. Readers of a version being expired fail; keep as many versions as they need.
    """
    if keep < 1:
        raise ValueError("at least one version has to be kept")
    numbers = version_numbers(spark, base)
    if not numbers:
        return []
    kept = [read_version(spark, base, n) for n in numbers[-keep:]]
    for n in numbers[:-keep]:
        _delete(spark, f"{_manifests(base)}/{n:010d}.json")
    needed = {(d, e.version) for v in kept for d, e in v.dates.items()}
    gone = []
    for folder in (COMPACTED_DIR, ROLLUP_DIR):
        for status in _fs(spark, base).globStatus(_path(spark, f"{base}/{folder}/date=*/version=*")):
            path = status.getPath()
            date, version = path.getParent().getName()[5:], path.getName()[8:]
            # a larger number is a compaction at work
            if (date, version) not in needed and int(version.split("-")[0]) <= kept[-1].number:
                gone.append(path.toString())
    stored = stored_batches(spark, base) if batches else {}
    done = {b for b, t in stored.items() if all(v.holds(b, t) for v in kept)}
    if done:
        for status in _fs(spark, base).globStatus(_path(spark, f"{base}/{CURATED_DIR}/date=*/batch_id=*")):
            if int(status.getPath().getName()[9:]) in done:
                gone.append(status.getPath().toString())
    for path in gone:
        _delete(spark, path)
    return gone


# --- what versions are good for --------------------------------------------------------------------


def version_diff(spark: SparkSession, base: str, before: int, after: int | None = None) -> DataFrame:
    """``snapshot_diff`` of two stored versions; only dates that were written between them are read."""
    old, new = read_version(spark, base, before), read_version(spark, base, after)
    changed = {d for d, e in new.dates.items() if old.dates.get(d) != e}
    state = lambda v: _stored(spark, base, COMPACTED_DIR, COMPACTED, _only(v, changed.__contains__)).select(*WINDOW_COLUMNS, "batch_id")
    return cl.snapshot_diff(state(new), state(old) if old.number else None)


def read_rollups(spark: SparkSession, base: str) -> DataFrame:
    """Rollups of the current state by date and vehicle (``rollups.ROLLUP`` and ``date``).

    Stored ones, but for dates that pending batches touch: these are summed from their windows.
    """
    version = read_version(spark, base)
    pending = pending_batches(spark, base, version)
    columns = [*rollups.ROLLUP.fieldNames(), "date"]
    touched = {r.date for r in _changes(spark, base, pending).select("date").distinct().collect()} if pending else set()
    stored = _stored(spark, base, ROLLUP_DIR, ROLLUP, _only(version, lambda d: d not in touched)).select(*columns)
    if not touched:
        return stored
    state = cl.latest_window_state(_merged(spark, base, version, touched.__contains__, pending))
    fresh = rollups.vehicle_rollups(state.withColumn("date", F.coalesce(event_date(), F.lit("unknown"))), "date")
    return stored.unionByName(fresh.select(*columns))


def newest_windows(spark: SparkSession, base: str, count: int, faults: bool = False) -> DataFrame:
    """State of the newest event dates, as many as surely hold the ``count`` newest windows.

    With ``faults`` only windows with faults count. Dates are taken newest first by the numbers in the
    manifest; a date that pending batches touch is taken but not relied on. Orderings that begin with
    the newest ``window_start`` give the same first ``count`` rows on this as on the whole state.
    """
    version = read_version(spark, base)
    pending = pending_batches(spark, base, version)
    touched = {r.date for r in _changes(spark, base, pending).select("date").distinct().collect()} if pending else set()
    chosen, sure = [], 0
    for date in sorted({*version.dates, *touched}, key=lambda d: (d != "unknown", d), reverse=True):
        if sure >= count:
            break
        chosen.append(date)
        if date not in touched:
            sure += version.dates[date].fault_windows if faults else version.dates[date].windows
    wanted = set(chosen)
    late = pending if wanted & touched else {}
    return cl.latest_window_state(_merged(spark, base, version, wanted.__contains__, late, F.col("date").isin(chosen)))


def windows_since(spark: SparkSession, base: str, end: float) -> DataFrame:
    """State of the event dates that may have windows ending at ``end`` (seconds) or later."""
    version = read_version(spark, base)
    pending = pending_batches(spark, base, version)
    touched = {r.date for r in _changes(spark, base, pending).select("date").distinct().collect()} if pending else set()
    # a millisecond more than needed, for rounding: the windows themselves are filtered by their own time
    late_enough = {d for d, e in version.dates.items() if e.last_end is not None and e.last_end + 0.001 >= end}
    wanted = late_enough | touched
    return cl.latest_window_state(_merged(spark, base, version, wanted.__contains__, pending))


def newest_end(spark: SparkSession, base: str) -> float | None:
    """End of the newest window (seconds), from the manifest and the pending batches."""
    version = read_version(spark, base)
    pending = pending_batches(spark, base, version)
    ends = [e.last_end for e in version.dates.values() if e.last_end is not None]
    if pending:
        last = _changes(spark, base, pending).agg(F.unix_micros(F.max("window_end"))).first()[0]
        ends += [] if last is None else [last / 1e6]
    return max(ends, default=None)
