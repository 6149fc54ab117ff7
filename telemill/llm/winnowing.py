"""Document fingerprints by winnowing.

A rolling hash is taken of every run of ``gram`` characters (code points, as they are). Of every
``window`` hashes in a row the smallest is selected, the rightmost of equal ones, and kept with its
position. So two texts that share a run of ``gram + window - 1`` characters share a selected hash,
and nothing shorter than ``gram`` characters counts.
"""

from __future__ import annotations

import base64
import hashlib
from bisect import bisect_right
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from telemill.llm.words import mixed, slices

GRAM, WINDOW = 16, 16
#: Of long texts, so many windows are looked at at once.
SEGMENT = 1 << 19
BASE = 0x9E3779B97F4A7C15
OUT_BYTES = 4 << 20

_powers = np.ones((2, 1), np.uint64)


def _powers_of_base(n: int) -> np.ndarray:
    """Powers of ``BASE`` and of its inverse modulo 2 ** 64, ``n`` at least; only the longest are kept."""
    global _powers
    if _powers.shape[1] < n:
        step = np.ones((2, 1 << max(12, (n - 1).bit_length())), np.uint64)
        step[0, 1:], step[1, 1:] = np.uint64(BASE), np.uint64(pow(BASE, -1, 1 << 64))
        _powers = np.cumprod(step, axis=1, dtype=np.uint64)
    return _powers


def gram_hashes(points: np.ndarray, gram: int = GRAM) -> np.ndarray:
    """Hash of every run of ``gram`` code points; a shorter text is one run, an empty one has none.

    The hash rolls: it comes from the difference of two running sums of a polynomial.
    """
    gram = min(gram, len(points))
    if not gram:
        return np.zeros(0, np.uint64)
    powers, inverse = _powers_of_base(len(points))
    sums = np.zeros(len(points) + 1, np.uint64)
    np.cumsum(mixed(points.astype(np.uint64) + np.uint64(1)) * powers[: len(points)], out=sums[1:])
    runs = (sums[gram:] - sums[:-gram]) * inverse[: len(points) - gram + 1]
    return mixed(runs + np.uint64(gram))


def window_minima(hashes: np.ndarray, window: int = WINDOW) -> np.ndarray:
    """Position of the rightmost smallest hash of each window, every position once, in order."""
    window = min(window, len(hashes))
    if not window:
        return np.zeros(0, np.int64)
    best, span = np.arange(len(hashes)), 1
    while span < window:
        step = min(span, window - span)
        left, right = best[:-step], best[step:]
        best = np.where(hashes[right] <= hashes[left], right, left)
        span += step
    return best[np.concatenate([[True], best[1:] != best[:-1]])]


def winnow(text: str | None, gram: int = GRAM, window: int = WINDOW) -> tuple[np.ndarray, np.ndarray]:
    """Positions and hashes that stand for a whole text; none for null and empty texts."""
    points = np.frombuffer((text or "").encode("utf-32-le", "surrogatepass"), np.uint32)
    found = []
    for start in range(0, max(1, len(points) - gram - window + 2), SEGMENT):
        hashes = gram_hashes(points[start : start + SEGMENT + gram + window - 2], gram)
        at = window_minima(hashes, window)
        found.append((at + start, hashes[at]))
    positions, hashes = (np.concatenate(x) for x in zip(*found))
    new = np.diff(positions, prepend=-1) > 0
    return positions[new], hashes[new]


def encode(positions: np.ndarray, hashes: np.ndarray) -> str:
    """A fingerprint as text: gaps of the positions, a point, the upper 32 bits of the hashes."""
    gaps = np.diff(positions, prepend=0).astype(np.uint8)
    return "{}.{}".format(*(base64.b64encode(x.tobytes()).decode() for x in (gaps, (hashes >> np.uint64(32)).astype("<u4"))))


def decode(fingerprint: str) -> tuple[np.ndarray, np.ndarray]:
    gaps, hashes = (base64.b64decode(x) for x in fingerprint.split("."))
    return np.cumsum(np.frombuffer(gaps, np.uint8).astype(np.int64)), np.frombuffer(hashes, "<u4")


def likeness(one: np.ndarray, two: np.ndarray) -> float:
    """Jaccard similarity of two sets of hashes; 1 if both are empty."""
    both = len(np.intersect1d(one, two, assume_unique=True))
    return both / (len(one) + len(two) - both) if len(one) or len(two) else 1.0


def _check(gram: int, window: int) -> None:
    if gram < 1 or not 1 <= window <= 255:
        raise ValueError("gram has to be positive, window from 1 to 255")


def fingerprints(docs: DataFrame, gram: int = GRAM, window: int = WINDOW, column: str = "text") -> DataFrame:
    """All columns of ``docs`` and ``positions array<int>, hashes array<long>`` of every whole text.

    Null and empty texts have empty arrays; a text shorter than ``gram`` has one hash, of all of it.
    Columns of these two names are replaced.
    """
    _check(gram, window)
    kind = "struct<positions:array<int>,hashes:array<long>>"

    @F.pandas_udf(kind)
    def marks(texts: pd.Series) -> pd.DataFrame:
        pairs = [winnow(t, gram, window) for t in texts]
        return pd.DataFrame({"positions": [p.astype(np.int32) for p, _ in pairs], "hashes": [h.view(np.int64) for _, h in pairs]})

    rows = docs.drop("positions", "hashes").withColumn("__marks", marks(F.col(column)))
    return rows.withColumns({"positions": F.col("__marks.positions"), "hashes": F.col("__marks.hashes")}).drop("__marks")


def shared_marks(prints: DataFrame, key: str = "doc_id") -> DataFrame:
    """``hash, members, first``: the hashes that more than one row selects, with the number of rows
    and the smallest key and position, from ``fingerprints``. Only pre-aggregated rows travel."""
    marks = prints.select(key, F.explode(F.arrays_zip("positions", "hashes")).alias("mark"))
    marks = marks.groupBy(F.col("mark.hashes").alias("hash"), key).agg(F.min("mark.positions").alias("position"))
    place = F.struct(F.col(key), F.col("position"))
    return marks.groupBy("hash").agg(F.count("*").alias("members"), F.min(place).alias("first")).filter("members > 1")


# --- texts, their edited forms and the next documents -----------------------------------------

ROW = "part long, without boolean, rank long, print long, guest boolean, doc_id long, text string, copies long"
OUT = (
    "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string,"
    " near_edited double, near_next double, copies long"
)


def edited_text(text: str, following: str) -> str:
    """The text with its last half (rounded down) replaced by as much of the following one's start."""
    half = len(text) // 2
    return text[: len(text) - half] + following[:half]


class Pass:
    """Goes through rows in order, each text meeting the one after it."""

    def __init__(self, gram: int, window: int):
        self.gram, self.window = gram, window
        self.part = self.held = None
        self.rows, self.size = [], 0

    def marked(self, text: str) -> tuple[str, np.ndarray]:
        positions, hashes = winnow(text, self.gram, self.window)
        return encode(positions, hashes), np.unique(hashes)

    def say(self, doc_id: int | None, text: str, own: tuple, after: str, of_after: tuple, copies: int) -> None:
        changed = edited_text(text, after)
        other = own if changed == text else self.marked(changed)
        digest = hashlib.sha256(changed.encode()).hexdigest()
        likes = likeness(own[1], other[1]), likeness(own[1], of_after[1])
        self.rows.append((doc_id, len(text), digest, own[0], other[0], *likes, copies))
        self.size += len(own[0]) + len(other[0]) + 200

    def take(self, part: int, doc_id: int | None, text: str, copies: int, guest: bool) -> None:
        if part != self.part:
            self.part, self.held = part, None
        elif self.held is None:  # a further copy of the guest
            return
        if self.held is None:
            self.held = (doc_id, text, self.marked(text), copies)
            return
        last_id, last, own, n = self.held
        if not guest and (doc_id, text) == (last_id, last):
            self.held = (last_id, last, own, n + copies)
            return
        following = own if text == last else self.marked(text)
        if n > 1:  # of equal rows, each but the last is followed by itself
            self.say(last_id, last, own, last, own, n - 1)
        self.say(last_id, last, own, text, following, 1)
        self.held = None if guest else (doc_id, text, following, copies)

    def flush(self) -> pa.RecordBatch:
        names = [c.split()[0] for c in OUT.split(",")]
        kinds = [pa.int64(), pa.int64(), *[pa.string()] * 3, pa.float64(), pa.float64(), pa.int64()]
        columns = zip(*self.rows) if self.rows else [[]] * len(names)
        batch = pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names)
        self.rows, self.size = [], 0
        return batch


def edited_likeness(docs: DataFrame, gram: int = GRAM, window: int = WINDOW) -> DataFrame:
    """Every row of ``docs`` (``doc_id, text``) against its edited text and the next document.

    Columns ``doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited,
    near_next``. The next document is that with the next smaller id, after the smallest the one with
    the largest id; rows without id come last, rows of one id in the order of a hash of their texts,
    equal rows one after the other (each but the last is followed by its copy, the last by what
    follows them all). Null texts are empty; a single row is followed by itself. Two empty
    fingerprints are alike (1), an empty and another one are not (0). Other columns are ignored.

    Rows are dealt out by ranges of their order. The first row of each range also goes to the range
    before it, as a guest: no text travels more than once otherwise. Only the first keys of the ranges,
    as many as there are shuffle partitions, are known to the driver.
    """
    _check(gram, window)
    spark = docs.sparkSession
    key = [F.col("doc_id").isNull().alias("without"), F.coalesce(F.bitwise_not("doc_id"), F.lit(0)).cast("long").alias("rank")]
    text = F.coalesce("text", F.lit(""))
    rows = docs.select(*key, F.xxhash64(text).alias("print"), "doc_id", text.alias("text"))
    order = ["without", "rank", "print"]
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ranges = rows.select(*order).repartitionByRange(parts, *order).groupBy(F.spark_partition_id().alias("at"))
    firsts = sorted(tuple(r.first) for r in ranges.agg(F.min(F.struct(*order)).alias("first")).select("first").collect())
    known = set(firsts)

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            found: dict[tuple, int] = {}
            for row in zip(*(batch[c].to_pylist() for c in (*order, "doc_id", "text"))):
                found[row] = found.get(row, 0) + 1
            out = []
            for (*place, doc_id, body), copies in found.items():
                place = tuple(place)
                part = bisect_right(firsts, place) - 1
                out.append((part, *place, False, doc_id, body, copies))
                if place in known:
                    out.append(((part - 1) % len(firsts), *place, True, doc_id, body, 1))
            kinds = [pa.int64(), pa.bool_(), pa.int64(), pa.int64(), pa.bool_(), pa.int64(), pa.string(), pa.int64()]
            names = [c.split()[0] for c in ROW.split(", ")]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), kinds)], names)

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state = Pass(gram, window)
        for batch in slices(batches):
            for row in zip(*(batch[c].to_pylist() for c in ("part", "doc_id", "text", "copies", "guest"))):
                state.take(*row)
                if state.size > OUT_BYTES:
                    yield state.flush()
        yield state.flush()

    dealt = rows.mapInArrow(deal, ROW).repartition("part").sortWithinPartitions("part", "guest", *order, "text")
    said = dealt.mapInArrow(compare, OUT).withColumn("__copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies"))))
    return said.drop("copies", "__copy")
