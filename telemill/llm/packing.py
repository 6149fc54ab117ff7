"""Best-fit packing into sequences of several permitted lengths."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from telemill.llm.words import in_small_batches, kept, slices, split_words

CAPACITIES = (512, 1024, 2048, 4096, 8192)
OVERHEAD = 64
#: Sequence length at which attention costs as much as all else: a sequence of c words costs c * c / ATTENTION more.
ATTENTION = 65_536
SHARD_PIECES = 100_000


def cost(capacity: int, overhead: int = OVERHEAD, attention: int = ATTENTION) -> float:
    """What a sequence costs whatever it holds: an overhead, its words, and attention among them.

    A short sequence spends more on overhead for each word, a long one more on attention.
    """
    return overhead + capacity + capacity * capacity / attention


def best_fit(
    lengths: np.ndarray, capacities: Sequence[int] = CAPACITIES, overhead: int = OVERHEAD, attention: int = ATTENTION
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bin, offset in the bin, and bin capacity of each piece.

    Pieces go, longest first, into the open bin whose free room exceeds them least. Where none has
    room, a bin opens whose size has the least ``cost`` for each word that can still fill it: usually
    the size whose overhead and attention balance, a larger one for pieces that need it, a smaller one
    when few words are left. In the end each bin shrinks to the smallest permitted size that holds it.
    """
    sizes = sorted(capacities)
    order = np.argsort(-lengths, kind="stable")
    bins, offsets = np.empty(len(lengths), np.int64), np.empty(len(lengths), np.int64)
    opened: list[int] = []
    filled: list[int] = []
    by_room: dict[int, list[int]] = {}
    rooms = 0  # bit r is set if a bin has r words free
    left = int(lengths.sum())
    for i in order:
        n = int(lengths[i])
        fitting = rooms >> n
        if fitting:
            room = n + (fitting & -fitting).bit_length() - 1
            b = by_room[room].pop()
            if not by_room[room]:
                rooms &= ~(1 << room)
        else:
            room = min((c for c in sizes if c >= n), key=lambda c: cost(c, overhead, attention) / min(c, left))
            b = len(opened)
            opened.append(room)
            filled.append(0)
        bins[i], offsets[i] = b, filled[b]
        filled[b] += n
        left -= n
        if room > n:
            by_room.setdefault(room - n, []).append(b)
            rooms |= 1 << (room - n)
    shrunk = np.array(sizes)[np.searchsorted(sizes, filled)] if filled else np.zeros(0, np.int64)
    return bins, offsets, shrunk[bins]


def word_counts(docs: DataFrame) -> DataFrame:
    """``doc_id, n_words``, one row per document row."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            offsets, _ = split_words(batch["text"])
            yield pa.RecordBatch.from_arrays([batch["doc_id"], pa.array(np.diff(offsets))], ["doc_id", "n_words"])

    return in_small_batches(docs).select("doc_id", "text").mapInArrow(count, "doc_id long, n_words long")


def pack(
    docs: DataFrame,
    capacities: Sequence[int] = CAPACITIES,
    overhead: int = OVERHEAD,
    attention: int = ATTENTION,
    shard_pieces: int = SHARD_PIECES,
) -> DataFrame:
    """Pieces of all documents with their place in a sequence.

    Columns ``doc_id, piece, start, n_words, bin_id, bin_offset, capacity``: words ``start`` to
    ``start + n_words`` of the document stand at ``bin_offset`` of sequence ``bin_id``. Longer
    documents are cut at the largest capacity. Every row counts, also repeated ones and those
    without id; null or empty texts take no room and have a null ``bin_id`` and ``capacity``.

    Shards of about ``shard_pieces`` pieces are packed on their own, so no task grows with the
    input; only ids and lengths are moved.
    """
    largest = max(capacities)
    counted = kept(word_counts(docs).withColumn("row", F.monotonically_increasing_id()), "lengths")
    cuts = F.sequence(F.lit(0), F.greatest(F.lit(0), (F.col("n_words") - 1).cast("int") / F.lit(largest)).cast("int"))
    pieces = counted.select("row", "doc_id", F.col("n_words").alias("all_words"), F.explode(cuts).alias("piece"))
    start = F.col("piece").cast("long") * largest
    pieces = pieces.select(
        "row", "doc_id", "piece", start.alias("start"), F.least(F.lit(largest), F.col("all_words") - start).alias("n_words")
    )
    shards = pieces.count() // shard_pieces + 1
    shard = F.pmod(F.xxhash64("row", "piece"), F.lit(shards)).alias("shard")

    def fill(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["row", "piece"], ignore_index=True)
        bins, offsets, sizes = best_fit(rows["n_words"].to_numpy(), capacities, overhead, attention)
        rows["bin_id"] = (rows["shard"].to_numpy() << 32) + bins
        rows["bin_offset"], rows["capacity"] = offsets, sizes
        return rows[names]

    names = ["doc_id", "piece", "start", "n_words", "bin_id", "bin_offset", "capacity"]
    schema = "doc_id long, piece int, start long, n_words long, bin_id long, bin_offset long, capacity long"
    packed = pieces.filter("n_words > 0").select("*", shard).groupBy("shard").applyInPandas(fill, schema)
    empty = pieces.filter("n_words <= 0").select(
        "doc_id", "piece", "start", "n_words", *[F.lit(None).cast("long").alias(c) for c in names[4:]]
    )
    return packed.unionByName(empty)
