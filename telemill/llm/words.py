"""Words of whole texts in Arrow batches, and tables kept between jobs.

A word is a run of characters other than space and U+0009 to U+000D.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, functions as F

from telemill.sources.scratch import scratch_dir

#: Fixed value: the characters that separate words.
SPACES = " \t\n\x0b\x0c\r"
SPACE_CLASS = r"[\x20\x09-\x0D]+"
BATCH_BYTES = 4 << 20
#: Rows of one Arrow batch. Spark's default of 10,000 is for short rows; texts of that number fill
#: tens of megabytes several times over, in the JVM and in Python.
BATCH_ROWS = 2000


def in_small_batches(df: DataFrame) -> DataFrame:
    """The same rows; from now on its session hands at most ``BATCH_ROWS`` of them to Python at once."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if int(df.sparkSession.conf.get(name)) > BATCH_ROWS:
        df.sparkSession.conf.set(name, str(BATCH_ROWS))
    return df


def kept(df: DataFrame, name: str) -> DataFrame:
    """Write to the shared folder and read back: cuts lineage and survives lost executors."""
    path = scratch_dir(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def word_array(text: Column) -> Column:
    """Words as a native array column; empty for null and for texts without words."""
    trimmed = F.btrim(F.coalesce(text, F.lit("")), F.lit(SPACES))
    return F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, SPACE_CLASS))


def slices(batches: Iterator[pa.RecordBatch], column: str = "text", limit: int = BATCH_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut batches so that each holds about ``limit`` bytes of text; a longer text stands alone."""
    for batch in batches:
        size = pc.fill_null(pc.binary_length(batch[column]), 0).to_numpy(zero_copy_only=False).astype(np.int64)
        part = np.cumsum(size) // limit
        cuts = [0, *(np.flatnonzero(np.diff(part)) + 1), len(batch)]
        for a, b in zip(cuts, cuts[1:]):
            if b > a:
                yield batch.slice(a, b - a)


def split_words(texts: pa.Array, lower: bool = False) -> tuple[np.ndarray, pa.Array]:
    """Offsets of each text's words, and the words of all texts in a row."""
    texts = pc.fill_null(texts, "")
    lists = pc.ascii_split_whitespace(pc.ascii_lower(texts) if lower else texts)
    flat, offsets = lists.flatten(), lists.offsets.to_numpy().astype(np.int64)
    filled = pc.not_equal(flat, "")
    before = np.concatenate([[0], np.cumsum(filled.to_numpy(zero_copy_only=False))])
    return before[offsets - offsets[0]], flat.filter(filled)


#: The key of pandas.
HASH_KEY = "0123456789123456"


def hash_words(words: pa.Array, key: str = HASH_KEY) -> np.ndarray:
    """64-bit keyed hashes of words; each different word is hashed once."""
    codes = words.dictionary_encode()
    if not len(codes.dictionary):
        return np.zeros(0, np.uint64)
    hashed = pd.util.hash_array(codes.dictionary.to_numpy(zero_copy_only=False), hash_key=key, categorize=False)
    return hashed[codes.indices.to_numpy()]


def mixed(x: np.ndarray) -> np.ndarray:
    """Spread the bits of unsigned 64-bit values (the finaliser of SplitMix64)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def ragged(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Indices start, start + 1, ... of each run, one run after the other."""
    ends = np.cumsum(sizes)
    total = int(ends[-1]) if len(ends) else 0
    return np.repeat(starts - (ends - sizes), sizes) + np.arange(total)
