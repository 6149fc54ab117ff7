"""Token ids in ORC: integer run-length encoding, row indexes, Bloom filters on document ids."""

from __future__ import annotations

import os
import sys
import types
import zlib
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from telemill.llm.words import hash_words, in_small_batches, ragged, slices, split_words

#: Words whose ids a Python worker keeps from task to task, about 40 bytes each.
CACHED_WORDS = 1_000_000
SLICE_BYTES = 4 << 20
LINE_WORDS = 100
STRIPE_BYTES = 64 << 20
INDEX_STRIDE = 10_000
FALSE_POSITIVES = 0.01


class WordEncoder:
    """Ids of whole texts; each different word is given to the tokenizer once while it is kept.

    Holds for tokenizers that split text at white space before anything else, such as those whose
    pre-tokenizer drops it: their ids of a text are those of its words in a row. Words are known
    by 64-bit hashes.
    """

    def __init__(self, path: str, cached: int = CACHED_WORDS):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer, self.cached = Tokenizer.from_file(path), cached
        suffix = getattr(self.tokenizer.model, "end_of_word_suffix", None)
        self.ends = np.zeros(max(self.tokenizer.get_vocab().values(), default=0) + 1, bool)
        if suffix:
            self.ends[[i for t, i in self.tokenizer.get_vocab().items() if t.endswith(suffix)]] = True
        self.hashes = np.zeros(0, np.uint64)
        self.starts, self.sizes, self.used = (np.zeros(0, np.int64) for _ in range(3))
        self.flat = np.zeros(0, np.int32)

    def _forget(self) -> None:
        """Drop the words that were met once."""
        keep = self.used > 1
        self.flat = self.flat[ragged(self.starts[keep], self.sizes[keep])]
        self.hashes, self.sizes = self.hashes[keep], self.sizes[keep]
        self.starts, self.used = np.cumsum(self.sizes) - self.sizes, np.ones(len(self.sizes), np.int64)

    def _encode(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all words in a row, and how many each has.

        Words of letters go in lines of ``LINE_WORDS``. If a line has as many word ends as words,
        each word has one, and the ids are cut there; the words of other lines go one by one.
        """
        plain = pc.utf8_is_alpha(words).to_numpy(zero_copy_only=False) & self.ends.any()
        texts, parts = words.to_pylist(), []
        at = np.flatnonzero(plain)
        lines = [at[i : i + LINE_WORDS] for i in range(0, len(at), LINE_WORDS)]
        joined = self.tokenizer.encode_batch_fast([" ".join(texts[i] for i in line) for line in lines], add_special_tokens=False)
        single = [np.flatnonzero(~plain)]
        for line, e in zip(lines, joined):
            ids = np.array(e.ids, np.int32)
            cuts = np.flatnonzero(self.ends[ids]) + 1
            if len(cuts) == len(line) and cuts[-1] == len(ids):
                parts.append((line, ids, np.diff(cuts, prepend=0)))
            else:
                single.append(line)
        alone = np.concatenate(single)
        one_by_one = [e.ids for e in self.tokenizer.encode_batch_fast([texts[i] for i in alone], add_special_tokens=False)]
        counts = np.fromiter(map(len, one_by_one), np.int64, len(one_by_one))
        parts.append((alone, np.fromiter(chain.from_iterable(one_by_one), np.int32, int(counts.sum())), counts))
        order, ids, sizes = (np.concatenate(x) for x in zip(*parts))
        back = np.argsort(order)
        return ids[ragged((np.cumsum(sizes) - sizes)[back], sizes[back])], sizes[back]

    def _learn(self, hashes: np.ndarray, words: pa.Array) -> None:
        ids, sizes = self._encode(words)
        starts = len(self.flat) + np.cumsum(sizes) - sizes
        self.flat = np.concatenate([self.flat, ids])
        both = np.concatenate([self.hashes, hashes])
        order = np.argsort(both, kind="stable")
        self.hashes = both[order]
        self.starts, self.sizes = np.concatenate([self.starts, starts])[order], np.concatenate([self.sizes, sizes])[order]
        self.used = np.concatenate([self.used, np.zeros(len(hashes), np.int64)])[order]

    def __call__(self, texts: pa.Array, end_id: int) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts, each closed by ``end_id``, and how many each text has."""
        offsets, words = split_words(texts)
        codes = words.dictionary_encode()
        hashes = hash_words(codes.dictionary)
        if len(self.hashes) + len(hashes) > self.cached:
            self._forget()
        near = np.minimum(np.searchsorted(self.hashes, hashes), max(len(self.hashes) - 1, 0))
        new = np.flatnonzero(self.hashes[near] != hashes) if len(self.hashes) else np.arange(len(hashes))
        if len(new):
            self._learn(hashes[new], codes.dictionary.take(pa.array(new)))
        places = np.searchsorted(self.hashes, hashes)
        self.used[places] += 1
        at = places[codes.indices.to_numpy()] if len(words) else np.zeros(0, np.int64)
        tokens = self.flat[ragged(self.starts[at], self.sizes[at])]
        before = np.concatenate([[0], np.cumsum(self.sizes[at])])
        counts = before[offsets[1:]] - before[offsets[:-1]]
        closed = np.full(len(tokens) + len(counts), end_id, np.int32)
        inner = np.ones(len(closed), bool)
        inner[np.cumsum(counts + 1) - 1] = False
        closed[inner] = tokens
        return closed, counts + 1


def worker_encoder(path: str) -> WordEncoder:
    """The encoder of this Python worker, which serves one task after another."""
    kept_here = sys.modules.setdefault("telemill_worker", types.ModuleType("telemill_worker")).__dict__
    name = f"encoder {path}"
    if name not in kept_here:
        kept_here[name] = WordEncoder(path)
    return kept_here[name]


def write_tokens(docs: DataFrame, path: str, tokenizer_path: str, end_id: int) -> None:
    """Write ``doc_id, before, n_tokens, ids`` in ascending order of ``doc_id`` to ORC files.

    ``before`` counts the ids of the documents before it in the same file; files follow each other
    by their part number. Null texts are empty, their ids are the end id alone; null ids come first;
    repeated ids each have a row, ordered by text hash. The input is dealt out by ranges of id, so
    no task holds more than its share, and texts travel, not ids, which take twice the room.
    """

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, before = worker_encoder(tokenizer_path), 0
        for batch in slices(batches, limit=SLICE_BYTES):
            ids, counts = encoder(batch["text"], end_id)
            ends = np.cumsum(counts)
            lists = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], ends]), pa.int32()), pa.array(ids))
            columns = [batch["doc_id"], pa.array(before + ends - counts), pa.array(counts), lists]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "before", "n_tokens", "ids"])
            before += int(ends[-1])

    rows = in_small_batches(docs).select("doc_id", "text", F.xxhash64("text").alias("hash"), F.monotonically_increasing_id().alias("row"))
    order = ["doc_id", "hash", "row"]
    rows = rows.repartitionByRange(*order).sortWithinPartitions(*order).select("doc_id", "text")
    tokens = rows.mapInArrow(encode, "doc_id long, before long, n_tokens long, ids array<int>")
    options = {
        "compression": "zstd",
        "orc.stripe.size": STRIPE_BYTES,
        "orc.row.index.stride": INDEX_STRIDE,
        "orc.bloom.filter.columns": "doc_id",
        "orc.bloom.filter.fpp": FALSE_POSITIVES,
    }
    tokens.write.options(**options).orc(path)


def read_tokens(spark: SparkSession, path: str) -> DataFrame:
    """``doc_id, before, n_tokens, ids, part``; filters on ``doc_id`` reach the stripe indexes."""
    part = F.regexp_extract(F.col("_metadata.file_name"), r"^part-(\d+)", 1).cast("int")
    rows = spark.read.schema("doc_id long, before long, n_tokens long, ids array<int>").orc(path)
    return rows.withColumn("part", part)


def token_digests(spark: SparkSession, path: str) -> DataFrame:
    """``doc_id, start, n_tokens, ids_crc32`` of every stored document, in one read of the ids."""

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch["ids"]
            ends, ids = lists.offsets.to_numpy(), lists.values.to_numpy()
            sums = [zlib.crc32(ids[a:b]) for a, b in zip(ends, ends[1:])]
            out = [batch["doc_id"], batch["before"], pa.array(np.diff(ends).astype(np.int64)), pa.array(sums, pa.int64()), batch["part"]]
            yield pa.RecordBatch.from_arrays(out, ["doc_id", "before", "n_tokens", "ids_crc32", "part"])

    schema = "doc_id long, before long, n_tokens long, ids_crc32 long, part int"
    stored = read_tokens(spark, path)
    rows = stored.mapInArrow(digest, schema)
    files = stored.groupBy("part").agg(F.max(F.col("before") + F.col("n_tokens")).alias("size"))
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    files = files.select("part", F.coalesce(F.sum("size").over(earlier), F.lit(0).cast("long")).alias("base"))
    start = (F.col("base") + F.col("before")).alias("start")
    return rows.join(files, "part").select("doc_id", start, "n_tokens", "ids_crc32")
