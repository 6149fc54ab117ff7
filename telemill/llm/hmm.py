"""A hidden Markov language model: Baum-Welch over partitions, exact scaled forward scores.

The model speaks in symbols: each of the ``OWN_SYMBOLS`` most frequent training words is one, other
words share one of ``BUCKETS`` by their last three characters, and the end of a text is one. Within
a bucket a word has probability (c + 1) / (t + v + 1), where t and v count the bucket's training
words and different ones, and one place is left for all unknown words. A text's probability is that
of its symbols, summed over all state sequences, times those of the words within their buckets.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, functions as F

from telemill.llm.words import hash_words, in_small_batches, kept, ragged, slices, split_words

STATES, ROUNDS, SEGMENT = 4, 3, 128
#: Bound of the broadcast dictionary of frequent words (16 bytes each), and of words with a symbol.
DICTIONARY, OWN_SYMBOLS, BUCKETS = 300_000, 50_000, 1024
SYMBOLS = OWN_SYMBOLS + BUCKETS + 1
END = SYMBOLS - 1
SEED = 7
SEGMENTS_AT_ONCE = 4096

ENCODED = (
    "row long, doc_id long, held_out boolean, n_tokens long, n_known long, log_counts double, log_buckets double,"
    " symbols binary, rare array<long>"
)


def held_out() -> Column:
    """Rows that are never learned from: CRC-32 of the id as text leaves 2 when divided by 7."""
    return F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")) % 7 == 2


def coded_words(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Offsets of the texts, codes of their words, and hash and bucket of each different word."""
    offsets, words = split_words(texts, lower=True)
    codes = words.dictionary_encode()
    hashes = hash_words(codes.dictionary)
    ends = hash_words(pc.utf8_slice_codeunits(codes.dictionary, start=-3, stop=None)) if len(hashes) else hashes
    return offsets, codes.indices.to_numpy(), hashes, (ends % np.uint64(BUCKETS)).astype(np.int64)


def word_counts(docs: DataFrame) -> DataFrame:
    """``hash, bucket, c``: how often each word occurs in ``docs``, by its 64-bit hash."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            _, codes, hashes, buckets = coded_words(batch["text"])
            c = np.bincount(codes, minlength=len(hashes))
            columns = [pa.array(hashes.view(np.int64)), pa.array(buckets), pa.array(c)]
            yield pa.RecordBatch.from_arrays(columns, ["hash", "bucket", "c"])

    rows = docs.select("text").mapInArrow(count, "hash long, bucket long, c long")
    return kept(rows.groupBy("hash", "bucket").agg(F.sum("c").alias("c")), "word_counts")


@dataclass(frozen=True)
class Vocabulary:
    """Frequent words by hash, with count and symbol (-1: by bucket), and figures of the buckets."""

    hashes: np.ndarray
    counts: np.ndarray
    symbols: np.ndarray
    bucket_words: np.ndarray
    bucket_different: np.ndarray
    texts: int
    words: int
    different: int

    @property
    def tokens(self) -> int:
        return self.words + self.texts

    @property
    def log_base(self) -> float:
        """Logarithm of the base model's denominator; the end of a text is a training token too."""
        return float(np.log10(self.tokens + self.different + (self.texts > 0) + 1))

    @property
    def log_buckets(self) -> np.ndarray:
        return np.log10(self.bucket_words + self.bucket_different + 1)

    def unigrams(self) -> np.ndarray:
        """Smoothed share of every symbol among the training tokens."""
        seen = np.ones(SYMBOLS)
        own = self.symbols >= 0
        seen[self.symbols[own]] += self.counts[own]
        seen[OWN_SYMBOLS:END] += self.bucket_words
        seen[END] += self.texts
        return seen / seen.sum()


def vocabulary(counts: DataFrame, texts: int) -> Vocabulary:
    """Read the most frequent words, at most ``DICTIONARY``, and sums over all others' buckets.

    A histogram of the counts' logarithms tells from which count on that many words remain.
    """
    level = F.floor(F.log2("c") * 16)
    levels = counts.groupBy(level.alias("level")).agg(F.count("*").alias("n"), F.min("c").alias("least"))
    levels = levels.toPandas().sort_values("level", ascending=False)
    fitting = levels[levels["n"].cumsum() <= DICTIONARY]
    least = int(fitting["least"].iloc[-1]) if len(fitting) else 1 << 62
    top = counts.filter(F.col("c") >= least).toPandas().sort_values(["c", "hash"], ascending=[False, True], ignore_index=True)
    totals = counts.groupBy("bucket").agg(F.sum("c").alias("words"), F.count("*").alias("different")).toPandas()
    words, different = np.zeros(BUCKETS, np.int64), np.zeros(BUCKETS, np.int64)
    at = totals["bucket"].to_numpy(np.int64)
    words[at], different[at] = totals["words"].to_numpy(np.int64), totals["different"].to_numpy(np.int64)
    all_words, all_different = int(words.sum()), int(different.sum())
    own = top.iloc[:OWN_SYMBOLS]
    np.subtract.at(words, own["bucket"].to_numpy(np.int64), own["c"].to_numpy(np.int64))
    np.subtract.at(different, own["bucket"].to_numpy(np.int64), 1)
    symbols = np.where(np.arange(len(top)) < OWN_SYMBOLS, np.arange(len(top)), -1)
    hashes = top["hash"].to_numpy(np.int64).view(np.uint64)
    by_hash = np.argsort(hashes)
    c = top["c"].to_numpy(np.int64)[by_hash]
    return Vocabulary(hashes[by_hash], c, symbols[by_hash], words, different, texts, all_words, all_different)


def encode(docs: DataFrame, vocab: Vocabulary) -> DataFrame:
    """``ENCODED``: symbols of whole texts, and the parts of the scores that frequent words give.

    ``rare`` has the hashes of the words outside the dictionary, whose counts are joined later.
    """
    log_buckets = vocab.log_buckets

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            offsets, codes, hashes, buckets = coded_words(batch["text"])
            at = np.minimum(np.searchsorted(vocab.hashes, hashes), max(len(vocab.hashes) - 1, 0))
            known = vocab.hashes[at] == hashes if len(vocab.hashes) else np.zeros(len(hashes), bool)
            symbol = np.where(known, vocab.symbols[at], -1) if len(vocab.hashes) else np.full(len(hashes), -1)
            in_bucket = symbol < 0
            symbol = np.where(in_bucket, OWN_SYMBOLS + buckets, symbol).astype(np.uint16)
            log_count = np.log10(np.where(known, vocab.counts[at], 0) + 1) if len(vocab.hashes) else np.zeros(len(hashes))
            within = np.where(in_bucket, log_count - log_buckets[buckets], 0.0)
            sums = lambda x: np.diff(np.concatenate([[0], np.cumsum(x[codes])])[offsets])
            symbols, rare = symbol[codes], ~known[codes]
            rare_ends = np.concatenate([[0], np.cumsum(rare)])[offsets].astype(np.int32)
            columns = [
                *[batch[c] for c in ("row", "doc_id", "held_out")],
                pa.array(np.diff(offsets) + 1),
                pa.array(sums(known.astype(np.int64)) + (vocab.texts > 0)),
                pa.array(sums(log_count) + np.log10(vocab.texts + 1)),
                pa.array(sums(within)),
                pa.array([symbols[a:b].tobytes() for a, b in zip(offsets, offsets[1:])], pa.binary()),
                pa.ListArray.from_arrays(pa.array(rare_ends), pa.array(hashes[codes[rare]].view(np.int64))),
            ]
            names = ["row", "doc_id", "held_out", "n_tokens", "n_known", "log_counts", "log_buckets", "symbols", "rare"]
            yield pa.RecordBatch.from_arrays(columns, names)

    rows = docs.select(F.monotonically_increasing_id().alias("row"), "doc_id", held_out().alias("held_out"), "text")
    return kept(rows.mapInArrow(run, ENCODED), "encoded")


@dataclass(frozen=True)
class Model:
    start: np.ndarray
    moves: np.ndarray
    emits: np.ndarray  # SYMBOLS x STATES


def first_model(vocab: Vocabulary, states: int = STATES) -> Model:
    """States that stay put and speak in random variations of the unigrams."""
    noise = np.random.default_rng(SEED).gamma(1.0, size=(SYMBOLS, states))
    emits = vocab.unigrams()[:, None] * (0.2 + noise)
    moves = np.full((states, states), 0.05 / max(states - 1, 1))
    np.fill_diagonal(moves, 0.95 if states > 1 else 1.0)
    return Model(np.full(states, 1 / states), moves, emits / emits.sum(0))


def symbol_runs(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Symbols of all texts, each closed by ``END``, and the texts' lengths."""
    texts = [np.frombuffer(x, np.uint16) for x in column.to_pylist()]
    sizes = np.array([len(t) + 1 for t in texts], np.int64)
    end = np.array([END], np.uint16)
    return np.concatenate([x for t in texts for x in (t, end)]) if texts else end[:0], sizes


def expected_counts(model: Model, symbols: np.ndarray, starts: np.ndarray, sizes: np.ndarray, first: np.ndarray):
    """Expected starts, moves and emissions of segments, given in order of falling size."""
    k, steps = len(model.start), int(sizes[0])
    active = np.searchsorted(-sizes, -np.arange(steps), side="left")
    alpha = np.zeros((steps, len(sizes), k))
    scale = np.ones((steps, len(sizes)))
    say = lambda t: model.emits[symbols[starts[: active[t]] + t]]
    for t in range(steps):
        n = active[t]
        a = (np.broadcast_to(model.start, (n, k)) if t == 0 else alpha[t - 1, :n] @ model.moves) * say(t)
        scale[t, :n] = a.sum(1)
        alpha[t, :n] = a / scale[t, :n, None]
    beta = np.ones((len(sizes), k))
    moves = np.zeros((k, k))
    gamma = np.zeros((steps, len(sizes), k))
    for t in reversed(range(steps)):
        n = active[t]
        gamma[t, :n] = alpha[t, :n] * beta[:n]
        if t:
            ahead = say(t) * beta[:n] / scale[t, :n, None]
            moves += model.moves * (alpha[t - 1, :n].T @ ahead)
            beta[:n] = ahead @ model.moves.T
    inside = np.arange(steps)[:, None] < sizes[None, :]
    said = symbols[(starts[None, :] + np.arange(steps)[:, None])[inside]]
    weights = gamma[inside]
    emits = np.column_stack([np.bincount(said, weights[:, s], SYMBOLS) for s in range(k)])
    return gamma[0, first].sum(0), moves, emits


def improve(model: Model, encoded: DataFrame, vocab: Vocabulary) -> Model:
    """One round of Baum-Welch over all training texts, cut into segments of ``SEGMENT`` tokens.

    Tasks send expected counts by symbol, which Spark adds up; the driver gets one row per symbol
    and state. Emissions are smoothed with one count for each state's share of the unigrams.
    """
    states = len(model.start)
    names = [f"s{i}" for i in range(states)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        start, moves, emits = np.zeros(states), np.zeros((states, states)), np.zeros((SYMBOLS, states))
        for batch in batches:
            for at in range(0, len(batch), 1000):
                symbols, lengths = symbol_runs(batch["symbols"].slice(at, 1000))
                begins = np.cumsum(lengths) - lengths
                cuts = -(-lengths // SEGMENT)
                offset = ragged(np.zeros(len(cuts), np.int64), cuts) * SEGMENT
                starts = np.repeat(begins, cuts) + offset
                sizes = np.minimum(SEGMENT, np.repeat(lengths, cuts) - offset)
                order = np.argsort(-sizes, kind="stable")
                for i in range(0, len(order), SEGMENTS_AT_ONCE):
                    o = order[i : i + SEGMENTS_AT_ONCE]
                    a, b, c = expected_counts(model, symbols, starts[o], sizes[o], offset[o] == 0)
                    start, moves, emits = start + a, moves + b, emits + c
        seen = np.flatnonzero(emits.sum(1))
        keys = np.concatenate([seen, -1 - np.arange(states), [-1 - states]])
        values = np.concatenate([emits[seen], moves, start[None]])
        yield pa.RecordBatch.from_arrays([pa.array(keys), *[pa.array(values[:, i]) for i in range(states)]], ["key", *names])

    rows = encoded.filter("not held_out").select("symbols").mapInArrow(run, "key long, " + ", ".join(f"{n} double" for n in names))
    sums = rows.groupBy("key").agg(*[F.sum(n).alias(n) for n in names]).toPandas().set_index("key")[names]
    get = lambda keys: sums.reindex(keys).fillna(0.0).to_numpy()
    start = get([-1 - states])[0] + 1
    moves = get(-1 - np.arange(states)) + 1
    emits = get(np.arange(SYMBOLS)) + SYMBOLS * vocab.unigrams()[:, None]
    return Model(start / start.sum(), moves / moves.sum(1, keepdims=True), emits / emits.sum(0))


def log_likelihoods(model: Model, symbols: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Exact log10 probability of each whole sequence by the scaled forward recursion."""
    order = np.argsort(-sizes, kind="stable")
    starts, ordered = (np.cumsum(sizes) - sizes)[order], sizes[order]
    total = np.zeros(len(sizes))
    steps = int(ordered[0]) if len(ordered) else 0
    active = np.searchsorted(-ordered, -np.arange(steps), side="left")
    alpha = np.broadcast_to(model.start, (len(sizes), len(model.start)))
    for t, n in enumerate(active):
        a = alpha[:n] if t == 0 else alpha[:n] @ model.moves
        a = a * model.emits[symbols[starts[:n] + t]]
        scale = a.sum(1)
        total[:n] += np.log10(scale)
        alpha = a / scale[:, None]
    out = np.empty(len(sizes))
    out[order] = total
    return out


def train(docs: DataFrame, states: int = STATES, rounds: int = ROUNDS) -> tuple[DataFrame, DataFrame, Vocabulary, Model]:
    """Count words, encode all texts, and fit the model on those not held out."""
    learned = in_small_batches(docs).filter(~held_out())
    counts = word_counts(learned)
    vocab = vocabulary(counts, learned.count())
    encoded = encode(docs, vocab)
    model = first_model(vocab, states)
    for _ in range(rounds):
        model = improve(model, encoded, vocab)
    return encoded, counts, vocab, model


def scores(docs: DataFrame, states: int = STATES, rounds: int = ROUNDS) -> DataFrame:
    """``doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score`` of every row.

    Words are lower-cased in A to Z; null texts are the end token alone. Repeated rows count each;
    without training rows all counts are zero and ``base_score`` is 0. ``score`` is exact for the
    whole text. Of words outside the dictionary only the hashes travel, to their counts and back.
    """
    encoded, counts, vocab, model = train(docs, states, rounds)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch["row"], pa.array(log_likelihoods(model, *symbol_runs(batch["symbols"])))], ["row", "forward"])

    forward = encoded.select("row", "symbols").mapInArrow(run, "row long, forward double")
    rare = encoded.select("row", F.explode("rare").alias("hash")).join(counts, "hash")
    rare = rare.groupBy("row").agg(F.count("*").alias("rare_known"), F.sum(F.log10(F.col("c") + 1)).alias("rare_logs"))
    rows = encoded.drop("symbols", "rare").join(forward, "row").join(rare, "row", "left")
    logs = F.coalesce("rare_logs", F.lit(0.0))
    return rows.select(
        "doc_id",
        "held_out",
        "n_tokens",
        (F.col("n_known") + F.coalesce("rare_known", F.lit(0))).alias("n_known"),
        F.lit(vocab.tokens).cast("long").alias("train_tokens"),
        (F.col("log_counts") + logs - F.col("n_tokens") * vocab.log_base).alias("base_score"),
        (F.col("forward") + F.col("log_buckets") + logs).alias("score"),
    )
