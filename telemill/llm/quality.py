"""Quality from compressed sizes under dictionaries of good and of bad text."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from telemill.llm.words import in_small_batches, kept

#: Bounds of the learning sample: labelled ids and texts of each class, and characters of each.
SAMPLE, LONGEST = 1500, 32_000
DICTIONARY_BYTES = 512 << 10
LEVEL = 3
THRESHOLD = 0.7
RIDGE = 0.01


@dataclass(frozen=True)
class QualityModel:
    """Dictionary texts and the weights of the calibration (intercept, then one for each feature)."""

    good: bytes
    bad: bytes
    weights: tuple[float, ...]
    level: int = LEVEL


class Sizes:
    """Compressed sizes of a text under each dictionary and under none."""

    def __init__(self, good: bytes, bad: bytes, level: int):
        import zstandard

        self.compressors = [zstandard.ZstdCompressor(level=level)]
        for content in (good, bad):
            raw = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT) if content else None
            if raw:
                raw.precompute_compress(level=level)
            self.compressors.append(zstandard.ZstdCompressor(level=level, dict_data=raw))

    def features(self, text: str | None) -> tuple[float, float, float]:
        """Size difference bad minus good and plain size, for each byte, and the log length."""
        data = (text or "").encode("utf-8", "surrogatepass")
        plain, good, bad = (len(c.compress(data)) for c in self.compressors)
        size = max(len(data), 16)
        return (bad - good) / size, plain / size, float(np.log(size))


def held_out() -> Column:
    """Rows that are never learned from: CRC-32 of the id as text leaves 2 when divided by 4."""
    return F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")) % 4 == 2


def logistic(x: np.ndarray, y: np.ndarray, ridge: float = RIDGE, rounds: int = 50) -> np.ndarray:
    """Weights of a ridge logistic regression by Newton's method; the intercept first."""
    mean, spread = x.mean(0), np.maximum(x.std(0), 1e-9)
    a = np.column_stack([np.ones(len(x)), (x - mean) / spread])
    w = np.zeros(a.shape[1])
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(a @ w, -30, 30)))
        h = (a * (p * (1 - p))[:, None]).T @ a + ridge * np.eye(len(w))
        step = np.linalg.solve(h, a.T @ (y - p) - ridge * w)
        w += step
        if np.abs(step).max() < 1e-9:
            break
    return np.concatenate([[w[0] - (w[1:] * mean / spread).sum()], w[1:] / spread])


def train(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, longest: int = LONGEST) -> QualityModel:
    """Learn from labelled documents outside the held-out part.

    Of each class the ``sample`` different labelled ids that come first by hash are taken, and of
    their different texts of at most ``longest`` characters the first ``sample``; half fill the
    dictionaries, each up to ``DICTIONARY_BYTES``, the other half calibrates. These bounds hold the
    driver's share; scoring covers all rows. Null ids, texts and labels are not learned from;
    repeated labels and repeated rows count once. Without a class, or without labels, the score is
    the share of label 1 seen (one half if none).
    """
    usable = labels.filter(F.col("doc_id").isNotNull() & F.col("quality").isin(0, 1) & ~held_out())
    order = [F.xxhash64("doc_id"), "doc_id"]
    usable = usable.select("doc_id", F.col("quality").cast("int").alias("quality")).distinct()
    picked = [usable.filter(F.col("quality") == q).orderBy(*order).limit(sample) for q in (0, 1)]
    ids = picked[0].union(picked[1])
    texts = docs.select("doc_id", "text").filter(F.char_length("text").between(1, longest))
    found = kept(texts.join(F.broadcast(ids), "doc_id").distinct(), "labelled_texts")
    by_class = {}
    for q in (0, 1):
        rows = found.filter(F.col("quality") == q).orderBy(*order, "text").limit(sample).collect()
        by_class[q] = [r["text"].encode() for r in rows]
    if not all(len(t) > 1 for t in by_class.values()):
        share = (len(by_class[1]) + 0.5) / (len(by_class[0]) + len(by_class[1]) + 1)
        return QualityModel(b"", b"", (float(np.log(share / (1 - share))), 0.0, 0.0, 0.0))
    bad, good = (b"\n".join(by_class[q][::2])[:DICTIONARY_BYTES] for q in (0, 1))
    sizes = Sizes(good, bad, LEVEL)
    rest = [(t.decode(), q) for q in (0, 1) for t in by_class[q][1::2]]
    x = np.array([sizes.features(t) for t, _ in rest])
    weights = logistic(x, np.array([q for _, q in rest], float))
    return QualityModel(good, bad, tuple(map(float, weights)))


def score(text: Column, model: QualityModel) -> Column:
    """Probability of label 1 for each whole text; null is scored as the empty text."""

    @F.pandas_udf("double")
    def scored(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        sizes, w = Sizes(model.good, model.bad, model.level), np.array(model.weights)
        for texts in batches:
            x = np.array([sizes.features(t) for t in texts]).reshape(-1, 3)
            yield pd.Series(1 / (1 + np.exp(-np.clip(w[0] + x @ w[1:], -30, 30))))

    return scored(text)


def quality_scores(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """``doc_id, held_out, score, predicted`` of every row of ``docs``, repeated rows included."""
    model = train(in_small_batches(docs), labels)
    rows = docs.select("doc_id", held_out().alias("held_out"), score(F.col("text"), model).alias("score"))
    return rows.withColumn("predicted", F.when(F.col("score") >= threshold, 1).otherwise(0))


def good_documents(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs`` that score at least ``threshold``, unchanged."""
    return docs.filter(score(F.col("text"), train(in_small_batches(docs), labels)) >= threshold)
