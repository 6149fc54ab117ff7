"""Winnowed fingerprints against a plain form."""

import functools
import hashlib
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from telemill.llm import winnowing as w
from telemill.llm.registry import QUERIES


@functools.cache
def plain(text, gram=w.GRAM, window=w.WINDOW):
    """Positions and hashes of a text, window by window."""
    grams = [text[i : i + gram] for i in range(max(1, len(text) - gram + 1))] if text else []
    of = lambda g: w.gram_hashes(np.array([ord(c) for c in g], np.uint32), gram).tolist()
    # gram by gram, but for long texts
    hashes = [of(g)[0] for g in grams] if len(text) < 1000 else of(text)
    picked = []
    for i in range(max(1, len(hashes) - window + 1)) if hashes else []:
        part = hashes[i : i + window]
        at = i + max(j for j, h in enumerate(part) if h == min(part))
        if not picked or picked[-1] != at:
            picked.append(at)
    return picked, [hashes[i] for i in picked]


@pytest.mark.parametrize("gram, window", [(1, 1), (3, 2), (5, 7), (16, 16), (4, 255)])
def test_selection_equals_plain_form(gram, window, monkeypatch):
    rng = random.Random(gram)
    monkeypatch.setattr(w, "SEGMENT", 37)  # texts of several segments
    for n in (0, 1, 2, 5, 17, 40, 41, 300):
        text = "".join(rng.choice("ab ä\U0001f600") for _ in range(n))
        positions, hashes = w.winnow(text, gram, window)
        assert (positions.tolist(), hashes.tolist()) == plain(text, gram, window)
        gaps, upper = w.decode(w.encode(positions, hashes))
        assert gaps.tolist() == positions.tolist() and upper.tolist() == [h >> 32 for h in hashes.tolist()]


def test_ties_go_to_the_right_and_runs_are_found():
    assert w.winnow("a" * 100, 4, 8)[0].tolist() == list(range(7, 97))
    rng = random.Random(2)
    text = lambda n: "".join(rng.choice("abcdefgh ") for _ in range(n))
    for _ in range(200):
        shared = text(31)
        one, two = text(rng.randint(0, 90)) + shared + text(50), text(rng.randint(0, 90)) + shared + text(9)
        assert set(w.winnow(one)[1].tolist()) & set(w.winnow(two)[1].tolist())
    assert not set(w.winnow("abcdefgh" * 1 + "1234567 " + text(60))[1].tolist()) & set(w.winnow("99" + "abcdefgh" + "7654321")[1].tolist())


def expected(rows):
    """The contract over (id, text) rows, given Spark's hash of each text."""
    ordered = sorted(rows, key=lambda r: (r[0] is None, -(r[0] or 0), r[2], r[1]))
    out = []
    for i, (doc_id, text, _) in enumerate(ordered):
        after = ordered[(i + 1) % len(ordered)][1]
        half = len(text) // 2
        edited = text[: len(text) - half] + after[:half]
        prints = [set(plain(t)[1]) for t in (text, edited, after)]
        near = [1.0 if not prints[0] | p else len(prints[0] & p) / len(prints[0] | p) for p in prints[1:]]
        digest = hashlib.sha256(edited.encode()).hexdigest()
        texts = [w.encode(*(np.array(x, k) for x, k in zip(plain(t), (np.int64, np.uint64)))) for t in (text, edited)]
        out.append((doc_id, len(text), digest, *texts, *near))
    return out


@pytest.mark.parametrize("partitions", [1, 4, 60])
def test_rows_equal_brute_force(spark, odd_texts, partitions):
    text = F.coalesce("text", F.lit(""))
    rows = [tuple(r) for r in odd_texts.select("doc_id", text, F.xxhash64(text)).collect()]
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    try:
        got = w.edited_likeness(odd_texts).collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert sorted(map(tuple, got), key=str) == sorted(expected(rows), key=str)


def test_query_on_a_whole_table(spark):
    d = "/root/testdata/sf0.001"
    rows = spark.read.parquet(f"{d}/documents.parquet").select("doc_id", F.coalesce("text", F.lit("")), F.xxhash64("text"))
    got = QUERIES["op13_winnowing"](spark, d).collect()
    assert sorted(map(tuple, got)) == sorted(expected([tuple(r) for r in rows.collect()]))


def test_empty_table_single_rows_and_settings(spark, no_texts, odd_texts):
    assert w.edited_likeness(no_texts).count() == 0
    assert w.fingerprints(no_texts).count() == 0
    one = w.edited_likeness(odd_texts.filter("doc_id = 307")).first()
    assert (one.near_edited, one.near_next) == (0.0, 1.0) or one.near_next == 1.0
    with pytest.raises(ValueError):
        w.edited_likeness(odd_texts, window=300)


def test_arrays_of_marks_and_shared_ones(spark, odd_texts):
    rows = w.fingerprints(odd_texts.filter("doc_id between 300 and 307"))
    for r in rows.collect():
        positions, hashes = plain(r.text or "")
        assert r.positions == positions and [h % 2**64 for h in r.hashes] == hashes
    shared = w.shared_marks(rows.filter("doc_id in (300, 301, 306)").distinct())
    marks = plain(rows.filter("doc_id = 300").first().text)
    got = {r.hash % 2**64: (r.members, r.first.doc_id) for r in shared.collect()}
    assert {h: (2, 300) for h in marks[1]} == {h: got[h] for h in marks[1]}
