"""Removal of long passages that an earlier document has, by suffix trees of shared prefixes.

1. Anchors: of the k-grams in each window of ``WINDOW`` words that with the least hash. Equal windows have
   equal anchors at equal places, so a window whose anchor no other document has is unique and never
   indexed. Consecutive windows with one anchor travel together, as one stretch of words.
2. The suffixes that begin at an anchor are dealt out by the words of the anchor, their prefix, into
   parts that fit in memory. Where too many documents have an anchor, the prefix is lengthened to a
   whole window, which spreads its continuations over all parts.
3. In each part the suffixes at the anchors are sorted by their words; the longest common prefixes of
   neighbours are the inner nodes of the prefix's subtree. The words before the anchors are sorted the
   same way, backwards. A suffix that starts some words before an anchor is in one place on each side,
   so the nodes of depth ``WINDOW`` of all suffixes follow from the two trees. Of the leaves of such a
   node all but those in the smallest document are to be removed. Only words are compared here.

Within a batch of documents only the smallest document of each repeated window is sent on, so a passage
that a third of all documents share is a few rows of each batch. Fingerprints find these windows, and
their words are then compared. That an anchor is shared is told by 56 bits of its hash; equal ones by
chance cost work, not correctness.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, functions as F

from telemill.llm.ngram_join import BLOCK, MARK, PART_BYTES, _batch, chunk_blocks, packed, runs_of_parts, shared_in_part, unpacked
from telemill.llm.words import BATCH_BYTES, hash_words, in_small_batches, mixed, ragged, slices, split_words

WINDOW, GRAM = 50, 25
SPAN = WINDOW - GRAM + 1
CHUNK_SUFFIXES = 1_000_000
BASE, SECOND_BASE = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93)
#: Key of the second hash of words; 16 characters.
SECOND_KEY = "second print key"

#: From so many documents on an anchor's prefix is lengthened.
CROWDED = 20_000

SUFFIXES = (
    "part long, chunk long, anchors binary, doc_ids binary, members binary, starts binary, counts binary, shifts binary,"
    " words binary, keys array<long>, own_members binary, own_starts binary"
)
REMOVED = "doc_id long, text_hash long, starts array<int>"


@dataclass
class Windows:
    """All windows of a batch of texts: text, start in the text, anchor, the anchor's place and the window's among all words."""

    texts: np.ndarray
    starts: np.ndarray
    anchors: np.ndarray
    places: np.ndarray
    at: np.ndarray
    words: pa.Array
    _sums: np.ndarray
    _inverse: np.ndarray
    _codes: pa.DictionaryArray

    def equal(self, some: np.ndarray, others: np.ndarray) -> np.ndarray:
        """Which windows have the same words as their counterparts."""
        codes, same = self._codes.indices.to_numpy(), np.ones(len(some), bool)
        for k in range(WINDOW):
            same &= codes[self.at[some] + k] == codes[self.at[others] + k]
        return same

    def stretches(self, first: np.ndarray, count: np.ndarray) -> pa.Array:
        """The words of so many windows in a row, joined by spaces."""
        sizes = count + WINDOW - 1
        words = self.words.take(pa.array(ragged(self.at[first], sizes)))
        offsets = pa.array(np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32))
        return pc.binary_join(pa.ListArray.from_arrays(offsets, words), " ")

    def prints(self, chosen: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Two independent 64-bit fingerprints of whole windows."""
        at = self.at[chosen]
        of = lambda sums, inverse: mixed((sums[at + WINDOW] - sums[at]) * inverse[at])
        others = hash_words(self._codes.dictionary, SECOND_KEY)[self._codes.indices.to_numpy()]
        return of(self._sums, self._inverse), of(*running(others, SECOND_BASE))


def running(hashes: np.ndarray, base: np.uint64) -> tuple[np.ndarray, np.ndarray]:
    """Sums of the hashes up to each place, weighted by powers of ``base``, and the inverse powers."""
    powers = np.multiply.accumulate(np.full(len(hashes) + 1, base))
    inverse = np.multiply.accumulate(np.full(len(hashes) + 1, np.uint64(pow(int(base), -1, 1 << 64))))
    return np.concatenate([[np.uint64(0)], np.cumsum(hashes * powers[:-1], dtype=np.uint64)]), inverse


def windows(texts: pa.Array) -> Windows:
    offsets, words = split_words(texts)
    codes = words.dictionary_encode()
    sums, inverse = running(hash_words(codes.dictionary)[codes.indices.to_numpy()], BASE)
    counts = np.diff(offsets)
    long = np.flatnonzero(counts >= WINDOW)
    sizes = counts[long] - WINDOW + 1
    at = ragged(offsets[long], sizes)
    anchors, places = np.zeros(0, np.uint64), np.zeros(0, np.int64)
    if len(at):
        grams = mixed((sums[GRAM:] - sums[:-GRAM]) * inverse[: len(sums) - GRAM])
        least, width = np.arange(len(grams)), 1
        while width < SPAN:  # the leftmost of the least
            step = min(width, SPAN - width)
            left, right = least[:-step], least[step:]
            least, width = np.where(grams[right] < grams[left], right, left), width + step
        places = least[at]
        anchors = mixed(grams[places])  # spread evenly again: the least of many hashes are small
    texts_of = np.repeat(long, sizes)
    return Windows(texts_of, at - offsets[texts_of], anchors, places, at, words, sums, inverse, codes)


def _parts(docs: DataFrame) -> int:
    total = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    return max(64, -(-total // PART_BYTES))


def _slice_bytes(parts: int) -> int:
    """Bytes of text handled at once: more where there are many parts to deal out to, up to four times."""
    return BATCH_BYTES * min(4, max(1, parts // 4096))


def shared_anchors(docs: DataFrame, parts: int, crowded_from: int = CROWDED) -> DataFrame:
    """``doc_id, text_hash, anchors, crowded``: those of a document that another one has too, and which
    of them ``crowded_from`` documents have."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, limit=_slice_bytes(parts)):
            found = windows(batch["text"])
            new = np.ones(len(found.anchors), bool)
            new[1:] = (found.anchors[1:] != found.anchors[:-1]) | (found.texts[1:] != found.texts[:-1])
            keys = np.column_stack([batch["doc_id"].to_numpy(), batch["text_hash"].to_numpy()]).reshape(-1).tolist()
            hashes = found.anchors[new] >> np.uint64(8)
            yield _batch(list(chunk_blocks(batch["row"][0].as_py(), keys, found.texts[new], hashes, parts)))

    def gather(chunk: pa.Table) -> pa.Table:
        blocks = chunk.to_pylist()
        head = next(b for b in blocks if b["ids"] is not None)
        replies = [b for b in blocks if b["ids"] is None]
        join = lambda name, kind: np.concatenate([np.zeros(0, kind), *[unpacked(b[name], kind) for b in replies]])
        hashes, members, counts = join("hashes", np.uint64), join("members", np.uint32), join("counts", np.uint16)
        crowded = np.unique(hashes[counts >= crowded_from])
        direct = members != MARK
        hashes = np.concatenate([hashes[direct], unpacked(head["own_hashes"], np.uint64)])
        members = np.concatenate([members[direct], unpacked(head["own_members"], np.uint32)])
        hashes = hashes[np.argsort(members, kind="stable")]
        keys = np.array(head["ids"], np.int64).reshape(-1, 2)
        sizes = np.bincount(members, minlength=len(keys))[: len(keys)]
        has = sizes > 0
        offsets = np.concatenate([[0], np.cumsum(sizes[has])]).astype(np.int32)
        lists = [pa.ListArray.from_arrays(pa.array(offsets), pa.array(x)) for x in (hashes.view(np.int64), np.isin(hashes, crowded))]
        return pa.Table.from_arrays([pa.array(keys[has, 0]), pa.array(keys[has, 1]), *lists], ["doc_id", "text_hash", "anchors", "crowded"])

    numbered = docs.select("doc_id", "text_hash", "text", F.monotonically_increasing_id().alias("row"))
    blocks = numbered.mapInArrow(cut, BLOCK).groupBy("part").applyInArrow(shared_in_part, BLOCK)
    found = blocks.groupBy("chunk").applyInArrow(gather, "doc_id long, text_hash long, anchors array<long>, crowded array<boolean>")
    found = found.groupBy("doc_id", "text_hash").agg(F.first(F.struct("anchors", "crowded")).alias("of"))
    return found.select("doc_id", "text_hash", "of.*")


def _suffix_batch(rows: list[dict]) -> pa.RecordBatch:
    kinds = [("part", pa.int64()), ("chunk", pa.int64())]
    kinds += [(c, pa.binary()) for c in ("anchors", "doc_ids", "members", "starts", "counts", "shifts", "words")]
    kinds += [("keys", pa.list_(pa.int64())), ("own_members", pa.binary()), ("own_starts", pa.binary())]
    return pa.RecordBatch.from_pylist(rows, pa.schema(kinds))


def runs(*keys: np.ndarray) -> np.ndarray:
    """Where a new run of equal keys begins, of arrays in order."""
    new = np.ones(len(keys[0]), bool)
    new[1:] = np.any([k[1:] != k[:-1] for k in keys], axis=0)
    return new


def smallest(doc_ids: np.ndarray, *keys: np.ndarray) -> np.ndarray:
    """For each place one with the smallest document among those of equal keys."""
    order = np.lexsort((doc_ids, *keys))
    starts = np.flatnonzero(runs(*[k[order] for k in keys]))
    found = np.empty(len(order), np.int64)
    found[order] = np.repeat(order[starts], np.diff(np.append(starts, len(order))))
    return found


class Subtree:
    """Sequences of words (rows of ``codes``, -1 beyond their end) sorted below their prefixes.

    ``common`` has the longest common prefix of each sequence, in sorted order, with the one before;
    it is negative where another prefix begins. Neighbours with ``depth`` words in common are the
    leaves of one inner node.
    """

    def __init__(self, codes: np.ndarray, prefixes: np.ndarray):
        self.order = np.lexsort((*codes.T[::-1], prefixes))
        rows, prefixes = codes[self.order], prefixes[self.order]
        self.common = np.full(len(rows), -1)
        alike = np.logical_and.accumulate((rows[1:] == rows[:-1]) & (rows[1:] >= 0), axis=1)
        self.common[1:] = np.where(prefixes[1:] == prefixes[:-1], alike.sum(1), -1)

    def nodes(self, depth: int) -> np.ndarray:
        """For each sequence the node at ``depth`` that it is below; sequences that short share none."""
        found = np.empty(len(self.order), np.int64)
        found[self.order] = np.cumsum((self.common < depth) | (self.common < 0))
        return found


def repeated_windows(
    anchors: np.ndarray, doc_ids: np.ndarray, counts: np.ndarray, shifts: np.ndarray, texts: pa.Array
) -> tuple[np.ndarray, np.ndarray]:
    """Stretch and number within it of each window that a smaller document has as well.

    A stretch has ``counts`` windows; its anchor begins ``shifts`` words after its first one.
    """
    lists = pc.split_pattern(texts, " ")
    codes = np.append(lists.flatten().dictionary_encode().indices.to_numpy(), np.int32(-1))
    begin, size = lists.offsets.to_numpy()[:-1], (counts + WINDOW - 1).astype(np.int32)
    del lists

    def side(first: np.ndarray, step: int, words: int) -> np.ndarray:
        """So many words of each stretch from its word ``first`` on, one column after the other."""
        rows = np.empty((len(first), words), np.int32)
        for k in range(words):
            place = first + k * step
            rows[:, k] = codes[np.where((place >= 0) & (place < size), begin + place, len(codes) - 1)]
        return rows

    after = Subtree(side(shifts, 1, WINDOW), anchors)
    before = Subtree(side(shifts - 1, -1, SPAN - 1), anchors)
    stretch, number = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    for shift in range(SPAN):
        has = np.flatnonzero((shifts >= shift) & (shifts - counts < shift))
        if len(has):
            keys = before.nodes(shift)[has], after.nodes(WINDOW - shift)[has]
            later = doc_ids[has] > doc_ids[has[smallest(doc_ids[has], *keys)]]
            stretch.append(has[later])
            number.append(shifts[has[later]] - shift)
    return np.concatenate(stretch), np.concatenate(number)


def removed_starts(packed_docs: DataFrame, anchors: DataFrame, parts: int) -> DataFrame:
    """``REMOVED``: starts of the windows that start in a document with a smaller id as well."""

    def index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = 0
        for batch in slices(_unpack(batches), limit=_slice_bytes(parts)):
            found = windows(batch["text"])
            lists = batch["anchors"]
            ends = lists.offsets.to_numpy().astype(np.int64)
            shared = lists.values.to_numpy().view(np.uint64)[ends[0] : ends[-1]]
            salt = lambda of, h: mixed(h + np.asarray(of).astype(np.uint64) * BASE)
            wanted = salt(np.repeat(np.arange(len(batch)), np.diff(ends)), shared)
            salted = salt(found.texts, found.anchors >> np.uint64(8))
            chosen = np.flatnonzero(np.isin(salted, wanted))
            crowded = np.isin(salted[chosen], wanted[batch["crowded"].values.to_numpy(zero_copy_only=False)[ends[0] : ends[-1]]])
            firsts, seconds = found.prints(chosen)
            doc_ids = batch["doc_id"].to_numpy()[found.texts[chosen]]
            best = smallest(doc_ids, seconds, firsts)
            done = doc_ids > doc_ids[best]
            done[done] = found.equal(chosen[done], chosen[best[done]])
            chunk, number = (TaskContext.get().partitionId() << 32) + number, number + 1
            keys = np.column_stack([batch["doc_id"].to_numpy(), batch["text_hash"].to_numpy()]).reshape(-1)
            own = {"own_members": found.texts[chosen[done]].astype(np.uint32), "own_starts": found.starts[chosen[done]].astype(np.uint32)}
            blocks = [{"part": parts + chunk % parts, "chunk": chunk, "keys": keys.tolist(), **{c: packed(x) for c, x in own.items()}}]
            windows_, crowded, firsts = chosen[~done], crowded[~done], firsts[~done]
            new = crowded | runs(found.places[windows_], found.at[windows_] - np.arange(len(windows_)))
            new[1:] |= crowded[:-1]
            begin = np.flatnonzero(new)
            counts = np.diff(np.append(begin, len(windows_)))
            first = windows_[begin]
            # the words of the anchor are the prefix; a crowded one is lengthened to the whole window
            prefix = np.where(crowded[begin], firsts[begin], found.anchors[first])
            order = np.argsort(prefix, kind="stable")
            first, counts, prefix = first[order], counts[order], prefix[order]
            words = found.stretches(first, counts).to_pylist()
            columns = {
                "anchors": found.anchors[first],
                "doc_ids": batch["doc_id"].to_numpy()[found.texts[first]],
                "members": found.texts[first].astype(np.uint32),
                "starts": found.starts[first].astype(np.uint32),
                "counts": counts.astype(np.uint8),
                "shifts": (found.places[first] - found.at[first]).astype(np.uint8),
            }
            for p, a, b in runs_of_parts(prefix >> np.uint64(32), parts):
                block = {c: packed(x[a:b]) for c, x in columns.items()}
                blocks.append({"part": p, "chunk": chunk, "words": "\n".join(words[a:b]).encode(), **block})
            yield _suffix_batch(blocks)

    def subtrees(part: pa.Table) -> pa.Table:
        blocks = part.to_pylist()
        filled = [b for b in blocks if b["keys"] is None]
        if filled:
            all_of = lambda c, t: np.concatenate([unpacked(b[c], t) for b in filled])
            texts = pa.array(b"\n".join(b["words"] for b in filled).decode().split("\n"), pa.string())
            members, starts = all_of("members", np.uint32), all_of("starts", np.uint32)
            counts, shifts = all_of("counts", np.uint8).astype(np.int64), all_of("shifts", np.uint8).astype(np.int64)
            stretch, number = repeated_windows(all_of("anchors", np.uint64), all_of("doc_ids", np.int64), counts, shifts, texts)
            order = np.argsort(stretch, kind="stable")
            stretch, number = stretch[order], number[order]
            ends = np.cumsum([len(unpacked(b["members"], np.uint32)) for b in filled])
            cuts = np.concatenate([[0], np.searchsorted(stretch, ends)])
            for block, a, b in zip(filled, cuts, cuts[1:]):
                block |= dict.fromkeys(("anchors", "doc_ids", "counts", "shifts", "words"))
                block["members"] = packed(members[stretch[a:b]])
                block["starts"] = packed((starts[stretch[a:b]] + number[a:b]).astype(np.uint32))
        return pa.Table.from_batches([_suffix_batch(blocks)])

    def gather(chunk: pa.Table) -> pa.Table:
        blocks = chunk.to_pylist()
        keys = np.array(next(b["keys"] for b in blocks if b["keys"] is not None), np.int64).reshape(-1, 2)
        both = lambda a, b: np.concatenate([unpacked(x[c], np.uint32) for x in blocks for c in (a, b)])
        members, starts = both("members", "own_members"), both("starts", "own_starts")
        order = np.lexsort((starts, members))
        sizes = np.bincount(members, minlength=len(keys))
        has = sizes > 0
        offsets = np.concatenate([[0], np.cumsum(sizes[has])]).astype(np.int32)
        lists = pa.ListArray.from_arrays(pa.array(offsets), pa.array(starts[order].astype(np.int32)))
        return pa.Table.from_arrays([pa.array(keys[has, 0]), pa.array(keys[has, 1]), lists], ["doc_id", "text_hash", "starts"])

    joined = packed_docs.join(anchors, ["doc_id", "text_hash"])
    rows = joined.mapInArrow(index, SUFFIXES).groupBy("part").applyInArrow(subtrees, SUFFIXES)
    found = rows.groupBy("chunk").applyInArrow(gather, REMOVED)
    return found.groupBy("doc_id", "text_hash").agg(F.first("starts").alias("starts"))


def _unpack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    import zstandard

    decompressor = zstandard.ZstdDecompressor()
    for batch in batches:
        for at in range(0, len(batch), 500):
            part = batch.slice(at, 500)
            texts = pa.array([decompressor.decompress(x).decode() for x in part["packed_text"].to_pylist()], pa.string())
            yield part.append_column("text", texts)


def _packed_text(text: Column) -> Column:
    @F.pandas_udf("binary")
    def pack(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        import zstandard

        compressor = zstandard.ZstdCompressor(level=3)
        for texts in batches:
            yield pd.Series([compressor.compress((t or "").encode()) for t in texts], dtype=object)

    return pack(text)


def kept_words(text: str, starts, rejoin: bool) -> tuple[int, int, str]:
    """Number of words, of words removed, and what is left."""
    words = text.encode().split()
    if starts is None or not len(starts):
        return len(words), 0, b" ".join(words).decode() if rejoin else text
    steps = np.zeros(len(words) + 1, np.int32)
    np.add.at(steps, starts, 1)
    np.add.at(steps, np.asarray(starts) + WINDOW, -1)
    keep = np.cumsum(steps[:-1]) == 0
    left = [w for w, k in zip(words, keep) if k]
    return len(words), len(words) - len(left), b" ".join(left).decode()


def remove_repeats(docs: DataFrame, rejoin: bool = False, crowded_from: int = CROWDED) -> DataFrame:
    """``docs`` with ``text`` shortened, and ``n_words`` and ``n_removed`` (replaced if present).

    Every word goes that is covered by a window of 50 words whose sequence also starts in a document
    with a smaller ``doc_id``; windows are judged on the input. What is left of a shortened text is
    joined by single spaces, with ``rejoin`` that of all texts. Null texts have no words and become
    empty. Rows without id neither lose words nor count as earlier; rows of one id do not count
    against each other; repeated rows are shortened alike. Other columns stay as they are; names
    that begin with two underscores are reserved.
    """
    import zstandard

    text = F.coalesce("text", F.lit(""))
    in_small_batches(docs)
    keyed = docs.withColumns({"__hash": F.xxhash64(text), "__packed": _packed_text(text)})
    packed_docs = keyed.select("doc_id", F.col("__hash").alias("text_hash"), F.col("__packed").alias("packed_text"))
    plain = docs.select("doc_id", text.alias("text"), F.xxhash64(text).alias("text_hash")).filter("doc_id is not null")
    parts = _parts(plain)
    found = removed_starts(packed_docs, shared_anchors(plain, parts, crowded_from), parts)

    @F.pandas_udf("n_words long, n_removed long, text string")
    def shorten(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
        decompressor = zstandard.ZstdDecompressor()
        for texts, starts in batches:
            rows = [kept_words(decompressor.decompress(t).decode(), s, rejoin) for t, s in zip(texts, starts)]
            yield pd.DataFrame(rows, columns=["n_words", "n_removed", "text"])

    named = found.select(F.col("doc_id").alias("__id"), F.col("text_hash").alias("__of"), F.col("starts").alias("__starts"))
    joined = keyed.drop("text").join(named, (F.col("doc_id") == F.col("__id")) & (F.col("__hash") == F.col("__of")), "left")
    joined = joined.withColumn("__out", shorten("__packed", "__starts"))
    out = {c: F.col(f"__out.{c}") for c in ("text", "n_words", "n_removed")}
    return joined.withColumns(out).select(*docs.columns, *[c for c in ("n_words", "n_removed") if c not in docs.columns])


def removal_digests(docs: DataFrame) -> DataFrame:
    """``doc_id, n_words, n_removed, kept_sha256`` of every row of ``docs``."""
    left = remove_repeats(docs.select("doc_id", "text"), rejoin=True)
    return left.select("doc_id", "n_words", "n_removed", F.sha2("text", 256).alias("kept_sha256"))


SQL = r"""
WITH w AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
x AS (SELECT doc_id, unnest(range(1, len(w) - 48)) AS i, w FROM w WHERE len(w) >= 50),
y AS (SELECT doc_id, i, md5(array_to_string(w[i:i + 49], ' ')) AS h FROM x),
z AS (SELECT doc_id, i, min(doc_id) OVER (PARTITION BY h) AS low FROM y),
r AS (SELECT DISTINCT doc_id, unnest(range(i, i + 50)) AS p FROM z WHERE low < doc_id),
g AS (SELECT doc_id, count(*) AS n, list(p) AS p FROM r GROUP BY doc_id)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n, 0) AS BIGINT) AS n_removed,
       sha256(CASE WHEN n IS NULL THEN array_to_string(w, ' ')
              ELSE array_to_string(list_filter(w, lambda v, j: NOT list_contains(p, j)), ' ') END) AS kept_sha256
FROM w LEFT JOIN g USING (doc_id)
"""
