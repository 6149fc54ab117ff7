"""Jaccard join of word-shingle sets by prefixes of token combinations.

1. Every document's set of shingle hashes is dealt out by hash. Each part counts in how many
   documents a shingle occurs and tells the documents which of theirs are shared.
2. A document's prefix runs from its rarest shingle on. Single shingles of the rare class and pairs
   of the frequent class are its signatures; the prefix is extended by what the pairs cost, so that
   two linked documents always have a signature in common, even if the smaller one's prefix is cut
   to what links to larger sets take.
3. Signatures give candidates, each compared over its whole set. Members of a signature's group are
   first compared with one pivot; only those still in different components are compared pairwise.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from telemill.llm.components import components
from telemill.llm.words import hash_words, in_small_batches, kept, mixed, ragged, slices, split_words

CHUNK_SHINGLES = 500_000
SLICE_BYTES = 2 << 20
PART_BYTES = 6 << 20
#: Within a chunk, shingles of so many documents are counted once for all of them.
LOCALLY_FREQUENT = 32
#: From so many documents on, shingles are indexed in pairs.
FREQUENT = 32
#: Sets of at least SPLIT_FROM shingles pair only within one of PAIR_GROUPS classes; of SPLIT_FROM times
#: 16, 64, 256 and so on there are 4, 16, 64 times as many classes, so the pairs grow with the prefix.
PAIR_GROUPS, SPLIT_FROM = 16, 64
#: A chunk has so many shingles for each part, up to the second number, so that blocks do not get tiny.
SHINGLES_A_PART, MOST_CHUNK_SHINGLES = 100, 8_000_000
MARK = np.uint32(0xFFFFFFFF)
MOST_COUNTED = 65_535
#: Bits of the map of a set, by which pairs are ruled out before whole sets are fetched.
BITS = 1024

BLOCK = (
    "part long, chunk long, hashes binary, members binary, counts binary,"
    " ids array<long>, sizes array<int>, own_hashes binary, own_members binary"
)
SETS = "row long, doc_id long, text_hash long, n_shingles long, shared int, print1 long, print2 long, hashes array<long>, counts array<int>, bits array<long>"


def packed(x: np.ndarray) -> bytes:
    """Bytes of equal weight side by side, which compresses well where the high ones are alike."""
    return np.ascontiguousarray(x.view(np.uint8).reshape(len(x), x.itemsize).T).tobytes()


def unpacked(data: bytes | None, kind: type) -> np.ndarray:
    size = np.dtype(kind).itemsize
    planes = np.frombuffer(data or b"", np.uint8).reshape(size, -1)
    return np.ascontiguousarray(planes.T).view(kind).reshape(-1)


def shingles(texts: pa.Array, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Document index and 56-bit hash of every shingle; ASCII letters count as lower case."""
    offsets, words = split_words(texts, lower=True)
    hashes, counts = hash_words(words), np.diff(offsets)
    docs, found = [], []
    for n in range(1, size + 1):  # texts of n < size words are one shingle
        chosen = np.flatnonzero(counts >= n if n == size else counts == n)
        sizes = counts[chosen] - n + 1
        at = ragged(offsets[chosen], sizes)
        h = np.full(len(at), n, np.uint64)
        for i in range(n):
            h = mixed(h + hashes[at + i])
        docs.append(np.repeat(chosen, sizes))
        found.append(h >> np.uint64(8))
    return np.concatenate(docs), np.concatenate(found)


def chunk_blocks(chunk: int, ids: list, docs: np.ndarray, hashes: np.ndarray, parts: int) -> Iterator[dict]:
    """A block for each part, and one with the chunk's documents and their frequent shingles.

    ``ids`` has two numbers for each document, its id and the hash of its text.
    """
    first = np.argsort(docs, kind="stable")
    docs, hashes = docs[first].astype(np.uint32), hashes[first]
    order = np.argsort(hashes, kind="stable")
    docs, hashes = docs[order], hashes[order]
    new = np.ones(len(hashes), bool)
    new[1:] = (hashes[1:] != hashes[:-1]) | (docs[1:] != docs[:-1])
    docs, hashes = docs[new], hashes[new]
    starts = np.flatnonzero(np.concatenate([[True], hashes[1:] != hashes[:-1]])) if len(hashes) else np.zeros(0, np.int64)
    sizes = np.diff(np.append(starts, len(hashes)))
    hot = sizes >= LOCALLY_FREQUENT
    of_hot = np.repeat(hot, sizes)
    yield {
        "part": parts + chunk % parts,
        "chunk": chunk,
        "ids": ids,
        "sizes": np.bincount(docs, minlength=len(ids) // 2).astype(np.int32),
        "own_hashes": packed(hashes[of_hot]),
        "own_members": packed(docs[of_hot]),
    }
    keep = ~of_hot
    keep[starts[hot]] = True
    docs[starts[hot]] = MARK
    members, counts = docs[keep], sizes[hot].astype(np.uint32)
    sent = hashes[keep]
    marks = np.concatenate([[0], np.cumsum(members == MARK)])
    for p, a, b in runs_of_parts(sent >> np.uint64(24), parts):
        deltas = np.diff(sent[a:b], prepend=np.uint64(0))
        yield {
            "part": p,
            "chunk": chunk,
            "hashes": packed(deltas),
            "members": packed(members[a:b]),
            "counts": packed(counts[marks[a] : marks[b]]),
        }


def runs_of_parts(upper: np.ndarray, parts: int) -> Iterator[tuple[int, int, int]]:
    """Part, first and last place of each run of sorted hashes, given by their upper 32 bits, in one of ``parts``."""
    part = (upper * np.uint64(parts)) >> np.uint64(32)
    starts = np.flatnonzero(np.concatenate([[True], part[1:] != part[:-1]])) if len(part) else np.zeros(0, np.int64)
    return zip(part[starts].tolist(), starts.tolist(), np.append(starts[1:], len(part)).tolist())


def _batch(rows: list[dict]) -> pa.RecordBatch:
    kinds = [("part", pa.int64()), ("chunk", pa.int64()), ("hashes", pa.binary()), ("members", pa.binary())]
    kinds += [("counts", pa.binary()), ("ids", pa.list_(pa.int64())), ("sizes", pa.list_(pa.int32()))]
    kinds += [("own_hashes", pa.binary()), ("own_members", pa.binary())]
    return pa.RecordBatch.from_pylist(rows, pa.schema(kinds))


def shared_in_part(part: pa.Table) -> pa.Table:
    """Keep the shingles found in two documents or more, with their numbers of documents."""
    blocks = part.to_pylist()
    hashes = [np.cumsum(unpacked(b["hashes"], np.uint64), dtype=np.uint64) for b in blocks]
    members = [unpacked(b["members"], np.uint32) for b in blocks]
    every, who = np.concatenate(hashes), np.concatenate(members)
    weight = np.ones(len(every), np.int64)
    weight[who == MARK] = np.concatenate([unpacked(b["counts"], np.uint32) for b in blocks])
    order = np.argsort(every, kind="stable")
    ordered = every[order]
    starts = np.flatnonzero(np.concatenate([[True], ordered[1:] != ordered[:-1]])) if len(every) else np.zeros(0, np.int64)
    counted = np.empty(len(every), np.int64)
    if len(every):
        sums = np.add.reduceat(weight[order], starts)
        counted[order] = np.repeat(sums, np.diff(np.append(starts, len(every))))
    ends = np.cumsum([len(h) for h in hashes])
    for block, h, m, end in zip(blocks, hashes, members, ends):
        if block["ids"] is None:
            count = counted[end - len(h) : end]
            keep = count > 1
            block["hashes"], block["members"] = packed(h[keep]), packed(m[keep])
            block["counts"] = packed(np.minimum(count[keep], MOST_COUNTED).astype(np.uint16))
    return pa.Table.from_batches([_batch(blocks)])


def allowed(n: np.ndarray, percent: int) -> np.ndarray:
    """How many of n shingles a linked document can lack."""
    return n - (n * percent + 99) // 100


def sets_of_chunk(chunk: pa.Table, percent: int) -> pa.Table:
    """One row per document; shared shingles, rarest first, only where a link is possible."""
    blocks = chunk.to_pylist()
    head = next(b for b in blocks if b["ids"] is not None)
    replies = [b for b in blocks if b["ids"] is None]
    join = lambda name, kind: np.concatenate([np.zeros(0, kind), *[unpacked(b[name], kind) for b in replies]])
    hashes, members, counts = join("hashes", np.uint64), join("members", np.uint32), join("counts", np.uint16)
    marked = members == MARK
    own = unpacked(head["own_hashes"], np.uint64)
    order = np.argsort(hashes[marked])
    own_counts = counts[marked][order][np.searchsorted(hashes[marked][order], own)] if len(own) else counts[:0]
    hashes = np.concatenate([hashes[~marked], own])
    members = np.concatenate([members[~marked], unpacked(head["own_members"], np.uint32)]).astype(np.int64)
    counts = np.concatenate([counts[~marked], own_counts])
    n = np.array(head["sizes"], np.int64)
    shared = np.bincount(members, minlength=len(n))
    possible = (n > 0) & (n - shared <= allowed(n, percent))
    keep = possible[members]
    hashes, members, counts = hashes[keep], members[keep], counts[keep]
    order = np.lexsort((hashes, counts, members))
    hashes, members, counts = hashes[order], members[order], counts[order]
    sizes = np.bincount(members, minlength=len(n))
    ends = np.cumsum(sizes)
    whole = possible & (shared == n)
    prints = []
    for salt in (1, 2):
        sums = np.concatenate([[np.uint64(0)], np.cumsum(mixed(hashes * np.uint64(2) + np.uint64(salt)), dtype=np.uint64)])
        prints.append(pa.array((sums[ends] - sums[ends - sizes]).view(np.int64), mask=~whole))
    offsets = pa.array(np.concatenate([[0], ends]).astype(np.int32), mask=np.append(~possible, False))
    bits = np.zeros((len(n), BITS // 64), np.uint64)
    at = hashes % np.uint64(BITS)
    np.bitwise_or.at(bits, (members, (at >> np.uint64(6)).astype(np.int64)), np.uint64(1) << (at & np.uint64(63)))
    ends_of_bits = np.concatenate([[0], np.cumsum(possible * (BITS // 64))]).astype(np.int32)
    columns = [
        pa.array(head["chunk"] + np.arange(len(n))),
        pa.array(head["ids"][0::2], pa.int64()),
        pa.array(head["ids"][1::2], pa.int64()),
        pa.array(n),
        pa.array(shared.astype(np.int32)),
        *prints,
        pa.ListArray.from_arrays(offsets, pa.array(hashes.view(np.int64))),
        pa.ListArray.from_arrays(offsets, pa.array(counts.astype(np.int32))),
        pa.ListArray.from_arrays(pa.array(ends_of_bits), pa.array(bits[possible].reshape(-1).view(np.int64))),
    ]
    return pa.Table.from_arrays(columns, ["row", "doc_id", "text_hash", "n_shingles", "shared", "print1", "print2", "hashes", "counts", "bits"])


def chunk_shingles(parts: int) -> int:
    """Shingles of a chunk: more where there are many parts, within what a task can hold."""
    return min(max(CHUNK_SHINGLES, SHINGLES_A_PART * parts), max(CHUNK_SHINGLES, MOST_CHUNK_SHINGLES))


def shingle_sets(docs: DataFrame, size: int, percent: int) -> DataFrame:
    """``SETS``, one row per row of ``docs``."""
    total = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    parts = max(64, -(-total // PART_BYTES))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, rows, docs_, hashes, base, held = [], [], [], [], 0, 0

        def flush() -> Iterator[pa.RecordBatch]:
            if not base:
                return
            pending = []
            for block in chunk_blocks(rows[0], ids, np.concatenate(docs_), np.concatenate(hashes), parts):
                pending.append(block)
                if len(pending) == 64:
                    yield _batch(pending)
                    pending = []
            yield _batch(pending)

        for batch in slices(batches, limit=SLICE_BYTES):
            d, h = shingles(batch["text"], size)
            ids += [x for pair in zip(batch["doc_id"].to_pylist(), batch["text_hash"].to_pylist()) for x in pair]
            rows.append(batch["row"][0].as_py())
            docs_.append(d + base)
            hashes.append(h)
            base += len(batch)
            held += len(h)
            if held >= chunk_shingles(parts):
                yield from flush()
                ids, rows, docs_, hashes, base, held = [], [], [], [], 0, 0
        yield from flush()

    numbered = in_small_batches(docs).select("doc_id", "text", F.xxhash64("text").alias("text_hash"), F.monotonically_increasing_id().alias("row"))
    blocks = numbered.mapInArrow(cut, BLOCK).groupBy("part").applyInArrow(shared_in_part, BLOCK)
    sets = blocks.groupBy("chunk").applyInArrow(lambda t: sets_of_chunk(t, percent), SETS)
    return kept(sets, "shingle_sets")


def pair_groups(n: int, percent: int) -> list[int]:
    """Numbers of classes within which a set of ``n`` shingles forms pairs.

    Close to where the number changes a set takes both, so that two linked sets have one in common: of
    two such sets the larger has at most 100 / percent times the shingles.
    """
    found, groups, start = [], 1, 0
    while start == 0 or n >= -(-start * percent // 100):
        after = SPLIT_FROM if start == 0 else start * 16 if groups == PAIR_GROUPS else start * 4
        if n <= (after - 1) * 100 // percent:
            found.append(groups)
        groups, start = PAIR_GROUPS if start == 0 else groups * 4, after
    return found


def signatures_of(hashes: np.ndarray, counts: np.ndarray, n: int, percent: int) -> tuple[np.ndarray, np.ndarray]:
    """Signatures of a set of ``n`` shingles, of which ``hashes`` are shared, rarest first.

    The flags tell which are found in the shorter prefix that does for links to larger sets.
    """
    alone = n - len(hashes)
    needed = int(allowed(np.int64(n), percent)) + 1 - alone
    needed_short = n - -(-2 * percent * n // (100 + percent)) + 1 - alone
    frequent = counts >= FREQUENT
    found, short = [], []
    for groups in pair_groups(n, percent):
        group = np.where(frequent, hashes % np.uint64(groups), np.uint64(groups)).astype(np.int64)
        # the first of each pair group adds nothing to what a linked document has to share
        gain = np.ones(len(hashes), np.int64)
        gain[np.unique(group[frequent], return_index=True)[1] + (len(hashes) - int(frequent.sum()))] = 0
        gained = np.cumsum(gain)
        end = int(np.searchsorted(gained, needed)) + 1
        short_end = int(np.searchsorted(gained, needed_short)) + 1 if needed_short > 0 else 0
        prefix, group = hashes[:end], group[:end]
        singles = np.flatnonzero(group == groups)
        found.append(mixed(prefix[singles]))
        short.append(singles < short_end)
        for g in range(groups):
            at = np.flatnonzero(group == g)
            if len(at) > 1:
                a, b = np.triu_indices(len(at), 1)
                one, two = prefix[at[a]], prefix[at[b]]
                found.append(mixed(mixed(np.minimum(one, two)) + np.maximum(one, two)))
                short.append(at[b] < short_end)
    values, flags = np.concatenate(found), np.concatenate(short)
    order = np.lexsort((~flags, values))
    values, flags = values[order], flags[order]
    new = np.concatenate([[True], values[1:] != values[:-1]]) if len(values) else np.zeros(0, bool)
    return values[new], flags[new]


def signatures(sets: DataFrame, percent: int) -> DataFrame:
    """``signature, short, row, n, shared`` of all documents that can have a link."""

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ends, counts = batch["hashes"].offsets.to_numpy(), batch["counts"].values.to_numpy()
            hashes, n = batch["hashes"].values.to_numpy().view(np.uint64), batch["n"].to_numpy()
            found = [signatures_of(hashes[a:b], counts[a:b], int(k), percent) for a, b, k in zip(ends, ends[1:], n)]
            of = np.repeat(np.arange(len(batch)), [len(f) for f, _ in found])
            values = pa.array(np.concatenate([f for f, _ in found]).view(np.int64))
            short = pa.array(np.concatenate([x for _, x in found]))
            own = [batch[c].take(pa.array(of)) for c in ("row", "n", "shared")]
            yield pa.RecordBatch.from_arrays([values, short, *own], ["signature", "short", "row", "n", "shared"])

    rows = sets.filter("hashes is not null and shared > 0").select("row", F.col("n_shingles").alias("n"), "shared", "hashes", "counts")
    return rows.mapInArrow(sign, "signature long, short boolean, row long, n long, shared int")


def _can_link(percent: int, a: str, b: str) -> Column:
    most = F.least(F.col(f"{a}_shared"), F.col(f"{b}_shared"))
    return most * (100 + percent) >= percent * (F.col(f"{a}_n") + F.col(f"{b}_n"))


def _bits_can_link(percent: int, a: str, b: str) -> Column:
    """A bit that only one set has stands for a shingle at least that the other one lacks."""

    def common(x: str, y: str) -> Column:
        lacking = F.zip_with(f"{x}_bits", f"{y}_bits", lambda v, w: F.bit_count(v.bitwiseAND(F.bitwise_not(w))))
        return F.col(f"{x}_shared") - F.aggregate(lacking, F.lit(0), lambda s, n: s + n)

    return F.least(common(a, b), common(b, a)) * (100 + percent) >= percent * (F.col(f"{a}_n") + F.col(f"{b}_n"))


def _verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Pairs ``a, b`` whose whole sets are similar enough."""
    lists = sets.filter("hashes is not null").select("row", F.col("n_shingles").alias("n"), "hashes")
    left = lists.select(F.col("row").alias("a"), F.col("n").alias("n1"), F.col("hashes").alias("set1"))
    right = lists.select(F.col("row").alias("b"), F.col("n").alias("n2"), F.col("hashes").alias("set2"))
    both = F.size(F.array_intersect("set1", "set2"))
    return pairs.join(left, "a").join(right, "b").filter(both * (100 + percent) >= percent * (F.col("n1") + F.col("n2"))).select("a", "b")


def jaccard_components(docs: DataFrame, size: int = 5, percent: int = 80) -> DataFrame:
    """``doc_id, text_hash, n_shingles, component_id, first`` of every row of ``docs`` (``doc_id, text``).

    Documents link if their sets of ``size``-word shingles have a Jaccard similarity of
    ``percent`` / 100 or more (at least 70); the component is the smallest id reachable over links.
    A text of fewer words is one shingle; null texts and texts without words have none and link
    with nothing. Repeated ids are separate rows; null ids count only where a component has no
    other. ``text_hash`` is Spark's ``xxhash64`` of the text; ``first`` tells the component's row with
    the smallest id (nulls last), then the smallest ``text_hash``, and its copies. Equal sets are one class from the start, so groups of copies cost one comparison.
    """
    if percent < 70:
        raise ValueError("prefixes of pairs need a similarity of 0.7 or more")
    sets = shingle_sets(docs, size, percent)
    alike = sets.filter("print1 is not null").groupBy("print1", "print2", "n_shingles").agg(F.min("row").alias("first"))
    named = sets.filter("print1 is not null").select("row", "print1", "print2", "n_shingles")
    firsts = kept(named.join(alike, ["print1", "print2", "n_shingles"]).select("row", "first"), "firsts")

    signed = signatures(sets, percent).join(firsts.filter("row <> first"), "row", "left_anti")
    groups = signed.groupBy("signature").agg(
        F.count("*").alias("members"), F.count_if("short").alias("shorts"), F.min_by("row", F.col("n") - F.col("shared")).alias("pivot")
    )
    groups = groups.filter("members > 1 and shorts > 0").select("signature", "pivot")
    signed = kept(signed.join(groups, "signature"), "signatures")
    sizes = sets.filter("hashes is not null").select("row", F.col("n_shingles").alias("n"), "shared")
    of = lambda name: sizes.select(*[F.col(c).alias(f"{name}_{c}" if c != "row" else name) for c in sizes.columns])
    star = signed.filter("row <> pivot").select(F.col("pivot").alias("a"), F.col("row").alias("b"), F.col("n").alias("b_n"), F.col("shared").alias("b_shared"))
    star = star.distinct().join(of("a"), "a").filter(_can_link(percent, "a", "b")).select("a", "b")
    links = kept(_verified(star, sets, percent), "links")

    found = components(links)
    placed = signed.join(found, signed["row"] == found["node"], "left")
    placed = placed.select("signature", "short", "row", "n", "shared", F.coalesce("component", "row").alias("component"))
    open_ = placed.groupBy("signature").agg(F.min("component").alias("low"), F.max("component").alias("high"))
    placed = placed.join(open_.filter("low < high").select("signature"), "signature")
    placed = placed.join(sets.filter("hashes is not null").select("row", "bits"), "row")
    side = lambda x: placed.select("signature", *[F.col(c).alias(f"{x}_{c}") for c in ("row", "n", "shared", "component", "short", "bits")])
    # of a linked pair the smaller set has a common signature in its shorter prefix
    larger = F.struct("b_n", "b_row") > F.struct("a_n", "a_row")
    apart = (F.col("a_component") != F.col("b_component")) & larger & _can_link(percent, "a", "b") & _bits_can_link(percent, "a", "b")
    rest = side("a").filter("a_short").join(side("b"), "signature").filter(apart)
    rest = rest.select(F.col("a_row").alias("a"), F.col("b_row").alias("b"))
    links = links.union(_verified(rest.distinct(), sets, percent))
    copies = firsts.filter("row <> first").select(F.col("first").alias("a"), F.col("row").alias("b"))
    found = kept(components(links.union(copies)), "components")

    rows = sets.select("row", "doc_id", "text_hash", "n_shingles")
    rows = rows.join(found.withColumnRenamed("node", "row"), "row", "left")
    rows = kept(rows.withColumn("component", F.coalesce("component", "row")), "members")
    key = F.struct(F.col("doc_id").isNull().alias("without"), "doc_id", "text_hash")
    least = rows.groupBy("component").agg(F.min("doc_id").alias("component_id"), F.min(key).alias("least"))
    first = F.col("doc_id").eqNullSafe(F.col("least.doc_id")) & (F.col("text_hash") == F.col("least.text_hash"))
    return rows.join(least, "component").select("doc_id", "text_hash", "n_shingles", "component_id", first.alias("first"))


def without_near_duplicates(docs: DataFrame, size: int = 5, percent: int = 80) -> DataFrame:
    """One row of each group of linked ``docs``: that with the smallest id.

    Rows that agree in id and text count as one. Of several texts under one smallest id, and of a
    group without ids, that with the smallest hash stays.
    """
    classes = jaccard_components(docs, size, percent)
    gone = classes.filter("not first")
    gone = gone.select(F.col("doc_id").alias("__id"), F.col("text_hash").alias("__gone"))
    rows = docs.withColumn("__hash", F.xxhash64("text"))
    same = F.col("doc_id").eqNullSafe(F.col("__id")) & (F.col("__hash") == F.col("__gone"))
    order = Window.partitionBy("doc_id", "__hash").orderBy("doc_id")
    left = rows.join(gone, same, "left_anti").withColumn("__copy", F.row_number().over(order))
    return left.filter("__copy = 1").select(*docs.columns)


SQL = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 3 THEN [array_to_string(w, ' ')]
    ELSE list_transform(range(1, len(w) - 1), lambda i: array_to_string(w[i:i + 2], ' ')) END) AS shingle FROM w),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
o AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM s a JOIN s b ON a.shingle = b.shingle AND a.doc_id <> b.doc_id
  GROUP BY a.doc_id, b.doc_id),
l AS (SELECT a, b FROM o JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * c >= 90 * (x.n + y.n - c)),
r AS (SELECT a, b FROM l UNION SELECT r.a, l.b FROM r JOIN l ON r.b = l.a),
c AS (SELECT a AS doc_id, min(b) AS low FROM r GROUP BY a)
SELECT doc_id, CAST(coalesce(n, 0) AS BIGINT) AS n_shingles, least(doc_id, coalesce(low, doc_id)) AS component_id
FROM documents LEFT JOIN n USING (doc_id) LEFT JOIN c USING (doc_id)
"""
