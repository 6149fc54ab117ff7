"""Near-duplicate embeddings by binary codes of random rotations with correction factors.

1. A unit vector x is rotated by several random rotations R; the signs s of Rx are its code and
   f = <s / sqrt(D), Rx> its correction factor, D being the code's length. For another unit vector
   y, <s / sqrt(D), Ry> / f is an unbiased estimate of <x, y> over the rotations, with an error of at most
   ``SIGMAS`` * sqrt((1 - f^2) / f^2 / (D - 1)) but for a small probability.
2. The code's bits in bands of about log2(n) + 3 group vectors whose codes agree in a band. There are
   so many bands that a pair at the limit shares one with probability ``RECALL``. Most groups have
   one vector and are dropped before any vector travels.
3. In the groups, the estimate's upper bound decides which pairs are computed exactly. A pair
   belongs to the first band that both share, so each is looked at once.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, functions as F

from telemill.llm.components import components
from telemill.llm.words import kept, ragged

LIMIT, RECALL, SIGMAS, SEED = 0.95, 0.9999, 4.0, 11
#: Larger groups are cut into tiles of about this many vectors; tasks compare two tiles at a time.
TILE = 1024
PAIRS_AT_ONCE = 16_384

FOUND = "row long, links long, root long"
CODED = "row long, copies long, size int, bands array<int>, vector binary"
#: Bits of a band beyond log2(n): unrelated vectors then meet in about one band of 2 ** SPARE_BITS.
SPARE_BITS = 3


def plan_bands(n: int, limit: float = LIMIT, recall: float = RECALL) -> tuple[int, int]:
    """Bits of a band, and how many bands, for ``n`` different vectors."""
    bits = min(31, max(8, math.ceil(math.log2(max(n, 2))) + SPARE_BITS))
    agree = (1 - math.acos(limit) / math.pi) ** bits
    return bits, math.ceil(math.log(1 - recall) / math.log(1 - agree))


def rotations(size: int, length: int) -> np.ndarray:
    """Rows of as many random rotations of ``size`` dimensions as ``length`` rows take."""
    rng = np.random.default_rng([SEED, size])
    turns = [np.linalg.qr(rng.normal(size=(size, size)))[0] for _ in range(-(-length // size))]
    return np.concatenate(turns)[:length]


def unit_vectors(vectors: list[bytes], kind: str) -> np.ndarray:
    x = np.stack([np.frombuffer(v, kind) for v in vectors]).astype(np.float64)
    x = x / np.abs(x).max(1, keepdims=True)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def band_values(x: np.ndarray, bits: int, bands: int) -> np.ndarray:
    signs = (x @ rotations(x.shape[1], bits * bands).T > 0).reshape(len(x), bands, bits)
    return (signs * (np.uint64(1) << np.arange(bits, dtype=np.uint64))).sum(2).astype(np.uint32)


def forest(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The smallest node that each of ``n`` nodes reaches over the links a - b."""
    root = np.arange(n)
    while True:
        low = np.minimum(root[a], root[b])
        new = root.copy()
        np.minimum.at(new, a, low)
        np.minimum.at(new, b, low)
        new = new[new]
        if (new == root).all():
            return root
        root = new


class PairFinder:
    """Links among vectors of one size that lie in the same groups."""

    def __init__(self, bits: int, bands: int, limit: float):
        self.bits, self.bands, self.limit, self.frames = bits, bands, limit, {}

    def __call__(self, x: np.ndarray, codes: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Which of the pairs a - b link."""
        size, length = x.shape[1], codes.shape[1] * self.bits
        if size not in self.frames:
            self.frames[size] = rotations(size, length).astype(np.float32)
        turned = x.astype(np.float32) @ self.frames[size].T * np.float32(math.sqrt(size / length))
        shifts = np.arange(self.bits, dtype=np.uint32)
        signs = ((codes[:, :, None] >> shifts) & 1).reshape(len(x), -1).astype(np.float32) * 2 - 1
        signs /= np.float32(math.sqrt(length))
        factor = (signs * turned).sum(1)
        bound = SIGMAS * np.sqrt(np.maximum(1 - factor**2, 0) / (length - 1)) / factor
        found = np.zeros(len(a), bool)
        for i in range(0, len(a), PAIRS_AT_ONCE):
            p, q = a[i : i + PAIRS_AT_ONCE], b[i : i + PAIRS_AT_ONCE]
            estimate = np.einsum("ij,ij->i", signs[p], turned[q]) / factor[p]
            near = np.flatnonzero(estimate + bound[p] >= self.limit)
            exact = np.einsum("ij,ij->i", x[p[near]], x[q[near]])
            found[i + near] = exact >= self.limit
        return found


def usable(vector: Column) -> Column:
    """Not null, without null or non-finite components, and not zero."""
    good = F.forall(vector, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    return F.coalesce(vector.isNotNull() & good & F.exists(vector, lambda v: v != 0), F.lit(False))


def groups_of(coded: DataFrame) -> DataFrame:
    """``row, group, band, tile, across``: in which groups with others each vector is.

    Large groups are dealt out as pairs of tiles; a ``group`` then has all rows of two tiles.
    """
    rows = coded.select("row", "size", F.posexplode("bands").alias("band", "value"))
    rows = rows.select("row", "band", F.xxhash64("size", "band", "value").alias("key"))
    filled = rows.groupBy("key").agg(F.count("*").alias("n")).filter("n > 1")
    filled = filled.select("key", F.ceil(F.col("n") / TILE).cast("int").alias("tiles"))
    rows = rows.join(filled, "key").withColumn("tile", F.pmod(F.xxhash64("row"), F.col("tiles")).cast("int"))
    rows = rows.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("tiles") - 1)))
    group = F.xxhash64("key", F.least("tile", "other"), F.greatest("tile", "other")).alias("group")
    return rows.select("row", group, "band", "tile", (F.col("other") != F.col("tile")).alias("across"))


def links_in_groups(reps: DataFrame, bits: int, bands: int, limit: float, kind: str) -> DataFrame:
    """``row, links, root``: partial link counts, and links enough to connect what is connected."""
    width = np.dtype(kind).itemsize

    def code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw = batch["vector"].to_pylist()
            sizes = np.array([len(v) // width for v in raw])
            for size in np.unique(sizes):
                for at in range(0, int((sizes == size).sum()), 1024):
                    chosen = np.flatnonzero(sizes == size)[at : at + 1024]
                    codes = band_values(unit_vectors([raw[i] for i in chosen], kind), bits, bands).astype(np.int32)
                    some = batch.take(pa.array(chosen))
                    lists = pa.ListArray.from_arrays(pa.array(np.arange(len(chosen) + 1, dtype=np.int32) * bands), pa.array(codes.reshape(-1)))
                    columns = [some["row"], some["copies"], pa.array(np.full(len(chosen), size, np.int32)), lists, some["vector"]]
                    yield pa.RecordBatch.from_arrays(columns, ["row", "copies", "size", "bands", "vector"])

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        finder, rest = PairFinder(bits, bands, limit), None
        for batch in batches:
            table = pa.Table.from_batches([batch]) if rest is None else pa.concat_tables([rest, pa.Table.from_batches([batch])])
            groups = table["group"].to_numpy()
            cut = int(np.flatnonzero(groups != groups[-1])[-1]) + 1 if (groups != groups[-1]).any() else 0
            rest = table.slice(cut)
            if cut:
                yield from links(finder, table.slice(0, cut))
        if rest is not None:
            yield from links(finder, rest)

    def links(finder: PairFinder, table: pa.Table) -> Iterator[pa.RecordBatch]:
        sizes = pc.binary_length(table["vector"])
        for size in pc.unique(sizes):
            yield from links_of_size(finder, table.filter(pc.equal(sizes, size)))

    def links_of_size(finder: PairFinder, table: pa.Table) -> Iterator[pa.RecordBatch]:
        groups = table["group"].to_numpy()
        starts = np.flatnonzero(np.concatenate([[True], groups[1:] != groups[:-1]]))
        sizes = np.diff(np.append(starts, len(groups)))
        table = table.take(pa.array(ragged(starts[sizes > 1], sizes[sizes > 1])))
        if not len(table):
            return
        sizes = sizes[sizes > 1]
        later = np.repeat(np.cumsum(sizes), sizes) - np.arange(len(table)) - 1
        x = unit_vectors(table["vector"].to_pylist(), kind)
        codes = table["bands"].combine_chunks().flatten().to_numpy().reshape(-1, bands).astype(np.uint32)
        band, tile, across = (table[c].to_numpy() for c in ("band", "tile", "across"))
        left, right = [], []
        for part in np.array_split(np.arange(len(table)), -(-int(later.sum()) // (1 << 20)) or 1):
            a = np.repeat(part, later[part])
            b = ragged(part + 1, later[part])
            wanted = ~across[a] | (tile[a] != tile[b])
            a, b = a[wanted], b[wanted]
            # the pair is this group's if no earlier band has both in one group
            same = np.ones(len(a), bool)
            for i in range(codes.shape[1]):
                same &= ~((codes[a, i] == codes[b, i]) & (i < band[a]))
            a, b = a[same], b[same]
            found = finder(x, codes, a, b)
            left.append(a[found])
            right.append(b[found])
        a, b = np.concatenate(left), np.concatenate(right)
        copies, rows = table["copies"].to_numpy(), table["row"].to_numpy()
        n = np.bincount(a, copies[b], len(rows)) + np.bincount(b, copies[a], len(rows))
        root, some = forest(len(rows), a, b), np.flatnonzero(n)
        out = [pa.array(rows[some]), pa.array(n[some].astype(np.int64)), pa.array(rows[root[some]])]
        yield pa.RecordBatch.from_arrays(out, ["row", "links", "root"])

    coded = kept(reps.mapInArrow(code, CODED), "coded")
    rows = groups_of(coded).join(coded.drop("size"), "row")
    return rows.repartition("group").sortWithinPartitions("group").mapInArrow(compare, FOUND)


def near_duplicates(vectors: DataFrame, limit: float = LIMIT, recall: float = RECALL) -> DataFrame:
    """``vec_id, n_links, component_id, kept`` of every row of ``vectors`` (``vec_id, embedding``).

    Vectors link if their cosine in double precision is at least ``limit``; every link reported is
    exact, and a pair at the limit is found with probability ``recall``, closer ones more surely.
    Equal vectors are compared once and count each. Vectors that are null, empty or zero, or hold
    null or non-finite components, link with nothing, nor do vectors of different sizes. Repeated
    ids are separate vectors; null ids count only in components without any other.
    """
    single = vectors.schema["embedding"].dataType.elementType.typeName() == "float"
    kind, vector = ("<f4", F.col("embedding")) if single else ("<f8", F.col("embedding").cast("array<double>"))
    rows = vectors.select(F.monotonically_increasing_id().alias("row"), "vec_id", F.when(usable(vector), vector).alias("embedding"))

    def to_bytes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch["embedding"]
            ends, values = lists.offsets.to_numpy(), lists.values.to_numpy(zero_copy_only=False)
            usable_ = lists.is_valid().to_pylist()
            raw = [values[a:b].tobytes() if v else None for a, b, v in zip(ends, ends[1:], usable_)]
            yield pa.RecordBatch.from_arrays([batch["row"], batch["vec_id"], pa.array(raw, pa.binary())], ["row", "vec_id", "vector"])

    rows = kept(rows.mapInArrow(to_bytes, "row long, vec_id long, vector binary"), "vectors")
    # the salt comes first: after the vector it would only be mixed into the first print
    key = [F.xxhash64("vector").alias("h1"), F.xxhash64(F.lit(SEED), "vector").alias("h2")]
    alike = rows.filter("vector is not null").groupBy(*key).agg(F.min("row").alias("first"), F.count("*").alias("copies"))
    alike = kept(alike, "alike")
    named = rows.filter("vector is not null").select("row", *key).join(alike, ["h1", "h2"]).select("row", "first", "copies")
    reps = rows.join(alike.select(F.col("first").alias("row"), "copies"), "row").select("row", "copies", "vector")
    found = kept(links_in_groups(reps, *plan_bands(alike.count(), limit, recall), limit, kind), "found")

    linked = found.groupBy("row").agg(F.sum("links").alias("links")).withColumnRenamed("row", "first")
    of = components(found.filter("row <> root").select(F.col("row").alias("a"), F.col("root").alias("b")))
    named = named.join(linked, "first", "left").join(of.withColumnRenamed("node", "first"), "first", "left")
    others = (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("others")
    named = named.select("row", others, F.coalesce("component", "first").alias("component"))
    placed = kept(rows.select("row", "vec_id").join(named, "row", "left").withColumn("component", F.coalesce("component", "row")), "placed")
    least = placed.groupBy("component").agg(F.min("vec_id").alias("component_id"))
    return placed.join(least, "component").select(
        "vec_id",
        F.coalesce("others", F.lit(0)).cast("long").alias("n_links"),
        "component_id",
        F.col("vec_id").eqNullSafe(F.col("component_id")).alias("kept"),
    )


SQL = """
WITH RECURSIVE v AS (
  SELECT vec_id, list_transform(embedding, lambda x: x::DOUBLE) AS e FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
l AS (SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.vec_id <> b.vec_id AND list_cosine_similarity(a.e, b.e) >= 0.95),
n AS (SELECT a AS vec_id, count(*) AS n FROM l GROUP BY a),
r AS (SELECT a, b FROM l UNION SELECT r.a, l.b FROM r JOIN l ON r.b = l.a),
c AS (SELECT a AS vec_id, min(b) AS low FROM r GROUP BY a)
SELECT vec_id, CAST(coalesce(n, 0) AS BIGINT) AS n_links, least(vec_id, coalesce(low, vec_id)) AS component_id,
       vec_id = least(vec_id, coalesce(low, vec_id)) AS kept
FROM embeddings LEFT JOIN n USING (vec_id) LEFT JOIN c USING (vec_id)
"""
