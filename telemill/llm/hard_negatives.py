"""Hard negatives of anchors: windows of inner products, found in cover trees.

Every vector x gets one more component, sqrt(M^2 - |x|^2), M being the largest norm, so that all lie on
one sphere and the inner product with an anchor q falls with the angle. If a ball of angle r around c
holds a set of points, their products with q lie between |q| M cos(t + r) and |q| M cos(t - r), t being
the angle of q and c.

1. Pivots chosen farthest first from a bounded sample are the top of the tree. Each vector goes to its
   nearest pivot; a pivot's vectors stand in blocks of bounded size.
2. Each block is a cover tree: a node's children are chosen farthest first, so they are as far apart as
   their covering radius, down to leaves of a few points.
3. A query visits the blocks of those pivots whose bounds meet its window, descends by levels past nodes
   outside the window, and verifies leaves exactly in the order of their upper bounds, until no bound
   reaches its last result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from telemill.llm.words import kept

SAMPLE, PIVOTS, SHARD_ROWS, BLOCK_ROWS = 4096, 1024, 2048, 4096
FAN, LEAF, SHRINK = 16, 256, 2.0
QUERIES_AT_ONCE, QUERIES_A_TASK = 256, 1 << 16
SCALE = 256
#: Bounds are widened by this share of the largest product, for rounding.
SLACK = 1e-6

#: A query has several windows, ``low[i]`` to ``high[i]``; a result names the one it belongs to.
QUERY = "asker long, home long, label long, same boolean, low array<double>, high array<double>, vector array<double>"
FOUND = "asker long, window long, row long, id long, score long"


def stacked(lists: pa.Array) -> np.ndarray:
    """Lists of one length as the rows of a matrix."""
    lists = lists.combine_chunks() if isinstance(lists, pa.ChunkedArray) else lists
    return lists.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(lists), -1)


def augmented(x: np.ndarray, most: float) -> np.ndarray:
    return np.column_stack([x, np.sqrt(np.maximum(most**2 - (x * x).sum(1), 0))])


def farthest_first(points: np.ndarray, first: int, count: int, enough: float = 0.0) -> tuple[list[int], np.ndarray, np.ndarray]:
    """Up to ``count`` centres, each the point farthest from those before, until all points are within
    ``enough`` of one; also each point's nearest centre and the distance to it."""
    centres, owner = [first], np.zeros(len(points), np.int64)
    gap = np.linalg.norm(points - points[first], axis=1)
    while len(centres) < count and gap.max() > enough:
        far = int(gap.argmax())
        new = np.linalg.norm(points - points[far], axis=1)
        owner[new < gap] = len(centres)
        gap = np.minimum(gap, new)
        centres.append(far)
    return centres, owner, gap


def angle_of(radius: np.ndarray, most: float) -> np.ndarray:
    return 2 * np.arcsin(np.minimum(radius / (2 * most), 1)) if most else np.zeros_like(radius)


def bounds(dots: np.ndarray, norms: np.ndarray, most: float, angle: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Least and largest product of each query (rows) with the points around each centre (columns)."""
    scale = norms[:, None] * most
    between = np.arccos(np.clip(np.divide(dots, scale, out=np.ones_like(dots), where=scale > 0), -1, 1))
    low, high = np.cos(np.minimum(between + angle, np.pi)), np.cos(np.maximum(between - angle, 0))
    return scale * (low - SLACK), scale * (high + SLACK)


class CoverTree:
    """Points (rows of ``x``) in the order of the leaves, and the nodes level by level."""

    def __init__(self, x: np.ndarray, most: float):
        points, self.most = augmented(x, most), most
        order = np.arange(len(x))
        self.levels, self.leaves = [], []
        nodes = [(0, len(x), 0, float(np.linalg.norm(points - points[0], axis=1).max()), 0)]  # first, last, centre, radius, parent
        while nodes:
            below, leaf = [], np.full(len(nodes), -1)
            for i, (a, b, centre, radius, _) in enumerate(nodes):
                if b - a <= LEAF or radius == 0:
                    leaf[i] = len(self.leaves)
                    self.leaves.append((a, b))
                    continue
                own = order[a:b]
                start = int(np.flatnonzero(own == centre)[0])
                centres, owner, gap = farthest_first(points[own], start, FAN, radius / SHRINK)
                centres = own[centres]
                order[a:b] = own[np.argsort(owner, kind="stable")]
                ends = a + np.cumsum(np.bincount(owner))
                for k, (c, end) in enumerate(zip(centres, ends)):
                    below.append((ends[k - 1] if k else a, end, c, float(gap[owner == k].max()), i))
            _, _, centres, radii, parents = zip(*nodes)
            self.levels.append((x[list(centres)], angle_of(np.array(radii), most), np.array(parents), leaf))
            nodes = below
        self.order, self.x = order, x[order]

    def leaves_for(self, q: np.ndarray, norms: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, ...]:
        """Query, leaf and upper bound wherever a leaf may hold points of the query's window."""
        found, open_ = [], np.ones((len(q), 1), bool)
        for centres, angle, parents, leaf in self.levels:
            least, largest = bounds(q @ centres.T, norms, self.most, angle)
            open_ = open_[:, parents] & ~(largest < low[:, None]) & ~(least > high[:, None])
            at, node = np.nonzero(open_ & (leaf >= 0))
            found.append((at, leaf[node], largest[at, node]))
        return tuple(np.concatenate(x) for x in zip(*found))

    def search(self, q: np.ndarray, low: np.ndarray, high: np.ndarray, allowed, ids: np.ndarray, k: int) -> tuple[np.ndarray, ...]:
        """The ``k`` best points by (score, smaller id) of each window: query, window, point, score.

        ``low`` and ``high`` have a row for each query and a column for each window. ``allowed(queries,
        points)`` tells which pairs may be returned, ``ids`` are those of the points.
        """
        norms, windows = np.linalg.norm(q, axis=1), low.shape[1]
        at, leaf, upper = self.leaves_for(q, norms, low.min(1), high.max(1))
        by_bound = np.lexsort((-upper, at))
        at, leaf, upper = at[by_bound], leaf[by_bound], upper[by_bound]
        nth = np.arange(len(at)) - np.searchsorted(at, at)
        # whole numbers below 2 ** 24 are exact in single precision
        kind = np.float32 if self.most * norms.max(initial=0) < 1 << 24 else np.float64
        q, x = q.astype(kind), self.x.astype(kind)
        least = low.copy()  # of each window: what a point has to reach now
        best = [np.zeros(0, t) for t in (np.int64, np.float64, np.int64)]  # place (query and window), score, point
        begin, step = 0, 1
        while begin <= nth.max(initial=-1):
            turn = np.flatnonzero((nth >= begin) & (nth < begin + step) & ~(upper < least[at].min(1)))
            new = [best]
            for one in np.unique(leaf[turn]):
                asked, (a, b) = at[turn[leaf[turn] == one]], self.leaves[one]
                score = q[asked] @ x[a:b].T
                score[~allowed(asked, self.order[a:b])] = -np.inf
                for w in range(windows):
                    good = (score >= least[asked, w, None]) & (score <= high[asked, w, None]) & (score > -np.inf)
                    some = np.flatnonzero(good.any(1))
                    own = np.where(good[some], score[some], -np.inf)
                    if b - a > k:  # only the best of them
                        own[own < np.partition(own, b - a - k, axis=1)[:, b - a - k, None]] = -np.inf
                    i, j = np.nonzero(own > -np.inf)
                    new.append([asked[some[i]] * windows + w, own[i, j].astype(np.float64), self.order[a + j]])
            place, score, point = (np.concatenate(x) for x in zip(*new))
            order = np.lexsort((ids[point], -score, place))
            rank = np.arange(len(order)) - np.searchsorted(place[order], place[order])
            best = [x[order[rank < k]] for x in (place, score, point)]
            last = order[rank == k - 1]
            reached = least.reshape(-1)
            reached[place[last]] = np.maximum(reached[place[last]], score[last])
            begin, step = begin + step, step * 2
        return best[0] // windows, best[0] % windows, best[2], best[1]


# --- the index -----------------------------------------------------------------------------------


def usable_vectors(vectors: DataFrame) -> DataFrame:
    """``row, id, label, anchor, vector, norm`` (components are floor(256 x)) of rows that take part."""
    vector = F.col("embedding").cast("array<double>")
    finite = F.forall(vector, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    rows = vectors.filter(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.coalesce(finite, F.lit(False)))
    rows = rows.select(
        F.monotonically_increasing_id().alias("row"), F.col("vec_id").cast("long").alias("id"), F.col("label").cast("long").alias("label"),
        F.coalesce("__anchor", F.lit(False)).alias("anchor"), vector.alias("vector"),
    )

    def quantised(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch["vector"]
            values = np.floor(SCALE * lists.flatten().to_numpy(zero_copy_only=False).astype(np.float64))
            offsets = lists.offsets.to_numpy() - lists.offsets[0].as_py()
            sums = np.add.reduceat(np.append(values * values, 0.0), offsets[:-1]) * (np.diff(offsets) > 0)
            columns = [batch[c] for c in ("row", "id", "label", "anchor")]
            columns += [pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(values)), pa.array(np.sqrt(sums))]
            yield pa.RecordBatch.from_arrays(columns, ["row", "id", "label", "anchor", "vector", "norm"])

    return kept(rows.mapInArrow(quantised, "row long, id long, label long, anchor boolean, vector array<double>, norm double"), "vectors")


def by_size(batch: pa.RecordBatch) -> Iterator[tuple[int, pa.RecordBatch]]:
    sizes = np.diff(batch["vector"].offsets.to_numpy())
    for size in np.unique(sizes):
        yield int(size), batch.take(pa.array(np.flatnonzero(sizes == size)))


class Pivots:
    """For each number of components: the pivots, and once all vectors are placed how many each has,
    in how many blocks, and their angle. Bounded by ``SAMPLE`` and ``PIVOTS``."""

    def __init__(self, rows: DataFrame):
        self.most = rows.agg(F.max("norm")).first()[0] or 0.0
        count = min(PIVOTS, -(-rows.count() // SHARD_ROWS))
        sample = rows.select("vector").orderBy(F.xxhash64("id", "row"), "row").limit(SAMPLE).toArrow().combine_chunks()
        self.centres, self.blocks, self.angles = {}, {}, {}
        for size, some in (x for batch in sample.to_batches() for x in by_size(batch)):
            x = stacked(some["vector"])
            chosen, _, _ = farthest_first(augmented(x, self.most), 0, count)
            self.centres[size] = np.vstack([self.centres.get(size, x[:0]), x[chosen]])

    def of(self, size: int) -> np.ndarray:
        """Pivots of a size; vectors of a size without any are all around nothing."""
        return self.centres.get(size, np.zeros((1, size)))

    def nearest(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        points, centres = augmented(x, self.most), augmented(self.of(x.shape[1]), self.most)
        near = (points @ centres.T).argmax(1)  # all have the same norm
        return near, np.linalg.norm(points - centres[near], axis=1)

    def fill(self, placed: DataFrame) -> None:
        found = placed.groupBy("size", "shard").agg(F.count("*").alias("n"), F.max("gap").alias("gap")).collect()
        for size in {r.size for r in found}:
            self.blocks[size], gaps = (np.zeros(len(self.of(size)), t) for t in (np.int64, np.float64))
            for r in found:
                if r.size == size:
                    self.blocks[size][r.shard], gaps[r.shard] = -(-r.n // BLOCK_ROWS), r.gap
            self.angles[size] = angle_of(gaps, self.most)


def place(rows: DataFrame, pivots: Pivots) -> DataFrame:
    """The rows with ``size, shard`` (the nearest pivot) and ``gap``, the distance to it."""

    def nearest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for size, some in by_size(batch):
                near, gap = pivots.nearest(stacked(some["vector"]))
                columns = [*some.columns, pa.array(np.full(len(some), size, np.int32)), pa.array(near.astype(np.int32)), pa.array(gap)]
                yield pa.RecordBatch.from_arrays(columns, [*some.schema.names, "size", "shard", "gap"])

    added = "size int, shard int, gap double"
    placed = kept(rows.mapInArrow(nearest, f"row long, id long, label long, anchor boolean, vector array<double>, norm double, {added}"), "placed")
    pivots.fill(placed)
    return placed


def search(queries: DataFrame, placed: DataFrame, pivots: Pivots, k: int, at_home: bool | None = None) -> DataFrame:
    """``FOUND``: for every window at least its ``k`` best rows, some per block visited.

    ``queries`` is a ``QUERY``, each with as many windows as the others. ``at_home`` restricts the visits to the
    query's own pivot (``home``), or to all others.
    """
    turns = -(-queries.count() // QUERIES_A_TASK) or 1

    def visits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for size, some in by_size(batch):
                if size not in pivots.blocks:
                    continue
                q, low, high = stacked(some["vector"]), stacked(some["low"]).min(1), stacked(some["high"]).max(1)
                blocks = pivots.blocks[size]
                least, largest = bounds(q @ pivots.of(size).T, np.linalg.norm(q, axis=1), pivots.most, pivots.angles[size])
                wanted = ~(largest < low[:, None]) & ~(least > high[:, None]) & (blocks > 0)
                if at_home is not None:
                    wanted &= (some["home"].to_numpy()[:, None] == np.arange(len(blocks))) == at_home
                asked, shard = np.nonzero(wanted)
                for a in range(0, len(asked), 4096):
                    own = some.take(pa.array(asked[a : a + 4096]))
                    more = [pa.array(np.full(len(own), size, np.int32)), pa.array(shard[a : a + 4096].astype(np.int32))]
                    more.append(pa.array(blocks[shard[a : a + 4096]]))
                    yield pa.RecordBatch.from_arrays([*own.columns, *more], [*own.schema.names, "size", "shard", "blocks"])

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, held, tree = None, [], None
        for batch in batches:
            names = np.stack([batch[c].to_numpy() for c in ("size", "shard", "block", "turn")] + [batch["low"].is_null().to_numpy(zero_copy_only=False)])
            cuts = [0, *(np.flatnonzero((names[:, 1:] != names[:, :-1]).any(0)) + 1), len(batch)]
            for a, b in zip(cuts, cuts[1:]):
                run = batch.slice(a, b - a)
                if names[4, a]:
                    if key != tuple(names[:4, a]):
                        key, held, tree = tuple(names[:4, a]), [], None
                    held.append(run)
                elif key == tuple(names[:4, a]):
                    if tree is None:
                        points = pa.Table.from_batches(held).combine_chunks()
                        tree = CoverTree(stacked(points["vector"]), pivots.most)
                    for i in range(0, len(run), QUERIES_AT_ONCE):
                        yield answers(tree, points, run.slice(i, QUERIES_AT_ONCE))

    def answers(tree: CoverTree, points: pa.Table, asked: pa.RecordBatch) -> pa.RecordBatch:
        rows, ids, labels = (points[c].to_numpy() for c in ("row", "id", "label"))
        own, label, same = asked["asker"].to_numpy(), asked["label"].to_numpy(), asked["same"].to_numpy(zero_copy_only=False)

        def allowed(q: np.ndarray, p: np.ndarray) -> np.ndarray:
            alike = label[q][:, None] == labels[p]
            return (alike == same[q][:, None]) & (own[q][:, None] != rows[p])

        at, window, point, score = tree.search(stacked(asked["vector"]), stacked(asked["low"]), stacked(asked["high"]), allowed, ids, k)
        columns = [own[at], window, rows[point], ids[point], score.astype(np.int64)]
        return pa.RecordBatch.from_arrays([pa.array(c) for c in columns], [c.split()[0] for c in FOUND.split(", ")])

    visited = queries.mapInArrow(visits, QUERY + ", size int, shard int, blocks long")
    visited = visited.withColumn("block", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
    visited = visited.withColumns({"turn": F.pmod(F.xxhash64("asker"), F.lit(turns)), "row": F.col("asker"), "id": F.col("asker")})
    blocks = F.create_map(*[F.lit(x) for s, n in pivots.blocks.items() for x in (int(s), [int(i) for i in n])])
    count = F.get(blocks[F.col("size")], F.col("shard")) if pivots.blocks else F.lit(1)
    points = placed.withColumn("block", F.pmod(F.xxhash64("row"), count))
    points = points.withColumn("turn", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(turns - 1).cast("long"))))
    columns = ["size", "shard", "block", "turn", "row", "id", "label", "vector"]
    asking = ["asker", "same", "low", "high"]
    both = points.select(*columns, *[F.lit(None).alias(c) for c in asking]).unionByName(visited.select(*columns, *asking))
    key = ["size", "shard", "block", "turn"]
    dealt = both.repartition(*key).sortWithinPartitions(*key, F.col("low").isNotNull())
    return dealt.mapInArrow(compare, FOUND)


def best(found: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("asker", "window").orderBy(F.desc("score"), "id", "row")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def hard_negatives(
    vectors: DataFrame, anchor: Column, positives: int = 5, negatives: int = 3, least_percent: int = 50, most_percent: int = 95
) -> DataFrame:
    """``anchor_id, positive_id, rank, negative_id, positive_score, negative_score``.

    ``vectors`` has ``vec_id, label, embedding``; ``anchor`` tells its anchors. A score is the inner
    product of the floored components of 256 x, exact up to 2^53. An anchor's positives are its best
    ``positives`` other rows of the same label; for each, its best ``negatives`` rows of another label
    between ``least_percent`` and ``most_percent`` of the positive's score are returned. Equal scores are
    ordered by id. Rows with a null id, label or vector, or with a null or non-finite component, take
    no part. Repeated ids are rows of their own; vectors of different sizes never meet; anchors without
    positives or negatives have no row; an empty table gives none. Other columns are ignored.
    """
    rows = usable_vectors(vectors.withColumn("__anchor", anchor).select("vec_id", "label", "embedding", "__anchor"))
    pivots = Pivots(rows)
    placed = place(rows, pivots)
    ask = lambda rows, **c: rows.select(*[c.get(n, F.col(n)).cast(t).alias(n) for n, t in (x.split() for x in QUERY.split(", "))])
    anchors = placed.filter("anchor").withColumn("home", F.col("shard"))
    unlimited = F.array(F.lit(float("inf")))
    asked = ask(anchors, asker=F.col("row"), same=F.lit(True), low=F.array(F.lit(float("-inf"))), high=unlimited)
    near = kept(best(search(asked, placed, pivots, positives, at_home=True), positives), "positives_at_home")
    floor = near.filter(F.col("rank") == positives).select("asker", F.array(F.col("score").cast("double")).alias("floor"))
    others = asked.join(floor, "asker", "left").withColumn("low", F.coalesce("floor", "low"))
    far = search(ask(others), placed, pivots, positives, at_home=False)
    chosen = best(near.drop("rank").unionByName(far), positives)
    chosen = chosen.select("asker", (F.col("rank") - 1).cast("long").alias("window"), F.col("id").alias("positive_id"), F.col("score").alias("positive_score"))
    chosen = kept(chosen, "positives")

    # one query for each anchor, a window for each positive; those that it lacks are empty
    score, empty = F.col("positive_score"), F.lit(float("inf"))
    ends = [F.ceil(score * least_percent / F.lit(100.0)).cast("double"), F.floor(score * most_percent / F.lit(100.0)).cast("double")]
    of = [[F.max(F.when(F.col("window") == i, end)) for i in range(positives)] for end in ends]
    windows = chosen.groupBy("asker").agg(
        F.array(*[F.coalesce(x, empty) for x in of[0]]).alias("low"), F.array(*[F.coalesce(x, -empty) for x in of[1]]).alias("high")
    )
    asked = ask(anchors.withColumnRenamed("row", "asker").join(windows, "asker"), same=F.lit(False))
    found = best(search(asked, placed, pivots, negatives), negatives)
    found = found.select("asker", "window", "rank", F.col("id").alias("negative_id"), F.col("score").alias("negative_score"))
    named = chosen.join(anchors.select(F.col("row").alias("asker"), F.col("id").alias("anchor_id")), "asker")
    return named.join(found, ["asker", "window"]).select(
        "anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), "negative_id", "positive_score", "negative_score"
    )


SQL = """
WITH v AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS e FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT a.vec_id AS anchor_id, v.vec_id AS other, a.label = v.label AS same, CAST(list_inner_product(a.e, v.e) AS BIGINT) AS score
  FROM v a JOIN v ON a.vec_id <> v.vec_id WHERE a.vec_id % 50 = 0),
p AS (
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other) AS n FROM s WHERE same) WHERE n <= 5),
n AS (
  SELECT p.anchor_id, p.other AS positive_id, s.other AS negative_id, p.score AS positive_score, s.score AS negative_score,
         row_number() OVER (PARTITION BY p.anchor_id, p.other ORDER BY s.score DESC, s.other) AS rank
  FROM p JOIN s ON s.anchor_id = p.anchor_id AND NOT s.same
   AND 50 * p.score <= 100 * s.score AND 100 * s.score <= 95 * p.score)
SELECT anchor_id, positive_id, CAST(rank AS INTEGER) AS rank, negative_id, positive_score, negative_score FROM n WHERE rank <= 3
"""
