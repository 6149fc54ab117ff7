"""The trie of conversation prefixes, measured along its Euler tour.

1. Turns are dealt out by ranges of (conversation, order). A turn's print and its place give a value;
   the exclusive or of the values up to a turn is the print of that prefix (128 bits; equal prints
   count as equal). Equal prefixes are one node.
2. Every node has an arc in and an arc out. The arc in is followed by the one into the first child or by
   the node's own arc out, the arc out by the one into the next sibling or by the parent's arc out.
   Children stand in the order of their smallest member, so that arcs near in the tour are mostly
   near in the table.
3. The list of arcs is ranked: each task contracts the stretches that lie within its range of nodes,
   pointer jumping ranks the stretches, and an arc's place is that of its stretch and within it.
4. Sums of leaves and savings up to each place give those of every subtree as a difference.

Whatever belongs to one conversation or one parent is handled by parts of the ranges first, so no task
has all turns of a conversation or all children of a node.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from telemill.llm.words import kept

PART_ROWS = 500_000
SPAN = 1 << 16
IDS_AT_ONCE = 1 << 15
ARCS = "arc long, head long, behind long, tail boolean, follower long, leaf long, saving long"


def _parts(spark, rows: int) -> int:
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-rows // PART_ROWS))


def _before(name: str, key: str, total) -> Column:
    """``total`` of ``name`` over the earlier parts of the same key."""
    earlier = Window.partitionBy(key).orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    return F.coalesce(total(name).over(earlier), F.lit(0).cast("long"))


# --- conversations -------------------------------------------------------------------------------


def rebuilt_turns(conversations: DataFrame, graft: tuple[int, int] | None = None) -> tuple[DataFrame, DataFrame]:
    """Turns of all conversations in order, and the conversations with their numbers of turns.

    The first has ``conv, part, at`` (from 1), ``length, g1, g2`` (prints of role and text), ``words``.
    With ``graft = (group, modulus)`` a conversation c first has the first h turns of conversation
    c - c % group, h being crc32(decimal c) % modulus, and then its own after its first h.
    """
    spark = conversations.sparkSession
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    turns = conversations.filter("conv_id is not null").select(
        F.col("conv_id").cast("long").alias("conv"),
        "turn",
        F.xxhash64(F.lit(1), role, text).alias("g1"),
        F.xxhash64(F.lit(2), role, text).alias("g2"),
        F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")).cast("long").alias("words"),
    )
    order = ["conv", F.col("turn").asc_nulls_first(), "g1", "g2"]
    dealt = turns.repartitionByRange(_parts(spark, 0), *order).withColumn("part", F.spark_partition_id())
    dealt = kept(dealt, "turns")

    parts = dealt.groupBy("conv", "part").agg(F.count("*").alias("n"))
    parts = kept(parts.withColumn("before", _before("n", "conv", F.sum)), "turn_parts")
    group, modulus = graft or (1, 1)
    convs = parts.groupBy("conv").agg(F.sum("n").alias("n"))
    convs = convs.withColumn("h", F.crc32(F.col("conv").cast("string").cast("binary")) % modulus)
    convs = convs.withColumn("base", F.col("conv") - F.col("conv") % group)
    of_base = convs.select(F.col("conv").alias("base"), F.col("n").alias("base_n"))
    head = F.least("h", F.coalesce("base_n", F.lit(0)))
    convs = convs.join(of_base, "base", "left").withColumn("head", head)
    length = F.col("head") + F.greatest(F.col("n") - F.col("h"), F.lit(0))
    convs = kept(convs.select("conv", "base", "h", "head", length.alias("length")), "conversations")

    numbers = parts.join(convs.drop("base"), "conv").drop("n")
    within = Window.partitionBy("conv", "part").orderBy(*order[1:])
    placed = dealt.join(numbers, ["conv", "part"]).withColumn("place", F.col("before") + F.row_number().over(within))
    placed = kept(placed.drop("turn", "before"), "placed")
    columns = ["conv", "part", "at", "length", "g1", "g2", "words"]
    tails = placed.filter("place > h").withColumn("at", F.col("head") + F.col("place") - F.col("h")).select(columns)
    heads = placed.filter((F.col("place") < modulus) & (F.col("conv") % group == 0))
    heads = heads.select(F.col("conv").alias("base"), F.col("place").alias("at"), "g1", "g2", "words")
    heads = heads.join(convs, "base").filter("at <= h").withColumn("part", F.lit(-1)).select(columns)
    return tails.unionByName(heads), convs.select("conv", "length")


def prefixes(turns: DataFrame) -> DataFrame:
    """``conv, at, length, words, f1, f2, p1, p2`` of every turn: p is the print of the prefix up to it,
    p with f taken out that of the prefix before."""
    turns = turns.withColumns({"f1": F.xxhash64("at", "g1"), "f2": F.xxhash64("at", "g2")})
    parts = turns.groupBy("conv", "part").agg(F.bit_xor("f1").alias("x1"), F.bit_xor("f2").alias("x2"))
    parts = parts.select("conv", "part", *[_before(x, "conv", F.bit_xor).alias(x) for x in ("x1", "x2")])
    so_far = Window.partitionBy("conv", "part").orderBy("at").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    prints = [F.col(f"x{i}").bitwiseXOR(F.bit_xor(f"f{i}").over(so_far)).alias(f"p{i}") for i in (1, 2)]
    return turns.join(parts, ["conv", "part"]).select("conv", "at", "length", "words", "f1", "f2", *prints)


# --- nodes ---------------------------------------------------------------------------------------


def trie_nodes(rows: DataFrame, convs: DataFrame, parts: int) -> DataFrame:
    """``depth, p1, p2, pp1, pp2, conv, n_convs, saving, part, id``: a row for every node."""
    nodes = rows.groupBy(F.col("at").cast("long").alias("depth"), "p1", "p2").agg(
        F.min("f1").alias("f1"), F.min("f2").alias("f2"), F.min("conv").alias("conv"),
        F.count("*").alias("n_convs"), F.max("words").alias("words"),
    )
    nodes = nodes.select(
        "depth", "p1", "p2", *[F.col(f"p{i}").bitwiseXOR(F.col(f"f{i}")).alias(f"pp{i}") for i in (1, 2)],
        "conv", "n_convs", ((F.col("n_convs") - 1) * F.col("words")).alias("saving"),
    )
    zero = F.lit(0).cast("long")
    root = convs.agg(F.min("conv").alias("conv"), F.count("*").alias("n_convs")).filter("n_convs > 0")
    root = root.select(*[zero.alias(c) for c in ("depth", "p1", "p2", "pp1", "pp2")], "conv", "n_convs", zero.alias("saving"))
    dealt = nodes.unionByName(root).repartitionByRange(parts, "conv", "depth")
    return kept(dealt.withColumns({"part": F.spark_partition_id(), "id": F.monotonically_increasing_id()}), "nodes")


def trie_edges(nodes: DataFrame) -> DataFrame:
    """``id, parent, parent_conv, part, conv`` of every node but the root."""
    below = nodes.filter("depth > 0").withColumn("up", F.col("depth") - 1)
    above = nodes.select(
        F.col("depth").alias("up"), F.col("p1").alias("pp1"), F.col("p2").alias("pp2"),
        F.col("id").alias("parent"), F.col("conv").alias("parent_conv"),
    )
    print_ = ["up", "pp1", "pp2"]
    # each part asks once for a parent, however many children it has there
    found = below.select("part", *print_).distinct().join(above, print_)
    return kept(below.join(found, ["part", *print_]).select("id", "parent", "parent_conv", "part", "conv"), "edges")


def tour_arcs(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """``id, part, down, out, n_children, saving``: the arcs that follow a node's arc in and arc out.

    Of node i, 2 i is the arc in and 2 i + 1 the arc out.
    """
    groups = edges.groupBy("parent", "part").agg(
        F.min_by("id", "conv").alias("first"), F.max_by("id", "conv").alias("last"), F.count("*").alias("n")
    )
    groups = groups.withColumn("after", F.lead("first").over(Window.partitionBy("parent").orderBy("part")))
    groups = kept(groups, "sibling_groups")
    first = groups.groupBy("parent").agg(F.min_by("first", "part").alias("first"), F.sum("n").alias("n_children"))
    within = Window.partitionBy("parent", "part").orderBy("conv")
    sibling = F.coalesce(F.lead("id").over(within), F.when(F.col("id") == F.col("last"), F.col("after")))
    out = F.coalesce(2 * sibling, 2 * F.col("parent") + 1)
    outs = edges.join(groups, ["parent", "part"]).select("id", out.alias("out"))
    rows = nodes.select("id", "part", "saving").join(first.withColumnRenamed("parent", "id"), "id", "left").join(outs, "id", "left")
    down = F.coalesce(2 * F.col("first"), 2 * F.col("id") + 1)
    return rows.select("id", "part", down.alias("down"), "out", F.coalesce("n_children", F.lit(0)).cast("long").alias("n_children"), "saving")


# --- list ranking --------------------------------------------------------------------------------


def contract(table: pa.Table) -> pa.Table:
    """Stretches of the list within one part: of each arc the stretch's first arc, and how far behind
    that it comes; of the last arc of a stretch also the one that follows."""
    ids, down = table["id"].to_numpy(), table["down"].to_numpy()
    out = table["out"].fill_null(-1).to_numpy()
    arcs, follower = np.concatenate([2 * ids, 2 * ids + 1]), np.concatenate([down, out])
    order = np.argsort(arcs)
    arcs, follower = arcs[order], follower[order]
    at = np.minimum(np.searchsorted(arcs, follower), len(arcs) - 1)
    inside = arcs[at] == follower
    up, behind = np.arange(len(arcs)), np.zeros(len(arcs), np.int64)
    up[at[inside]], behind[at[inside]] = np.flatnonzero(inside), 1
    while (up[up] != up).any():
        behind, up = behind + behind[up], up[up]
    none = np.zeros(len(ids), np.int64)
    leaf, saving = (table["n_children"].to_numpy() == 0).astype(np.int64), table["saving"].to_numpy()
    columns = [arcs, arcs[up], behind, ~inside, pa.array(follower, mask=inside | (follower < 0))]
    columns += [np.concatenate([x, none])[order] for x in (leaf, saving)]
    return pa.Table.from_arrays([pa.array(c) for c in columns], [c.split()[0] for c in ARCS.split(", ")])


def distances(stretches: DataFrame) -> DataFrame:
    """``head, left``: how many arcs there are from the first of each stretch to the end of the list.

    ``stretches`` has ``head, follower, left``, the last being its own number of arcs. Pointer
    jumping: in each round everyone skips to where the one it points to points.
    """
    now = kept(stretches, "jumps")
    while not now.filter("follower is not null").isEmpty():
        ahead = now.select(F.col("head").alias("follower"), F.col("follower").alias("further"), F.col("left").alias("more"))
        left = F.col("left") + F.coalesce("more", F.lit(0))
        now = kept(now.join(ahead, "follower", "left").select("head", F.col("further").alias("follower"), left.alias("left")), "jumps")
    return now.select("head", "left")


def subtree_sums(arcs: DataFrame) -> DataFrame:
    """``id, n_leaves, saved_tokens``: sums over every node's subtree, itself included."""
    stretches = kept(arcs.groupBy("part").applyInArrow(contract, ARCS), "stretches")
    left = distances(stretches.filter("tail").select("head", "follower", (F.col("behind") + 1).alias("left")))
    # places count from the end of the list
    placed = stretches.join(left, "head").select("arc", (F.col("behind") - F.col("left")).alias("place"), "leaf", "saving")
    placed = placed.withColumn("span", F.floor(F.col("place") / SPAN))
    totals = placed.groupBy("span").agg(F.sum("leaf").alias("leaves"), F.sum("saving").alias("savings"))
    earlier = Window.orderBy("span").rowsBetween(Window.unboundedPreceding, -1)
    totals = totals.select("span", *[F.coalesce(F.sum(c).over(earlier), F.lit(0)).alias(c) for c in ("leaves", "savings")])
    so_far = Window.partitionBy("span").orderBy("place").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    summed = placed.join(totals, "span").select(
        F.expr("arc div 2").alias("id"), (F.col("arc") % 2 == 1).alias("out"), "leaf", "saving",
        (F.col("leaves") + F.sum("leaf").over(so_far)).alias("leaves"), (F.col("savings") + F.sum("saving").over(so_far)).alias("savings"),
    )
    over = lambda total, own: F.sum(F.when(F.col("out"), F.col(total)).otherwise(F.col(own) - F.col(total)))
    return summed.groupBy("id").agg(over("leaves", "leaf").alias("n_leaves"), over("savings", "saving").alias("saved_tokens"))


# --- members that end at a node ------------------------------------------------------------------


def end_digests(ends: DataFrame, parts: int) -> DataFrame:
    """``depth, p1, p2, ends_sha256`` over rows ``depth, p1, p2, conv``: hash of the comma-joined ids.

    Ranges of a node's ids are joined where they are; the hash then runs over these few texts, one at a time.
    """
    key = ["depth", "p1", "p2"]

    def join_ids(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = np.stack([batch[c].to_numpy() for c in key])
            new = np.concatenate([[True], (keys[:, 1:] != keys[:, :-1]).any(0)])
            new[::IDS_AT_ONCE] = True
            ids, starts = batch["conv"].to_pylist(), np.flatnonzero(new)
            texts = [",".join(map(str, ids[a:b])) for a, b in zip(starts, [*starts[1:], len(ids)])]
            own = batch.take(pa.array(starts))
            yield pa.RecordBatch.from_arrays([*(own[c] for c in key), own["conv"], pa.array(texts, pa.string())], [*key, "conv", "ids"])

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, state = None, None
        for batch in batches:
            done = []
            for *node, ids in zip(*(batch[c].to_pylist() for c in (*key, "ids"))):
                if node != held:
                    if held is not None:
                        done.append((*held, state.hexdigest()))
                    held, state = node, hashlib.sha256()
                else:
                    state.update(b",")
                state.update(ids.encode())
            if done:
                yield batch_of(done)
        if held is not None:
            yield batch_of([(*held, state.hexdigest())])

    def batch_of(rows: list[tuple]) -> pa.RecordBatch:
        kinds = [pa.int64()] * 3 + [pa.string()]
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], [*key, "ends_sha256"])

    dealt = ends.repartitionByRange(parts, *key, "conv").sortWithinPartitions(*key, "conv")
    joined = dealt.mapInArrow(join_ids, "depth long, p1 long, p2 long, conv long, ids string")
    return joined.repartition(*key).sortWithinPartitions(*key, "conv").mapInArrow(digest, "depth long, p1 long, p2 long, ends_sha256 string")


def prefix_trie(conversations: DataFrame, graft: tuple[int, int] | None = None) -> DataFrame:
    """A row for every node of the trie of ``conversations`` (``conv_id, turn, role, text``).

    Columns ``conv_id`` (smallest member), ``depth, parent_conv_id, n_convs, n_children, n_leaves,
    saved_tokens, ends_sha256``. Turns are ordered by ``turn``, null first; of equal ones that with the
    smaller hash of role and text comes first, repeated rows are turns of their own. Null role or text
    is empty; rows without ``conv_id`` belong to no conversation; an empty table has no node. A node's
    saving is its members beyond the first times the words of its last text. Other columns are ignored.
    For ``graft`` see ``rebuilt_turns``.
    """
    turns, convs = rebuilt_turns(conversations, graft)
    rows = kept(prefixes(turns), "prefixes")
    parts = _parts(conversations.sparkSession, rows.count())
    nodes = trie_nodes(rows, convs, parts)
    edges = trie_edges(nodes)
    arcs = kept(tour_arcs(nodes, edges), "arcs")
    zero = F.lit(0).cast("long")
    ends = rows.filter("at = length").select(F.col("at").cast("long").alias("depth"), "p1", "p2", "conv")
    ends = ends.unionByName(convs.filter("length = 0").select(*[zero.alias(c) for c in ("depth", "p1", "p2")], "conv"))
    whole = nodes.join(arcs.select("id", "n_children"), "id").join(subtree_sums(arcs), "id")
    whole = whole.join(edges.select("id", "parent_conv"), "id", "left").join(end_digests(ends, parts), ["depth", "p1", "p2"], "left")
    return whole.select(
        F.col("conv").alias("conv_id"),
        "depth",
        F.col("parent_conv").alias("parent_conv_id"),
        "n_convs",
        "n_children",
        "n_leaves",
        "saved_tokens",
        F.coalesce("ends_sha256", F.sha2(F.lit("").cast("binary"), 256)).alias("ends_sha256"),
    )


#: The query's graft: first turns of the conversation of each group of 20, crc32 % 4 of them.
GRAFT = (20, 4)

SQL = r"""
WITH o AS (
  SELECT conv_id AS c, coalesce(role, '') AS r, coalesce(text, '') AS t,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS pos
  FROM conversations WHERE conv_id IS NOT NULL),
k AS (SELECT c, count(*) AS n, c - c % 20 AS b,
        list_reduce(list_transform(string_split(CAST(c AS VARCHAR), ''), lambda x: CAST(ascii(x) AS BIGINT)),
          lambda s, x: list_reduce([0, 1, 2, 3, 4, 5, 6, 7], lambda a, i: CASE WHEN a % 2 = 1 THEN xor(a // 2, 3988292384) ELSE a // 2 END,
                                   xor(s, x)), CAST(4294967295 AS BIGINT)) AS crc
      FROM o GROUP BY c),
h AS (SELECT k.c, k.n, k.b, 3 - k.crc % 4 AS h, least(3 - k.crc % 4, coalesce(x.n, 0)) AS head FROM k LEFT JOIN k x ON x.c = k.b),
z AS (
  SELECT h.c, o.pos AS d, r, t FROM h JOIN o ON o.c = h.b AND o.pos <= h.h
  UNION ALL SELECT h.c, h.head + o.pos - h.h, r, t FROM h JOIN o ON o.c = h.c AND o.pos > h.h),
y AS (
  SELECT c, d, t, list({'r': r, 't': t}) OVER (PARTITION BY c ORDER BY d) AS key FROM z
  UNION ALL SELECT c, 0, '', [] FROM h),
m AS (
  SELECT c, d, d = max(d) OVER (PARTITION BY c) AS last, min(c) OVER (PARTITION BY d, key) AS node,
         len(regexp_extract_all(t, '[^\x20\x09-\x0D]+')) AS words FROM y),
g AS (
  SELECT node, d, count(*) AS n_convs, (count(*) - 1) * max(words) AS saving,
         sha256(coalesce(string_agg(CAST(c AS VARCHAR), ',' ORDER BY c) FILTER (last), '')) AS ends_sha256
  FROM m GROUP BY node, d),
e AS (SELECT g.*, m.node AS parent FROM g LEFT JOIN m ON m.c = g.node AND m.d = g.d - 1),
n AS (SELECT parent AS node, d - 1 AS d, count(*) AS n_children FROM e WHERE d > 0 GROUP BY ALL),
s AS (
  SELECT m.node, m.d, count(*) FILTER (n.node IS NULL) AS n_leaves, sum(g.saving) AS saved
  FROM g JOIN m ON m.c = g.node AND m.d <= g.d LEFT JOIN n ON n.node = g.node AND n.d = g.d GROUP BY m.node, m.d)
SELECT e.node AS conv_id, CAST(e.d AS BIGINT) AS depth, e.parent AS parent_conv_id, n_convs, CAST(coalesce(n_children, 0) AS BIGINT) AS n_children,
       CAST(n_leaves AS BIGINT) AS n_leaves, CAST(saved AS BIGINT) AS saved_tokens, ends_sha256
FROM e JOIN s USING (node, d) LEFT JOIN n USING (node, d)
"""
