"""The prefix trie against a plain one."""

import hashlib
import random
import zlib

import duckdb
import pyarrow as pa
import pytest

from telemill.llm import prefix_trie as pt

SCHEMA = "conv_id long, turn long, role string, text string"


def plain(rows, graft=None):
    """Nodes of the trie, conversation by conversation."""
    own = {}
    for conv, turn, role, text in rows:
        if conv is not None:
            own.setdefault(conv, []).append((turn is not None, turn or 0, role or "", text or ""))
    own = {c: [t[2:] for t in sorted(v)] for c, v in own.items()}
    group, modulus = graft or (1, 1)
    built = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % modulus
        base = c - (c % group if c >= 0 else -(-c % group))
        built[c] = own.get(base, [])[:h] + turns[h:]
    root = {"members": list(built), "below": {}, "words": 0}
    for c in sorted(built):
        node = root
        for turn in built[c]:
            new = {"members": [], "below": {}, "words": len(turn[1].encode().split())}
            node = node["below"].setdefault(turn, new)
            node["members"].append(c)
    out, path = [], [(root, 0, None)]
    order = []
    while path:
        node, depth, parent = path.pop()
        order.append((node, depth, parent))
        path += [(n, depth + 1, node) for n in node["below"].values()]
    for node, depth, parent in reversed(order):
        below = node["below"].values()
        node["leaves"] = sum(n["leaves"] for n in below) or 1
        node["saved"] = sum(n["saved"] for n in below) + (len(node["members"]) - 1) * node["words"]
        ends = ",".join(str(c) for c in sorted(node["members"]) if len(built[c]) == depth)
        digest, up = hashlib.sha256(ends.encode()).hexdigest(), min(parent["members"]) if parent else None
        out.append((min(node["members"]), depth, up, len(node["members"]), len(below), node["leaves"], node["saved"], digest))
    return sorted(out, key=str)


def odd_rows():
    rng = random.Random(4)
    words = ["a", "b c", "d e f", "", "g h i j k"]
    rows = []
    for c in [*range(-45, -35), *range(0, 130), 10**12, 10**12 + 3, -(2**63), 2**63 - 1]:
        if c % 20 == 0 and c % 40 == 0:
            continue  # groups without a first conversation
        for turn in range(rng.randint(1, 6)):
            rows.append((c, turn * 2, rng.choice(["user", "assistant", None]), rng.choice(words) if turn else "start"))
    rows += [(7, None, "user", "first of all"), (8, 100, "user", "start"), (8, 100, "user", "start"), (9, 100, None, None)]
    rows += [(90, 1000 + i, "user", f"turn {i % 3}") for i in range(700)]  # a long conversation
    rows += [(200 + i, t, "user", "same words again" if t < 3 else "end") for i in range(60) for t in range(4)]
    rows += [(None, 1, "user", "lost"), (400, 0, None, None), (401, 0, "user", "Ä ü\x1cw"), (402, 1, "user", "x " * 20_000)]
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("graft", [None, (20, 4)])
def test_trie_equals_plain_trie(spark, graft, monkeypatch):
    monkeypatch.setattr(pt, "IDS_AT_ONCE", 7)
    monkeypatch.setattr(pt, "SPAN", 64)
    rows = odd_rows()
    frame = spark.createDataFrame(rows, SCHEMA).repartition(3)
    for name in ("part", "id", "at", "head", "length", "depth", "conv"):
        frame = frame.withColumn(name, frame["turn"])
    got = sorted(map(tuple, pt.prefix_trie(frame, graft).collect()), key=str)
    assert got == plain(rows, graft)


def test_equal_turns_have_one_order(spark):
    rows = [(1, 0, "user", "x"), (1, 0, "user", "y"), (2, 0, "user", "y"), (2, 0, "user", "x")]
    got = sorted(map(tuple, pt.prefix_trie(spark.createDataFrame(rows, SCHEMA)).collect()), key=str)
    assert got == plain([(c, 0, r, x) for c, _, r, x in rows])


def test_trie_of_nothing_and_of_one_turn(spark):
    assert pt.prefix_trie(spark.createDataFrame([], SCHEMA)).count() == 0
    assert pt.prefix_trie(spark.createDataFrame([(None, 1, "user", "x")], SCHEMA)).count() == 0
    one = spark.createDataFrame([(5, 1, "user", "x")], SCHEMA)
    assert sorted(map(tuple, pt.prefix_trie(one).collect()), key=str) == plain([(5, 1, "user", "x")])


def test_sql_equals_plain_trie():
    rows = [(c, t * 1000 + i, r, x) for i, (c, t, r, x) in enumerate(odd_rows()) if t is not None and c != -(2**63)]
    con = duckdb.connect()
    table = pa.table({"conv_id": [r[0] for r in rows], "turn": [r[1] for r in rows], "role": [r[2] for r in rows], "text": [r[3] for r in rows]})
    con.register("conversations", table)
    assert sorted(con.execute(pt.SQL).fetchall(), key=str) == plain(rows, pt.GRAFT)


def test_stretches_of_a_list_are_contracted():
    # two nodes of one part: 0 has child 5, which is elsewhere; 1 is a leaf after it
    table = pa.table({"id": [0, 1], "down": [10, 3], "out": pa.array([None, 1], pa.int64()), "n_children": [2, 0], "saving": [4, 0]})
    got = pt.contract(table).sort_by("arc").to_pylist()
    assert [(r["arc"], r["head"], r["behind"], r["tail"], r["follower"]) for r in got] == [
        (0, 0, 0, True, 10),
        (1, 2, 2, True, None),
        (2, 2, 0, False, None),
        (3, 2, 1, False, None),
    ]
    assert [(r["leaf"], r["saving"]) for r in got] == [(0, 4), (0, 0), (1, 0), (0, 0)]


def test_pointer_jumping_over_many_rounds(spark):
    n = 70
    rows = [(i * 7, (i + 1) * 7 if i + 1 < n else None, i % 4 + 1) for i in range(n)]
    got = dict(map(tuple, pt.distances(spark.createDataFrame(rows, "head long, follower long, left long")).collect()))
    assert got == {i * 7: sum(j % 4 + 1 for j in range(i, n)) for i in range(n)}
