"""Embeddings and archives against brute force, and their edge cases."""

import base64
import collections
import hashlib
import math
import struct

import numpy as np
import pytest

from telemill.llm import components as co, near_vectors, warc


def brute(rows, limit=0.95):
    """Links and components of (id, vector) rows."""
    good = []
    for _, v in rows:
        ok = v is not None and all(x is not None and math.isfinite(x) for x in v) and any(v or [])
        x = np.array(v, float) if ok else None
        good.append(x / np.linalg.norm(x) if ok else None)
    links, root = [0] * len(rows), list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, a in enumerate(good):
        for j in range(i):
            b = good[j]
            if a is not None and b is not None and len(a) == len(b) and a @ b >= limit:
                links[i] += 1
                links[j] += 1
                root[find(i)] = find(j)
    ids = collections.defaultdict(list)
    for i, (k, _) in enumerate(rows):
        ids[find(i)].append(k)
    low = {k: min((x for x in v if x is not None), default=None) for k, v in ids.items()}
    return [(rows[i][0], links[i], low[find(i)], rows[i][0] == low[find(i)]) for i in range(len(rows))]


@pytest.fixture(scope="module")
def vectors():
    rng = np.random.default_rng(4)
    rows = [(i, rng.normal(size=24)) for i in range(300)]
    centre = rng.normal(size=24)
    rows += [(400 + i, centre + 0.02 * rng.normal(size=24)) for i in range(250)]
    rows += [(700 + i, rows[i][1] + 0.02 * rng.normal(size=24)) for i in range(50)]
    rows += [(800, rows[5][1]), (801, rows[5][1] * 3), (801, rows[5][1]), (None, rows[6][1]), (None, rng.normal(size=24))]
    rows = [(k, [float(np.float32(x)) for x in v]) for k, v in rows]
    rows += [(810, None), (811, []), (812, [0.0] * 24), (813, [1.0, None]), (814, [float("nan")] * 24), (815, [float("inf"), 1.0])]
    return rows + [(820, [1.0, 2.0]), (821, [2.0, 4.0]), (822, [-1.0, -2.0])]


def test_near_duplicates_equal_brute_force(spark, vectors, monkeypatch):
    monkeypatch.setattr(near_vectors, "TILE", 64)  # so that the large group is cut into tiles
    frame = spark.createDataFrame(vectors, "vec_id long, embedding array<float>").selectExpr("*", "vec_id as row", "1 as links")
    got = near_vectors.near_duplicates(frame).collect()
    assert sorted(map(tuple, got), key=str) == sorted(brute(vectors), key=str)


def test_recall_at_the_limit_and_empty_table(spark):
    rng = np.random.default_rng(9)
    rows, want = [], 0
    for i in range(400):  # pairs just above the limit
        x = rng.normal(size=64)
        y = rng.normal(size=64)
        x /= np.linalg.norm(x)
        y -= (x @ y) * x
        y /= np.linalg.norm(y)
        rows += [(2 * i, x.tolist()), (2 * i + 1, (0.952 * x + math.sqrt(1 - 0.952**2) * y).tolist())]
        want += 2
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = near_vectors.near_duplicates(frame).agg({"n_links": "sum"}).first()[0]
    assert 0.95 * want <= got <= want
    assert near_vectors.near_duplicates(frame.filter("vec_id < 0")).count() == 0


def test_estimates_are_unbiased_and_bounded():
    rng = np.random.default_rng(2)
    x = rng.normal(size=(200, 32))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    bits, bands = 16, 24
    codes = near_vectors.band_values(x, bits, bands)
    finder = near_vectors.PairFinder(bits, bands, 0.5)
    a, b = np.triu_indices(200, 1)
    found = finder(x, codes, a, b)
    exact = np.einsum("ij,ij->i", x[a], x[b]) >= 0.5
    assert (found <= exact).all() and found.sum() >= 0.98 * exact.sum()


def test_components_of_paths_stars_and_hot_nodes(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, 100 + i) for i in range(1, 300)] + [(7, 7), (None, 3), (500, 501), (501, 500)]
    got = {r.node: r.component for r in co.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(41)}, **{100 + i: 100 for i in range(300)}, 500: 500, 501: 500}
    assert co.components(spark.createDataFrame([], "a long, b long")).count() == 0


PAGES = "page_id long, url string, html string"


def test_archives_round_trip(spark):
    rows = [(i, f"http://a/{i}", f"<p>{'text ' * (i % 40)}{i % 60}</p>") for i in range(500)]
    rows += [(600, None, None), (601, "http://x/ y\r\nz", ""), (602, "u", "ÄÖ\r\n\r\nWARC/1.1\r\n"), (603, "v", "z" * 3_000_000)]
    rows += [(603, "v", "z" * 3_000_000), (None, "w", "only"), (None, "w", rows[0][2])]
    frame = spark.createDataFrame(rows, PAGES).selectExpr("*", "page_id as row", "html as payload")
    got = warc.round_trip(spark, frame).collect()
    latest = {}
    for k, _, h in rows:
        h = h or ""
        latest[h] = max((x for x in (latest.get(h), k) if x is not None), default=None)
    want = []
    for k, _, h in rows:
        data, last = (h or "").encode(), latest[h or ""]
        digest = base64.b32encode(hashlib.sha1(data).digest()).decode()
        want.append((k, len(data), digest, "response" if k == last else "revisit", None if k == last else last))
    key = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]
    assert sorted((tuple(r[k] for k in key) for r in got), key=str) == sorted(want, key=str)
    assert all((r.payload is None) == (r.record_type == "revisit") for r in got)
    assert warc.round_trip(spark, frame.filter("page_id < 0")).count() == 0


def test_small_payloads_are_all_responses(spark, tmp_path):
    frame = spark.createDataFrame([(1, "a", "xy"), (2, "b", "xy"), (3, "c", "long one"), (4, "d", "long one")], PAGES)
    rows = warc.read_archives(warc.write_archives(frame, str(tmp_path), least_bytes=5)).collect()
    assert {r.page_id: r.record_type for r in rows} == {1: "response", 2: "response", 3: "revisit", 4: "response"}


def test_reader_rejects_broken_archives(tmp_path):
    record = warc.record_bytes(1, "u", None, b"payload", warc.digest_of(b"payload"))
    assert warc.parse_record(record)["payload"] == b"payload"
    for broken in (record[:-1], record.replace(b"payload\r", b"paylord\r"), record.replace(b"WARC/1.1", b"WORC/1.1"), b"", record.replace(b"WARC-Date", b"X-Date")):
        with pytest.raises(ValueError):
            warc.parse_record(broken)
    path = str(tmp_path / "a.warc.zst")
    varied = [warc.record_bytes(i, "u", None, f"payload {i * i} {i % 7}".encode() * 9, "X") for i in range(900)]
    warc.write_archive(path, iter(varied))
    data = open(path, "rb").read()
    assert struct.unpack("<I", data[:4])[0] == warc.DICTIONARY_MAGIC
    assert list(warc.read_archive(path)) == varied
    with open(path, "wb") as f:
        f.write(data[:-3])
    with pytest.raises(ValueError):
        list(warc.read_archive(path))


def foreign(kind, block, *more, name="<urn:uuid:1f9e7c1c-0000-4000-8000-000000000000>"):
    head = ["WARC/1.0", f"WARC-Type: {kind}", f"WARC-Record-ID: {name}", "WARC-Date: 2020-01-01T00:00:00Z", *more, f"Content-Length: {len(block)}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


HTTP = "Content-Type: application/http;msgtype=response"


def test_archives_of_others_can_be_read(spark, tmp_path):
    page = b"HTTP/1.1 200 OK\r\nX-Long: a\r\n b\r\n\r\nhello"
    digest = warc.digest_of(b"hello")
    records = [
        foreign("warcinfo", b"software: other\r\nformat: WARC 1.0\r\n", "Content-Type: application/warc-fields"),
        foreign("request", b"GET / HTTP/1.1\r\nHost: x\r\n\r\n", "Content-Type: application/http; msgtype=request"),
        foreign("response", page, HTTP, "WARC-Target-URI: http://x/", f"WARC-Payload-Digest: sha1:{digest}"),
        foreign("response", page, HTTP, "WARC-Payload-Digest: md5:abc"),
        foreign("response", page, HTTP),
        foreign("response", b"HTTP/1.1 200 OK\r\nTransfer-Encoding: chunked\r\nContent-Length: 3\r\n\r\n5\r\nhello\r\n0\r\n\r\n", HTTP),
        foreign("revisit", b"HTTP/1.1 200 OK\r\n\r\n", HTTP, "WARC-Refers-To: <urn:uuid:2>", f"WARC-Payload-Digest: sha1:{digest}"),
        foreign("metadata", b"a: 1", "Content-Type: application/warc-fields", "WARC-Concurrent-To: <a>", "WARC-Concurrent-To: <b>"),
        foreign("resource", b"", "Content-Type: text/plain"),
        warc.record_bytes(-5, "u", None, b"own", warc.digest_of(b"own")),
    ]
    path = str(tmp_path / "foreign.warc.zst")
    warc.write_archive(path, iter(records))
    rows = warc.read_archives(spark.createDataFrame([(path, 1, 1)], warc.ARCHIVES)).collect()
    assert [r.record_type for r in rows] == ["warcinfo", "request", *["response"] * 4, "revisit", "metadata", "resource", "response"]
    assert [r.page_id for r in rows] == [None] * 9 + [-5] and rows[0].record_id.startswith("<urn:uuid:1f9e")
    assert [bytes(r.payload) for r in rows[2:5]] == [b"hello"] * 3
    assert [r.payload_digest for r in rows[2:5]] == [digest, "md5:abc", digest]
    assert (rows[6].payload, rows[6].payload_bytes, rows[6].refers_to, rows[6].refers_to_id) == (None, None, None, "<urn:uuid:2>")
    assert (rows[8].payload_bytes, rows[7].payload_bytes, rows[2].target_uri) == (0, 4, "http://x/")


def test_every_broken_record_is_a_value_error(tmp_path):
    page = b"HTTP/1.1 200 OK\r\nContent-Length: 5\r\n\r\nhello"
    good = foreign("response", page, HTTP)
    assert warc.parse_record(good)["payload"] == b"hello"
    for broken in (
        good.replace(b"Content-Length: 43", b"Content-Length: x"),
        good.replace(b"Content-Length: 5", b"Content-Length: 4"),
        good.replace(b"Content-Length: 5", b"Content-Length: -"),
        good.replace(b"WARC-Record-ID", b"X-Id"),
        good.replace(b"WARC-Type: response", b"WARC-Type response"),
        foreign("response", b"no header", HTTP),
        foreign("response", page, HTTP, "WARC-Payload-Digest: sha1:AAAA"),
        foreign("response", b"HTTP/1.1 200 OK\r\nbroken\r\n\r\nhello", HTTP),
        b"\xff\xfe",
    ):
        with pytest.raises(ValueError):
            warc.parse_record(broken)
    path = str(tmp_path / "broken.warc.zst")
    with open(path, "wb") as f:
        f.write(b"no frame at all")
    with pytest.raises(ValueError):
        list(warc.read_archive(path))

