"""Quality rules on documents and on the hosts they come from."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from telemill.llm.words import SPACES, kept, word_array

WINDOW = 5
#: Share of failing documents, after shrinking, above which a host is rejected.
HOST_LIMIT = 0.5
#: Bounds on the prior's weight in documents, for hosts that are all alike or all different.
PRIOR_WEIGHT = (1.0, 1000.0)
#: Less than this share of a document to compare within hosts counts as none.
ROOM = 1e-6
RULES = ("base_failed", "symbols_failed", "lines_failed")


def signals(docs: DataFrame) -> DataFrame:
    """Counts of each row: ``n_words, word_chars, n_symbols, n_lines, n_dup_lines, n_repeat_words``.

    ``n_lines`` counts lines with a word. Null texts count as empty, all counts are then 0. Windows
    are compared by 64-bit hashes within one text; only texts in which a hash repeats are sorted.
    """
    text = F.coalesce("text", F.lit(""))
    rows = docs.select(
        "doc_id",
        "source",
        word_array(F.col("text")).alias("words"),
        F.regexp_count(text, F.lit(r"[#*$%&|<>]")).cast("long").alias("n_symbols"),
        F.filter(F.split(text, "\n"), lambda x: F.btrim(x, F.lit(SPACES)) != "").alias("lines"),
    )
    rows = rows.select(
        "doc_id",
        "source",
        "n_symbols",
        F.size("words").cast("long").alias("n_words"),
        F.aggregate("words", F.lit(0).cast("long"), lambda a, w: a + F.char_length(w)).alias("word_chars"),
        F.size("lines").cast("long").alias("n_lines"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        F.transform("words", lambda w: F.xxhash64(w)).alias("hashes"),
    )
    window = lambda i: F.xxhash64(*[F.get("hashes", i + k) for k in range(WINDOW)])
    windows = F.transform(F.sequence(F.lit(0), F.size("hashes") - WINDOW), window)
    rows = rows.withColumn("windows", F.when(F.size("hashes") >= WINDOW, windows)).drop("hashes")
    repeated = F.size(F.array_distinct("windows")) < F.size("windows")
    ordered = F.sort_array(F.transform("windows", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    rows = rows.withColumn("ordered", F.when(repeated, ordered)).drop("windows")

    def twin(x: Column, j: Column) -> Column:
        near = [F.get("ordered", j + d)["h"] == x["h"] for d in (-1, 1)]
        return F.when(F.coalesce(near[0], F.lit(False)) | F.coalesce(near[1], F.lit(False)), x["i"])

    rows = rows.withColumn("starts", F.sort_array(F.array_compact(F.transform("ordered", twin)))).drop("ordered")
    step = lambda p, k: F.least(F.lit(WINDOW), F.coalesce(F.get("starts", k + 1) - p, F.lit(WINDOW)))
    covered = F.aggregate(F.transform("starts", step), F.lit(0).cast("long"), lambda a, n: a + n)
    return rows.withColumn("n_repeat_words", F.coalesce(covered, F.lit(0).cast("long"))).drop("starts")


def base_failed() -> Column:
    return (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))


def host_verdicts(judged: DataFrame, host: str, limit: float = HOST_LIMIT) -> DataFrame:
    """``host, host_docs, host_failures, host_failed``: one row per host, null being a host too.

    For each rule a beta prior is fitted to the hosts' failures: its mean is the failing share of all
    documents, its weight follows from how much more the hosts differ than chance alone would make
    hosts of their sizes differ (the moments of the beta-binomial, each host weighing as many documents
    as it has). A host is rejected if the posterior mean of any rule exceeds ``limit``. Small hosts thus
    lean on what is usual; where hosts have one document each, nothing tells them apart and the prior
    has its largest weight. An empty table gives no host.
    """
    failures = [F.count_if(r).alias(r) for r in RULES]
    hosts = judged.groupBy(F.col(host).alias("host")).agg(F.count("*").alias("host_docs"), *failures)
    docs, squares = F.col("host_docs").cast("double"), F.col("host_docs").cast("double") ** 2
    sums = [F.sum(docs).alias("of_docs"), F.sum(squares).alias("of_squares"), F.count("*").alias("of_hosts")]
    for r in RULES:
        sums += [F.sum(F.col(r)).cast("double").alias(f"of_{r}"), F.sum(F.col(r).cast("double") ** 2 / docs).alias(f"spread_{r}")]
    scored = hosts.join(F.broadcast(hosts.agg(*sums)), how="cross")  # one row

    def shrunk(rule: str) -> Column:
        mean = F.col(f"of_{rule}") / F.col("of_docs")
        free = F.col("of_hosts") - 1
        spread = F.col(f"spread_{rule}") - F.col(f"of_{rule}") ** 2 / F.col("of_docs")
        room = F.col("of_docs") - F.col("of_squares") / F.col("of_docs") - free
        # correlation of two documents of one host: 0 if the hosts are alike, 1 if each is all good or all bad
        alike = F.try_divide(F.try_divide(spread, mean * (1 - mean)) - free, F.when(room > ROOM, room))
        weight = F.when(alike > 0, F.greatest(F.lit(PRIOR_WEIGHT[0]), F.least(F.lit(PRIOR_WEIGHT[1]), 1 / alike - 1)))
        weight = F.coalesce(weight, F.lit(PRIOR_WEIGHT[1]))
        return (F.col(rule) + mean * weight) / (F.col("host_docs") + weight)

    failed = F.greatest(*[shrunk(r) for r in RULES]) > limit
    return scored.select("host", "host_docs", F.col("base_failed").alias("host_failures"), failed.alias("host_failed"))


def host_rules(docs: DataFrame, limit: float = HOST_LIMIT) -> DataFrame:
    """Counts, ``base_failed``, the host's figures and ``kept`` of each row of ``docs``.

    A row is kept if it passes the base rule and its host (``source``) is not rejected. Repeated
    rows are judged each on its own; an empty table gives an empty result.
    """
    rows = signals(docs)
    judged = kept(
        rows.select(
            "*",
            base_failed().alias("base_failed"),
            (F.col("n_symbols") > F.col("n_words")).alias("symbols_failed"),
            (100 * F.col("n_dup_lines") > 30 * F.col("n_lines")).alias("lines_failed"),
        ),
        "signals",
    )
    hosts = host_verdicts(judged, "source", limit)
    joined = judged.join(hosts, judged["source"].eqNullSafe(hosts["host"]), "left")
    return joined.select(
        "doc_id",
        *["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"],
        (~F.col("base_failed") & ~F.col("host_failed")).alias("kept"),
        *["host_docs", "host_failures", "host_failed"],
    )


SQL = r"""
WITH t AS (
  SELECT doc_id, source, coalesce(text, '') AS t,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w
  FROM documents),
l AS (SELECT doc_id, unnest(string_split(t, chr(10))) AS line FROM t),
d AS (
  SELECT doc_id, count(*) AS n_lines, count(*) - count(DISTINCT line) AS n_dup_lines
  FROM l WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY doc_id),
g AS (SELECT doc_id, unnest(range(1, len(w) - 3)) AS i, w FROM t WHERE len(w) >= 5),
c AS (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, w[i:i + 4]) AS n FROM g),
r AS (
  SELECT doc_id, least(5, coalesce(lead(i) OVER (PARTITION BY doc_id ORDER BY i) - i, 5)) AS n
  FROM c WHERE n > 1),
k AS (SELECT doc_id, sum(n) AS n_repeat_words FROM r GROUP BY doc_id),
s AS (
  SELECT doc_id, source, CAST(len(w) AS BIGINT) AS n_words,
         CAST(length(array_to_string(w, '')) AS BIGINT) AS word_chars,
         CAST(length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
         CAST(coalesce(n_lines, 0) AS BIGINT) AS n_lines,
         CAST(coalesce(n_dup_lines, 0) AS BIGINT) AS n_dup_lines,
         CAST(coalesce(n_repeat_words, 0) AS BIGINT) AS n_repeat_words
  FROM t LEFT JOIN d USING (doc_id) LEFT JOIN k USING (doc_id)),
j AS (
  SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed,
         n_symbols > n_words AS symbols_failed, 100 * n_dup_lines > 30 * n_lines AS lines_failed FROM s),
h AS (
  SELECT source, count(*) AS host_docs, count(*) FILTER (base_failed) AS host_failures,
         count(*) FILTER (symbols_failed) AS f2, count(*) FILTER (lines_failed) AS f3 FROM j GROUP BY source),
p AS (
  SELECT sum(host_docs)::DOUBLE AS n, sum(host_docs::DOUBLE * host_docs) AS n2, count(*) - 1 AS free,
         sum(host_failures)::DOUBLE AS s1, sum(host_failures::DOUBLE * host_failures / host_docs) AS g1,
         sum(f2)::DOUBLE AS s2, sum(f2::DOUBLE * f2 / host_docs) AS g2,
         sum(f3)::DOUBLE AS s3, sum(f3::DOUBLE * f3 / host_docs) AS g3 FROM h),
o AS (
  SELECT s1 / n AS m1, s2 / n AS m2, s3 / n AS m3, CASE WHEN n - n2 / n - free > 1e-6 THEN n - n2 / n - free END AS room,
         (g1 - s1 * s1 / n) / nullif(s1 / n * (1 - s1 / n), 0) - free AS r1,
         (g2 - s2 * s2 / n) / nullif(s2 / n * (1 - s2 / n), 0) - free AS r2,
         (g3 - s3 * s3 / n) / nullif(s3 / n * (1 - s3 / n), 0) - free AS r3 FROM p),
q AS (
  SELECT m1, m2, m3,
         coalesce(CASE WHEN r1 / room > 0 THEN greatest(1, least(1000, room / r1 - 1)) END, 1000) AS w1,
         coalesce(CASE WHEN r2 / room > 0 THEN greatest(1, least(1000, room / r2 - 1)) END, 1000) AS w2,
         coalesce(CASE WHEN r3 / room > 0 THEN greatest(1, least(1000, room / r3 - 1)) END, 1000) AS w3 FROM o),
v AS (
  SELECT source, host_docs, host_failures,
         greatest((host_failures + m1 * w1) / (host_docs + w1), (f2 + m2 * w2) / (host_docs + w2),
                  (f3 + m3 * w3) / (host_docs + w3)) > 0.5 AS host_failed
  FROM h CROSS JOIN q)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND NOT host_failed AS kept, host_docs, host_failures, host_failed
FROM j JOIN v ON j.source IS NOT DISTINCT FROM v.source
"""
