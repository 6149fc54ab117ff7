"""Tables with the edge cases that the operators have to bear."""

import random

import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def odd_texts(spark):
    """Documents: null and repeated ids, equal rows, null, empty, very long and copied texts, clashing columns."""
    rng = random.Random(9)
    base = ["".join(rng.choice("abcdefghijkl") for _ in range(rng.randint(1, 8))) for _ in range(300)]
    text = lambda n: " ".join(rng.choice(base) for _ in range(n))
    rows = [(i * 3 - 60, text(rng.randint(1, 120))) for i in range(80)]
    rows += [(300, rows[3][1]), (301, rows[3][1]), (301, rows[3][1]), (301, rows[3][1]), (301, text(9))]
    rows += [(302, None), (303, ""), (304, ""), (305, " \n"), (306, "One"), (307, "näïve ÄÖ \U0001f600 z"), (308, text(5_000))]
    rows += [(None, text(50)), (None, text(20)), (None, None), (None, None), (None, rows[4][1]), (-(2**63), text(10)), (2**63 - 1, text(10))]
    frame = spark.createDataFrame([(a, b, "en", "s", len(b or "")) for a, b in rows], SCHEMA)
    for name in ("part", "rank", "print", "guest", "copies", "without", "positions", "first", "row"):
        frame = frame.withColumn(name, frame["n_chars"])
    return frame.repartition(5)


@pytest.fixture(scope="session")
def no_texts(spark):
    return spark.createDataFrame([], SCHEMA)
