import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

WORDS = ("river stone mountain lamp quiet garden letter winter paper silver bridge candle forest meadow harbour "
         "window copper engine valley orchard thunder velvet marble summer lantern willow timber anchor falcon prairie").split()


def prose(seed: int, n: int) -> str:
    import random
    r = random.Random(seed)
    out = []
    while len(out) < n:
        sentence = [r.choice(WORDS) + r.choice(["", "", "s", "ly"]) for _ in range(r.randint(5, 12))]
        sentence[0] = sentence[0].capitalize()
        sentence[-1] += "."
        out += sentence
    return " ".join(out[:n])


@pytest.fixture(scope="session")
def edge_docs(spark):
    """Nulls, empty and very long texts, copies, near copies, repeated rows, and extra columns
    whose names the operators use themselves."""
    base = prose(1, 120)
    near = base.replace("river", "ocean", 1)
    rows = [(1, "", "a", "en"), (2, None, None, None), (3, "one", "a", "en"), (4, prose(2, 60_000), "b", "en"),
            (5, base, "b", "en"), (5, base, "b", "en"), (6, base, "b", "en"), (7, near, "b", "de"),
            (None, prose(3, 80), "b", "en"), (8, "x" * 5000, "a", "en"), (9, "ß É\u00a0é \u2003 漢字🙂\n\n\t", "a", None),
            (10, " \t\r\n", "a", "en"), (11, "\u2581 a  b\n", "a", "en"), (12, prose(4, 55) + "\n" + prose(4, 55), "c", "en")]
    extra = [(*r, k, "x", True, 1.0, [k]) for k, r in enumerate(rows)]
    return spark.createDataFrame(extra, "doc_id long, text string, source string, lang string, node long, host string, "
                                        "kept boolean, score double, `row` array<int>")


@pytest.fixture(scope="session")
def no_docs(edge_docs):
    return edge_docs.limit(0)
