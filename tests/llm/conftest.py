import os
import random
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def corpus(seed=7, n=60):
    """Small documents with copies, near copies, repeated line runs, a hot
    passage, empty, null and long texts: [(doc_id, text)]."""
    r = random.Random(seed)
    words = ["".join(r.choice("abcdefghij") for _ in range(r.randint(2, 7))) for _ in range(200)]

    def line():
        return " ".join(r.choice(words) for _ in range(r.randint(3, 14)))

    hot = "\n".join(line() for _ in range(4))
    rows = []
    for i in range(n):
        kind = i % 12
        if kind == 0:
            t = None
        elif kind == 1:
            t = ""
        elif kind in (2, 3) and rows:
            t = r.choice(rows)[1]
        elif kind == 4:
            old = next((x[1] for x in reversed(rows) if x[1] and len(x[1]) > 200), line()).split(" ")
            old[len(old) // 2] = "changed"
            t = " ".join(old)
        elif kind in (5, 6, 7):
            t = "\n".join([line() for _ in range(r.randint(0, 3))] + [hot] + [line() for _ in range(r.randint(0, 3))])
        elif kind == 8:
            t = " \t\n ".join(line() for _ in range(3))
        else:
            t = "\n".join(line() for _ in range(r.randint(1, 9)))
        rows.append((i, t))
    rows.append((n, "x" * 3000))
    rows.append((n + 1, "\n".join([line()] * 40)))
    rows.append((n + 2, " ".join(words * 60)))
    rows.append((n + 3, "aaaa\n" * 300 + hot))
    return rows


@pytest.fixture(scope="session")
def rows():
    return corpus()


@pytest.fixture(scope="session")
def docs(spark, rows):
    return spark.createDataFrame([(i, t, ("en", "de", "fr", None)[i % 4], "s", None) for i, t in rows], SCHEMA).repartition(5)


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def odd(spark):
    """Null ids, repeated rows, one id with two texts, and extra columns with names an operator might use."""
    schema = SCHEMA + ", pos int, rank int, h1 int, th int, runs int, f int, fp int, _key int, _own int, _piit int, _score int, label int, grp int, s int, e int, n int"
    extra = (1,) * 16
    base = [(None, "lost one", "en", "s", 1), (None, None, None, None, None), (1, "same same same text", "en", "s", 1),
            (1, "same same same text", "en", "s", 1), (1, "other text\nb\nc\nd", None, None, None), (2, "same  same same\ttext", "fr", "s", 1),
            (3, "mail a@b.com or +1 (555) 555-5555\nb\nc\nd", "de", "s", 2)]
    return spark.createDataFrame([r + extra for r in base], schema)
