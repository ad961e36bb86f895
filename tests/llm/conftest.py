import os
import random

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session", autouse=True)
def workers_find_the_package(spark):
    spark.sparkContext.environment["PYTHONPATH"] = ROOT


#: Columns with names that the operators use themselves.
CLASHING = ("id", "row", "key", "band", "label", "score", "spans", "n", "first", "lines", "_doc", "component", "items", "rule")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(f"`{c}` string" for c in CLASHING)


@pytest.fixture(scope="session")
def make_docs(spark):
    """A documents table of (doc_id, text[, source]) rows, with clashing columns."""
    def make(rows):
        full = [(r[0], r[1], None, r[2] if len(r) > 2 else "s", len(r[1] or ""), *[None] * len(CLASHING)) for r in rows]
        return spark.createDataFrame(full, SCHEMA)
    return make


def prose(seed, words, vocabulary=400):
    r = random.Random(seed)
    names = ["".join(r.choice("abcdefghij") for _ in range(r.randint(3, 8))) for _ in range(5)]
    return " ".join(f"w{r.randrange(vocabulary)}{names[r.randrange(5)][:3]}" for _ in range(words))


#: Nulls, empty, blank, odd and very long texts, and repeated rows.
ODD = [(None, None), (None, "some words without an id here"), (1, None), (2, ""), (3, " \t\r\n"), (4, "one"), (5, "naïve Çédille 漢字 😀 text\u0085x"),
       (6, "x" * 120_000), (7, ("lorem ipsum dolor " * 9_000) + "end"), (8, prose(1, 300)), (8, prose(1, 300)), (9, prose(1, 300)),
       (10, "\n".join(prose(i, 12) for i in range(40)))]
