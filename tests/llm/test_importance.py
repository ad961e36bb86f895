"""Importance resampling against plain Python, and CRC-32 against zlib."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from cdrflow.llm import importance, tokens
from cdrflow.llm.crc import DEPTH, crc32
from cdrflow.llm.ranks import ranked

from .conftest import ODD, prose

COLUMNS = ["doc_id", "n_features", "weight", "score", "rank"]


def runs(text, least, most):
    w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return w, [" ".join(w[i: i + k]) for k in range(least, most + 1) for i in range(len(w) - k + 1)]


def expected(rows, target, percent=10, min_words=20, least=1, most=1, buckets=10_000, seed=2024):
    def bucket(f):
        return zlib.crc32(f.encode()) % buckets
    s = Counter(bucket(f) for _, t in rows for f in runs(t, least, most)[1])
    t_ = Counter(bucket(f) for t in target for f in runs(t, least, most)[1])
    big_s, big_t = sum(s.values()), sum(t_.values())
    out = []
    for i, text in rows:
        words, fs = runs(text, least, most)
        gain = [math.floor(1000 * math.log((t_[bucket(f)] + 1) * (big_s + buckets) / ((s[bucket(f)] + 1) * (big_t + buckets)))) for f in fs]
        weight = sum(gain) // len(gain) if gain else 0
        h = int(hashlib.sha256(f"{seed}:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        out.append([i, len(fs), weight, score, None, len(words) >= min_words])
    order = sorted((r for r in out if r[5]), key=lambda r: (-r[3], r[0] is None, r[0] or 0))
    for place, r in enumerate(order[: percent * len(order) // 100], 1):
        r[4] = place
    return sorted((tuple(r[:5]) for r in out), key=str)


def found(df):
    assert df.columns == COLUMNS
    return sorted((tuple(r) for r in df.collect()), key=str)


@pytest.fixture(scope="module")
def rows():
    return [(i, prose(i, 5 + 7 * (i % 30), vocabulary=90)) for i in range(300)] + [
        (i, prose(3, 60)) for i in range(400, 440)] + [(i, f"Ünï {i} " + "Q-q " * i) for i in range(500, 530)] + [(x, y) for x, y in ODD if x not in (8, 9)]


@pytest.mark.parametrize("options", [{}, {"percent": 37, "min_words": 0}, {"least": 1, "most": 3, "buckets": 97}, {"least": 2, "most": 2, "seed": 5}, {"percent": 100}, {"percent": 0}])
def test_resampled(spark, make_docs, rows, options):
    target = [prose(3, 60), None, "", "one Q q"]
    items = spark.createDataFrame([(i, t, "clash") for i, t in enumerate(target)], "item_id long, text string, score string")
    assert found(importance.resampled(make_docs(rows), items, **options)) == expected(rows, target, **options)


def test_empty_target_and_empty_documents(spark, make_docs):
    none = spark.createDataFrame([], "item_id long, text string")
    rows = [(i, prose(i, 40)) for i in range(30)]
    assert found(importance.resampled(make_docs(rows), none)) == expected(rows, [])
    assert importance.resampled(make_docs([]), none).collect() == []


def test_rows_that_repeat_an_id_are_drawn_each(spark, make_docs):
    rows = [(1, prose(1, 40))] * 200 + [(i, prose(i, 40)) for i in range(2, 50)] + [(None, prose(2, 30))] * 60
    none = spark.createDataFrame([], "text string")
    assert found(importance.resampled(make_docs(rows), none, percent=60)) == expected(rows, [], percent=60)


@settings(max_examples=60, deadline=None)
@given(st.binary(max_size=5 * DEPTH + 3), st.lists(st.tuples(st.integers(0, 6 * DEPTH), st.integers(0, 6 * DEPTH)), max_size=12))
def test_crc_of_any_spans(data, spans):
    cut = [(min(a, b, len(data)), min(max(a, b), len(data))) for a, b in spans]
    got = crc32(np.frombuffer(data, np.uint8), np.array([a for a, _ in cut], np.int64), np.array([b for _, b in cut], np.int64))
    assert got.tolist() == [zlib.crc32(data[a:b]) for a, b in cut]


def test_crc_at_block_ends():
    data = np.frombuffer(random.Random(1).randbytes(20 * DEPTH), np.uint8)
    sizes = [0, 1, DEPTH - 1, DEPTH, DEPTH + 1, 2 * DEPTH, 2 * DEPTH + 1, 20 * DEPTH]
    got = crc32(data, np.zeros(len(sizes), np.int64), np.array(sizes))
    assert got.tolist() == [zlib.crc32(data[:n].tobytes()) for n in sizes]


def test_spaced_runs_are_spans():
    texts = ["Ab,, cd  é-f", "", "x", "--", "a b"]
    data = "".join(texts).encode()
    w = tokens.words_of(np.frombuffer(data, np.uint8), np.cumsum([0, *(len(t.encode()) for t in texts)]), tokens.ALNUM)
    data, starts, ends = importance.spaced(w)
    assert data.tobytes().decode() == "ab cd é f x a b " and [data[a:b].tobytes().decode() for a, b in zip(starts, ends)] == "ab cd é f x a b".split()


def test_ranked_is_a_dense_order(spark, tmp_dir):
    r = random.Random(2)
    rows = [(r.choice([1, 1, 1, r.randrange(50)]), i) for i in range(5000)]
    spark.createDataFrame(rows, "a long, b long").write.parquet(f"{tmp_dir}/in")
    df = spark.read.parquet(f"{tmp_dir}/in")
    got = ranked(df, [df.a.desc(), df.b], "test").collect()
    assert [(x["a"], x["b"]) for x in sorted(got, key=lambda x: x["at"])] == sorted(rows, key=lambda x: (-x[0], x[1]))
    assert sorted(x["at"] for x in got) == list(range(5000))
    assert ranked(df.filter("a < 0"), [df.a], "test").collect() == []
