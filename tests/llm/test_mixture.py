"""The mix: targets against plain water-filling, totals near them, expected copies."""

import itertools
import random
from collections import defaultdict

import pytest

from cdrflow.llm import mixture

from .conftest import ODD


def targets(sizes, weights=(3, 1, 2), percent=150, most=2):
    """Targets by raising the level until all words are shared."""
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + ([None] if None in sizes else [])
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    total, done = sum(sizes.values()) * percent / 100, {}
    while True:
        left = [s for s in names if s not in done]
        share = (total - sum(done.values())) / sum(weight[s] for s in left) if left else 0
        over = [s for s in left if weight[s] * share >= most * sizes[s]]
        if not over:
            return {**done, **{s: weight[s] * share for s in left}}
        done.update({s: most * sizes[s] for s in over})


def words(n, i=0):
    return " ".join(f"w{i}" for _ in range(n))


def totals(got):
    out = defaultdict(int)
    for r in got:
        out[r["source"]] += r["copies"] * r["size"]
    return out


@pytest.fixture(scope="module")
def rows():
    r = random.Random(4)
    out = [(i, words(r.choice([1, 2, 5, 40, 41, 300]), i), r.choice(["a", "b", "é", "z", "~", None, "", "big", "big", "big"])) for i in range(900)]
    out += [(9000 + i, words(3), "tiny") for i in range(2)] + [(9100, None, "none"), (9101, "", "none"), (9102, words(20_000), "long"), (9103, words(7), "long")]
    return out + [(i, t, "odd") for i, t in ODD]


def test_targets_and_totals(spark, make_docs, rows):
    got = mixture.mixed(make_docs(rows)).collect()
    sizes = defaultdict(int)
    for _, t, s in rows:
        sizes[s] += len((t or "").split())
    # Other blanks than the six are parts of words.
    sizes["odd"] = sum(r["size"] for r in got if r["source"] == "odd")
    want = targets(sizes)
    assert len(got) == len(rows)
    largest = defaultdict(int)
    for r in got:
        assert r["source_size"] == sizes[r["source"]] and r["target"] == pytest.approx(want[r["source"]], rel=1e-9)
        assert 0 <= r["copies"] <= 2
        largest[r["source"]] = max(largest[r["source"]], r["size"])
    taken = totals(got)
    for s in sizes:  # the landing settles two documents at most
        assert abs(taken[s] - want[s]) <= largest[s] / 2 + 1e-6, s
    assert abs(taken["big"] - want["big"]) <= 3 and abs(taken["a"] - want["a"]) <= 3  # one exchange closes the gap
    assert sum(want.values()) == pytest.approx(1.5 * sum(sizes.values()))


def test_many_rounds_over_small_blocks(spark, make_docs, rows):
    docs = make_docs(rows)
    once = mixture.mixed(docs, block=16, fan=3).collect()
    want = {r["source"]: r["target"] for r in once}
    taken = totals(once)
    assert abs(taken["big"] - want["big"]) <= 150  # half the largest document: so few meet in the last round
    key = lambda r: str((r["doc_id"], r["source"], r["size"], r["copies"]))
    again = mixture.mixed(docs.repartition(7), block=16, fan=3).collect()
    assert sorted(map(key, once)) == sorted(map(key, again))
    assert len(once) == len(rows)


def test_repeated_rows_and_one_hot_source(spark, make_docs):
    rows = [(1, words(10), "hot")] * 400 + [(i, words(10 + i % 3), "x") for i in range(50)]
    got = mixture.mixed(make_docs(rows), block=32, fan=4).collect()
    assert len(got) == 450
    for s, t in {r["source"]: r["target"] for r in got}.items():
        assert abs(totals(got)[s] - t) <= 6


def test_empty_table_and_empty_texts(spark, make_docs):
    assert mixture.mixed(make_docs([])).collect() == []
    got = mixture.mixed(make_docs([(1, None, None), (2, "", "a"), (None, " ", "a")])).collect()
    assert {(r["doc_id"], r["size"], r["target"], r["copies"]) for r in got} == {(1, 0, 0.0, 0), (2, 0, 0.0, 0), (None, 0, 0.0, 0)}


def test_flight_keeps_totals_and_expected_values():
    sizes, p0 = [9, 5, 5, 5, 4, 2, 1, 1], 0.3
    n, chosen = 4000, [0.0] * 8
    for seed in range(n):
        p = [p0] * 8
        open_ = mixture.flight(p, sizes, random.Random(seed))
        assert len(open_) <= 2 and all(x in (0, 1) for i, x in enumerate(p) if i not in open_)
        assert sum(p) == pytest.approx(2.4) and sum(x * s for x, s in zip(p, sizes)) == pytest.approx(0.3 * 32)
        chosen = [c + x / n for c, x in zip(chosen, p)]
    assert chosen == pytest.approx([p0] * 8, abs=0.04)


def test_landing_takes_the_nearest_corner():
    def landed(p, size, open_):
        words = sum(x * n for x, n in zip(p, size))
        mixture.land(p, size, open_, words)
        return p
    assert landed([0.5, 0.5], [10, 3], [0, 1]) in ([0.0, 1.0], [1.0, 0.0])
    assert landed([1.0, 0.9, 0.2], [5, 4, 3], [1, 2]) == [1.0, 1.0, 0.0]
    assert landed([0.5, 0.0, 1.0, 0.0], [100, 50, 7, 1], [0]) == [0.0, 1.0, 1.0, 0.0]  # one is put in
    assert landed([0.5, 1.0, 0.0, 0.0], [100, 30, 80, 7], [0]) == [0.0, 0.0, 1.0, 0.0]  # and one taken out
    assert landed([], [], []) == [] and landed([0.0, 0.0], [5, 6], []) == [0.0, 0.0]
    r = random.Random(9)
    for _ in range(200):  # against all corners with at most one exchange
        n = r.randrange(1, 9)
        size, p = [r.randrange(12) for _ in range(n)], [float(r.randrange(2)) for _ in range(n)]
        open_ = sorted(r.sample(range(n), min(n, r.randrange(3))))
        for i in open_:
            p[i] = r.random()
        words, best = sum(x * s for x, s in zip(p, size)), []
        for x in itertools.product((0, 1), repeat=n):
            changed = [i for i in range(n) if i not in open_ and x[i] != p[i]]
            if sum(x[i] for i in changed) <= 1 and sum(1 - x[i] for i in changed) <= 1:
                best.append(abs(words - sum(a * b for a, b in zip(x, size))))
        p = landed(p, size, open_)
        assert abs(words - sum(a * b for a, b in zip(p, size))) == pytest.approx(min(best), abs=1e-5)
