"""The filter audit against trying every order on every document."""

import itertools
import random
import re

import numpy as np
import pytest

from cdrflow.llm import audit

LETTERS = "ABCDE"
LABELS = "doc_id long, quality int, toxic int, text string, part string"


def expected(rows, labels):
    """{(part, order, step): counts} by removing documents one filter at a time."""
    good = {i for i, q, _ in labels if q == 1 and i is not None}
    toxic = {i for i, _, t in labels if t == 1 and i is not None}
    least = {}
    for i, t, _ in rows:
        if i is not None:
            least[t or ""] = min(i, least.get(t or "", i))
    docs = []
    for i, t, source in rows:
        t = t or ""
        w = re.findall(r"[^\x20\x09-\x0D]+", t)
        fails = {x for x, bad in zip(LETTERS, (
            len(w) < 200, 100 * len(set(w)) < 50 * len(w), 100 * sum("A" <= c <= "Z" for c in t) > 2 * len(t),
            any(c in "#$%&*|" for c in t), i is not None and i > least[t])) if bad}
        docs.append((i, source or "", fails))
    out = {}
    for part in {p for _, p, _ in docs}:
        mine = [(i, f) for i, p, f in docs if p == part]
        shapley = dict.fromkeys(LETTERS, 0)
        for order in map("".join, itertools.permutations(LETTERS)):
            left = list(mine)
            for step, x in enumerate(order, 1):
                gone = [d for d in left if x in d[1]]
                left = [d for d in left if x not in d[1]]
                shapley[x] += len(gone)
                out[part, order, step] = [
                    len(left), len(gone), sum(x in f for _, f in mine) - len(gone), sum(f == {x} for _, f in mine),
                    sum(i in good for i, _ in gone), sum(i in toxic for i, _ in gone)]
        for (p, order, step), row in out.items():
            if p == part:
                row.append(shapley[order[step - 1]])
    return out


def found(df):
    return {(r["part"], r["filter_order"], r["step"]): [r[c] for c in audit.REPORT] for r in df.collect()}


@pytest.fixture(scope="module")
def rows():
    r = random.Random(7)
    out = []
    for i in range(160):
        n = r.choice([0, 3, 199, 200, 260])
        words = [r.choice(["alpha", "Beta", "GAMMA", "delta#", "x|y", f"w{r.randrange(300)}", f"v{r.randrange(9999)}"]) for _ in range(n)]
        if r.random() < 0.5:
            words = [f"u{r.randrange(100_000)}" for _ in range(n)]
        out.append((i, " ".join(words), r.choice(["web", "news", "", None])))
    out += [(200 + i, r.choice(out)[1], "web") for i in range(60)]                      # copies
    out += [(3, out[3][1], "web"), (3, "another text", "news"), (3, out[3][1], "web")]  # repeated ids
    out += [(None, out[5][1], None), (None, None, "web"), (7777, None, "web"), (7778, "", "news"), (7779, "é" * 100_000, "web")]
    return out


def test_audit_equals_every_order_tried(spark, make_docs, rows):
    labels = [(r[0], i % 3 and 1, 1 if i % 4 == 0 else 0) for i, r in enumerate(rows) if i % 2] + [(1, 0, 0), (1, 1, 1), (None, 1, 1), (5, None, None)]
    table = spark.createDataFrame([(*x, "clash", "clash") for x in labels], LABELS)
    got = found(audit.audit(audit.masked(make_docs(rows), table)))
    assert got == expected(rows, labels)
    assert len(got) == 3 * 600  # null and empty sources are one part


def test_audit_of_nothing_and_without_labels(spark, make_docs):
    none = spark.createDataFrame([], LABELS)
    assert audit.audit(audit.masked(make_docs([]), none)).collect() == []
    rows = [(1, "just one", None)]
    assert found(audit.audit(audit.masked(make_docs(rows), none))) == expected(rows, [])


def test_one_text_and_one_id_hold_most_rows(spark, make_docs):
    rows = [(i, "the same words in all", f"s{i % 3}") for i in range(300)] + [(5, "other", "s0")] * 300 + [(None, "", "s1")] * 200
    got = found(audit.audit(audit.masked(make_docs(rows), spark.createDataFrame([(5, 1, 1, "", "")], LABELS))))
    assert got == expected(rows, [(5, 1, 1)])


@pytest.mark.parametrize("n", [1, 2, 5])
def test_intervals_cover_each_order_once(n):
    """For every mask the intervals of all steps are the ranks of all orders, each at the step of its first failing filter."""
    orders = list(itertools.permutations(range(n)))
    for mask in range(1, 1 << n):
        step_of = np.full(len(orders), -1)
        for step, at, to in audit.intervals(mask, n):
            assert (step_of[at:to] == -1).all() and 0 <= at < to <= len(orders)
            step_of[at:to] = step
        assert step_of.tolist() == [next(i for i, f in enumerate(o) if mask >> f & 1) for o in orders]
    assert list(audit.intervals(0, n)) == []
