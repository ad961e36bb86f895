"""Operators against brute force, round trips and held-out labels."""

import hashlib
import itertools
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from cdrflow.llm import bpe, decontaminate, line_dedup, lm, near_dup, quality, rules, secrets, stages, tokens, toxicity, urls
from cdrflow.llm.components import components
from cdrflow.llm.labelled import training_texts

from .conftest import prose

SF = "/root/testdata/sf0.001"


def closure(nodes, links):
    up = {n: n for n in nodes}

    def top(x):
        while up[x] != x:
            x = up[x]
        return x
    for a, b in links:
        a, b = top(a), top(b)
        up[max(a, b)] = min(a, b)
    return {n: top(n) for n in nodes}


def edits(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a):
        new = [i + 1]
        for j, y in enumerate(b):
            new.append(min(row[j] + (x != y), row[j + 1] + 1, new[-1] + 1))
        row = new
    return row[-1]


def mutated(r, text, n, alphabet="abc"):
    out = list(text)
    for _ in range(n):
        i, kind = r.randrange(len(out) + 1), r.randrange(3)
        if kind == 0:
            out.insert(i, r.choice(alphabet))
        elif i < len(out):
            out[i: i + 1] = [r.choice(alphabet)] if kind == 1 else []
    return "".join(out)


def test_components(spark):
    r = random.Random(3)
    links = [(r.randrange(300), r.randrange(300)) for _ in range(220)] + [(i, i + 1) for i in range(400, 460)] + [(700, x) for x in range(600, 650)]
    got = {x["node"]: x["component"] for x in components(spark.createDataFrame(links + links[:50], "a long, b long")).collect()}
    nodes = {x for a, b in links if a != b for x in (a, b)}
    assert got == closure(nodes, [x for x in links if x[0] != x[1]])


def test_words_and_hashes():
    texts = ["Ab  c\nd", "", "d C", "  x", "é É a1-b"]
    data = "".join(texts).encode()
    offsets = np.cumsum([0, *(len(t.encode()) for t in texts)])
    w = tokens.words_of(np.frombuffer(data, np.uint8), offsets, tokens.BLANK_SPLIT)
    assert [[w.word(i).decode() for i in range(w.offsets[d], w.offsets[d + 1])] for d in range(5)] == [
        ["ab", "c", "d"], [], ["d", "c"], ["x"], ["é", "É", "a1-b"]]
    h = w.hashes()
    assert h[2] == h[3] and h[1] == h[4] and len(set(h.tolist())) == 7
    assert list(tokens.cut(np.array([0, 5, 5, 30, 31]), 6)) == [(0, 2), (2, 3), (3, 4)]


@pytest.mark.parametrize("windows", [15, 500_000])  # several blocks, and one
def test_decontamination(spark, make_docs, monkeypatch, windows):
    r = random.Random(5)
    items = [(i, " ".join(f"t{r.randrange(40)}" for _ in range(n))) for i, n in enumerate([30, 12, 10, 9, 3, 1, 15])] + [(7, ""), (8, None)]
    docs = []
    for d in range(60):
        words = [f"T{r.randrange(40)}" for _ in range(r.randrange(40))]
        source = items[r.randrange(7)][1].split()
        at = r.randrange(len(source))
        docs.append((d, ", ".join(words[:10]) + " -- " + "\n".join(source[at: at + r.randrange(30)]) + "! " + " ".join(words[10:])))
    docs += [(None, docs[3][1]), (3, docs[5][1]), (60, None), (61, "")]  # rows without an id, with another's, without words
    monkeypatch.setattr(decontaminate, "BLOCK_WINDOWS", windows)
    table = spark.createDataFrame(items, "item_id long, text string")
    got = Counter((x["doc_id"], x["n_words"], x["n_hit"], x["n_items"], x["items_sha256"])
                  for x in decontaminate.digest(decontaminate.contamination(make_docs(docs), table)).collect())
    expected = Counter()
    cut = lambda t: re.findall(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (t or "").encode().lower())
    wins = defaultdict(set)
    for i, t in items:
        w = cut(t)
        for s in range(max(1, len(w) - 9) if w else 0):
            wins[tuple(w[s: s + 10])].add(str(i))
    for d, t in docs:
        w, hit, found = cut(t), set(), set()
        for win, ids in wins.items():
            for s in range(len(w) - len(win) + 1):
                if tuple(w[s: s + len(win)]) == win:
                    hit |= set(range(s, s + len(win)))
                    found |= ids
        expected[d, len(w), len(hit), len(found), hashlib.sha256(",".join(sorted(found)).encode()).hexdigest()] += 1
    assert got == expected


def test_decontamination_by_containment(spark, make_docs):
    item = " ".join(f"u{i}" for i in range(10))
    near = " ".join(f"u{i}" if i != 9 else "other" for i in range(10))
    far = " ".join(f"u{i}" if i % 3 else "other" for i in range(10))
    table = spark.createDataFrame([(1, item)], "item_id long, text string")
    got = {x["doc_id"]: x["items"] for x in decontaminate.contamination(make_docs([(1, near), (2, far), (3, "a " + item)]), table, containment=0.8).collect()}
    assert got == {1: ["1"], 2: [], 3: ["1"]}


def test_distance():
    r = random.Random(1)
    for _ in range(4000):
        a = "".join(r.choice("abc") for _ in range(r.randrange(14)))
        b = mutated(r, a, r.randrange(5))
        for k in range(4):
            assert line_dedup.within(a, b, k) == (edits(a, b) <= k)


@pytest.mark.parametrize("hot", [1, 32])
def test_line_classes(spark, make_docs, monkeypatch, hot):
    """Also with keys taken for hot from two lines on, so that all rounds run."""
    monkeypatch.setattr(line_dedup, "HOT", hot)
    r = random.Random(8)
    stems = ["".join(r.choice("abcdé ") for _ in range(r.randrange(22, 40))) for _ in range(12)]
    docs = []
    for d in range(40):
        lines = [mutated(r, r.choice(stems), r.randrange(4)) for _ in range(r.randrange(6))] + ["short"]
        docs.append((d, "\n".join(lines) + ("\r\n\r\n" if d % 3 else "")))
    got = {x["doc_id"]: x for x in line_dedup.report(make_docs(docs)).collect()}
    places = defaultdict(list)
    for d, t in docs:
        for i, x in enumerate(x for x in re.split(r"[\r\n]+", t) if x):
            places[x].append((d, i))
    long = [x for x in places if len(x) >= line_dedup.MIN_CHARS]  # shorter ones are classed where equal
    of = closure(places, [(a, b) for a, b in itertools.combinations(long, 2) if edits(a, b) <= 2])
    first = {}
    for x, p in places.items():
        first[of[x]] = min([first.get(of[x], (99, 0)), *p])
    later = defaultdict(list)
    for x, p in places.items():
        for place in p:
            if place != first[of[x]]:
                later[place[0]].append(place[1])
    for d, _ in docs:
        assert got[d]["repeated_lines"] == ",".join(map(str, sorted(later[d])))


def test_without_repeats(spark, make_docs):
    a, b, c = (prose(i, 14) for i in (21, 22, 23))
    d = "\n".join([c, prose(25, 14), prose(26, 14)])
    rows = [(1, f"{a}\nshort\n{b}"), (2, f"{c}\n{a[:-1]}\n\nend"), (3, f"{a}\r\n{b}"), (4, c + "\n" + prose(24, 30)), (5, a + "\n" + a[:-1]),
            (6, a), (7, d), (8, d + "\n" + prose(27, 10))]
    got = {x["doc_id"]: x for x in line_dedup.without_repeats(make_docs(rows)).collect()}
    assert got[1]["text"] == rows[0][1] and 6 not in got  # nothing of 6 is its own
    assert 3 not in got and 5 not in got  # nor of these
    assert got[7]["text"] == "\n" + "\n".join(d.split("\n")[1:])
    assert got[8]["text"] == "\n" + prose(27, 10) and got[8]["n_chars"] == len(got[8]["text"])
    assert got[2]["text"] == f"{c}\n\nend" and got[2]["n_chars"] == len(got[2]["text"])
    assert got[4]["text"] == "\n" + prose(24, 30)


def _by_hand(rows, model):
    """score per doc_id from n-gram counts in dictionaries, under the model's weights."""
    held = {d: zlib.crc32(str(d).encode()) % 10 == 0 for d, _ in rows}
    seq = {d: ["<s>", "<s>", *(t or "").encode().lower().split(), "</s>"] for d, t in rows}
    count = Counter()
    for d, x in seq.items():
        if not held[d]:
            count.update(tuple(x[i - n + 1: i + 1]) for i in range(2, len(x)) for n in (1, 2, 3))
    texts = sum(not h for h in held.values())

    def bounds(c):
        q = int(lm._level(np.array([c]))[0])
        return int(lm.VALUE[q]), int(lm.VALUE[q + 1]) - 1

    out = {}
    for d, x in seq.items():
        total = 0.0
        for i in range(2, len(x)):
            u, v, w = x[i - 2: i + 1]
            p = (count[(w,)] + 0.1) / (model.total + 0.1 * (model.vocabulary + 1))
            first = texts if v == "<s>" else count[(v,)]
            second = texts if v == "<s>" else bounds(count[(u, v)])[1] if count[(u, v)] else 0
            for n, (history, c) in enumerate(((first, count[(v, w)]), (second, count[(u, v, w)])), 1):
                a = model.weights[n][lm._level(np.array([history]))[0]]
                p = a * (min(bounds(c)[0], history) / history if history else 0) + (1 - a) * p
            total += np.log10(p)
        out[d] = total
    return out


@pytest.mark.parametrize("chunk, shard", [(lm.CHUNK_BYTES, lm.SHARD_BYTES), (700, 500)])
def test_language_model(spark, make_docs, monkeypatch, chunk, shard):
    """Base scores against a count by hand, and scores against n-gram counts by hand, in few chunks and shards and in many."""
    monkeypatch.setattr(lm, "CHUNK_BYTES", chunk)
    monkeypatch.setattr(lm, "SHARD_BYTES", shard)
    rows = [(d, prose(d % 30, 40 + d, 60)) for d in range(120)] + [(200, None), (201, ""), (202, "Unseen WORDS here")]
    docs = make_docs(rows)
    got = {x["doc_id"]: x for x in lm.scores(docs).collect()}
    count = Counter()
    held = {d: zlib.crc32(str(d).encode()) % 10 == 0 for d, _ in rows}
    for d, t in rows:
        if not held[d]:
            count.update([*(t or "").encode().lower().split(), None])
    n, v = sum(count.values()), len(count)
    for d, t in rows:
        words = [*(t or "").encode().lower().split(), None]
        x = got[d]
        assert (x["held_out"], x["n_tokens"], x["n_known"], x["train_tokens"]) == (held[d], len(words), sum(count[w] > 0 for w in words), n)
        assert x["base_score"] == pytest.approx(sum(np.log10((count[w] + 0.1) / (n + 0.1 * (v + 1))) for w in words))
        assert x["score"] < 0
    out = [x for d, x in got.items() if held[d] and d < 200]
    assert sum(x["score"] for x in out) > sum(x["base_score"] for x in out)  # copies are foreseen
    learnt = docs.selectExpr("doc_id", "coalesce(text, '') text", "pmod(crc32(cast(cast(doc_id as string) as binary)), 10) <> 0 train")
    model, _, _ = lm.fit(learnt)
    assert (model.total, model.vocabulary) == (n, v) and model.weights.max() > 0.1
    assert {d: x["score"] for d, x in got.items()} == pytest.approx(_by_hand(rows, model))


def _weights_by_hand(texts):
    """Interpolation weights by level when each text is foreseen from n-gram counts of all other texts."""
    seq = [["<s>", "<s>", *t.split(), "</s>"] for t in texts]
    grams = [Counter(tuple(x[i - n + 1: i + 1]) for i in range(2, len(x)) for n in (1, 2, 3)) for x in seq]
    count = sum(grams, Counter())
    level = lambda c: int(lm._level(np.array([c]))[0])
    places = []
    for x, own in zip(seq, grams, strict=True):
        others = {g: count[g] - n if len(g) == 1 else level(max(lm.VALUE[level(count[g])] - n, 0)) for g, n in own.items()}
        total = sum(n for g, n in count.items() if len(g) == 1) - len(x) + 2
        known = sum(len(g) == 1 and n > own[g] for g, n in count.items())
        for u, v, w in zip(x, x[1:], x[2:]):
            first = len(texts) - 1 if v == "<s>" else others[(v,)]
            second = len(texts) - 1 if v == "<s>" else lm.VALUE[others[u, v] + 1] - 1 if first and others[u, v] else 0
            pair = others[v, w] if others[(w,)] else 0
            both = others[u, v, w] if pair else 0
            shares = [min(lm.VALUE[q], h) / h if h else 0 for q, h in ((pair, first), (both, second))]
            places.append(((others[(w,)] + 0.1) / (total + 0.1 * (known + 1)), [level(first), level(second)], shares))
    p, out = np.array([x[0] for x in places]), []
    for n in range(2):
        q, s = (np.array([x[i][n] for x in places]) for i in (1, 2))
        w = np.full(lm.TOP + 1, 0.5)
        for _ in range(30):
            w[0] = 0
            part = np.bincount(q, w[q] * s / (w[q] * s + (1 - w[q]) * p), lm.TOP + 1)
            w = np.clip((part + 0.1) / (np.bincount(q, minlength=lm.TOP + 1) + 1), 0, 0.98)
        w[0] = 0
        p = w[q] * s + (1 - w[q]) * p
        out.append((w, np.unique(q)))
    return out


@pytest.mark.parametrize("chunk, shard", [(lm.CHUNK_BYTES, lm.SHARD_BYTES), (700, 500)])
def test_weights_come_from_all_training_texts(spark, make_docs, monkeypatch, chunk, shard):
    """Every training text, whatever its id, is foreseen from all the others; in few chunks and in many."""
    monkeypatch.setattr(lm, "CHUNK_BYTES", chunk)
    monkeypatch.setattr(lm, "SHARD_BYTES", shard)
    r = random.Random(3)
    texts = [" ".join(r.choice([" the cat", "the dog sat", "on a mat", f"w{r.randrange(60)}", f"x{d % 7} y{r.randrange(3)}"]) for _ in range(r.randint(0, 40)))
             for d in range(60)]
    texts += ["again again again " * 30, texts[5], texts[6], "only here"]
    model, _, _ = lm.fit(make_docs([*enumerate(texts), (99, "held out " * 50)]).selectExpr("doc_id", "text", "doc_id < 99 train"))
    for n, (wanted, found) in enumerate(_weights_by_hand(texts), 1):
        assert len(found) > 5 and np.ptp(wanted[found]) > 0.3
        assert model.weights[n][found] == pytest.approx(wanted[found], abs=0.01)


def test_own_occurrences():
    """Counts of each place's item within its text only."""
    r = random.Random(5)
    at, text = np.array([r.randrange(12) for _ in range(300)]), np.sort([r.randrange(20) for _ in range(300)])
    times = Counter(zip(at, text, strict=True))
    assert lm._within(at, text).tolist() == [times[x] for x in zip(at, text, strict=True)]


def _hashed(texts):
    data = [t.encode() for t in texts]
    return lm._sequence(tokens.words_of(np.frombuffer(b"".join(data), np.uint8), np.cumsum([0, *map(len, data)]), tokens.BLANK_SPLIT))


def test_levels():
    """Levels rise with the counts, and a level's counts are within an eighth of each other."""
    n = np.concatenate([np.arange(0, 5_000), 2 ** np.arange(3, 34), 2 ** np.arange(3, 34) - 1])
    q = lm._level(n)
    assert (lm.VALUE[q] <= n).all() and (n < lm.VALUE[q + 1]).all() and q.max() < lm.TOP
    assert ((lm.VALUE[q + 1] - 1) * 8 <= np.maximum(lm.VALUE[q] * 9, 8)).all()


def test_filter_counts():
    """Every n-gram reads back at the level of its count, others at none."""
    x, offsets = _hashed([prose(d % 10, 2_000, 3_000) for d in range(40)])
    for grams in lm._grams(x, offsets):
        keys, n = np.unique(grams, return_counts=True)
        other = np.setdiff1d(keys ^ np.uint64(0x5555), keys)
        back = lm._read_back(np.concatenate([keys, other]), np.concatenate([n, 0 * other.astype(int)]))
        assert (back[: len(keys)] == lm._level(n)).all() and (back[len(keys):] > 0).mean() < 1e-4


def test_probabilities_sum_to_one_at_most():
    """Over the vocabulary and one unseen word, after any two words; nearly to one where counts are exact."""
    texts = [prose(d, 150, 300) for d in range(60)]
    x, offsets = _hashed(texts)
    words, count = np.unique(x, return_counts=True)
    grams = np.concatenate(lm._grams(x, offsets)[1:])
    weights = np.full((lm.ORDER, lm.TOP + 1), 0.7)
    weights[:, 0] = 0
    model = lm.Model(len(x), len(words), len(texts), weights)
    next_ = np.append(words, np.uint64(12345))
    for at in [0, 1, 2, 77, 500, 1_234, 4_000]:
        if x[at] == lm.END or x[at + 1] == lm.END:
            continue
        three = np.stack([np.full(len(next_), x[at]), np.full(len(next_), x[at + 1]), next_], 1).ravel()
        bounds = np.arange(len(next_) + 1) * 3
        wanted = lm._grams(three, bounds)[1:]
        keys, back = np.unique(np.concatenate([grams, *wanted]), return_inverse=True)
        levels = lm._read_back(keys, np.bincount(back[: len(grams)], minlength=len(keys)))[back[len(grams):]].reshape(2, -1)
        i = np.minimum(np.searchsorted(words, three), len(words) - 1)
        p = 10 ** model.log10(np.where(words[i] == three, count[i], 0), levels, bounds)[2::3]
        assert 0.9 < p.sum() <= 1.0001


def test_quantiles_of_all_scores(spark, monkeypatch):
    """The k-th smallest of all values, also among ties, through several rounds of cells."""
    monkeypatch.setattr(urls, "GRID", 16)
    r = random.Random(9)
    values = [r.gauss(0, 1) for _ in range(900)] + [0.25] * 300 + [r.random() * 1e-9 for _ in range(300)]
    df = spark.createDataFrame([(v,) for v in values], "difference double")
    for k in (0, 15, 700, 1_000, len(values) - 1):
        assert urls.kth(df, k) == sorted(values)[k]


def test_url_rules_and_models(spark):
    r = random.Random(4)
    good = [f"https://{r.choice(['news', 'blog', 'lib'])}{r.randrange(90)}.org/read/{r.randrange(999)}" for _ in range(400)]
    bad = [f"http://win-{r.randrange(90)}.com/de/casino{r.randrange(999)}" for _ in range(400)]
    new = [("https://news7.net/read/55", "allow"), ("http://win-5.com/casino77", "block")]
    rows = list(enumerate([*good, *bad, *(u for u, _ in new)]))
    out = sorted(urls.judged(spark.createDataFrame(rows, "page_id long, url string")).collect(), key=lambda x: x["page_id"])
    got = [x["verdict"] for x in out]
    assert got[:400] == ["allow"] * 400 and got[400:800] == ["block"] * 400 and got[800] == "allow"
    assert out[800]["difference"] > 0.2 > -0.2 > out[801]["difference"]


def url_counts(examples):
    """Per (order, context) the bytes that follow it. Where fewer bytes than the order
    stand before, the context is the beginning."""
    seen = defaultdict(Counter)
    for url in examples:
        text = url.lower().encode()
        for i, byte in enumerate(text):
            for order in range(urls.ORDER + 1):
                seen[order, text[i - order: i] if i >= order else None][byte] += 1
    return seen


def url_difference(models, url):
    """Mean log-likelihood difference by the mixture of all orders, lowest first."""
    text, total = url.lower().encode(), 0.0
    for i, byte in enumerate(text):
        p = []
        for seen in models:
            q = 1 / 256
            for order in range(urls.ORDER + 1):
                follow = seen.get((order, text[i - order: i] if i >= order else None))
                if follow:
                    q = (follow[byte] + len(follow) * q) / (sum(follow.values()) + len(follow))
            p.append(q)
        total += np.log(p[1]) - np.log(p[0])
    return total / max(len(text), 1)


def test_url_models_equal_exact_counts(spark):
    """Differences, and the threshold, as from counts by hand of all contexts."""
    r = random.Random(12)
    rows = [(k, f"http://{r.choice(['aa', 'bQ', 'cé'])}.{'org' if k else 'com'}/{r.randrange(40)}") for k in (True, False) for _ in range(90)]
    df = spark.createDataFrame([*rows, (True, ""), (False, None)], "accepted boolean, url string")
    held = {x["url"] for x in df.filter(F.pmod(F.xxhash64(F.coalesce("url", F.lit(""))), F.lit(urls.HOLD)) == 0).select(F.coalesce("url", F.lit("")).alias("url")).collect()}
    models = [url_counts(u for a, u in rows if a == kind and u not in held) for kind in (False, True)]
    model = urls.fit(df)
    tried = sorted({u for _, u in rows})[:60] + ["", "http://new.net/7"]
    column = pa.array(tried)
    got = np.concatenate([model.difference(text, bounds) for _, _, text, bounds in urls._url_bytes(column)])
    assert np.allclose(got, [url_difference(models, u) for u in tried], atol=1e-5)
    scores = [sorted(url_difference(models, u) for a, u in [*rows, (True, ""), (False, "")] if a == kind and u in held) for kind in (True, False)]
    limits = [s[int(np.floor(share * (len(s) - 1)))] for s, share in zip(scores, (urls.LOSS, 1 - urls.LOSS))]
    assert abs(model.threshold - min(limits)) < 1e-5


def test_training_texts_of_repeated_ids(spark):
    """The smallest text of an id, on every run; a null one only where there is no other."""
    docs = spark.createDataFrame([(1, "b"), (1, "a"), (1, None), (2, None), (None, "x"), (4, "y")], "doc_id long, text string").repartition(5)
    labels = spark.createDataFrame([(1, 0), (1, 1), (2, 0), (None, 1), (4, 7)], "doc_id long, quality int")
    out = training_texts(docs, labels, "quality", 1, 9, 10, "t").collect()
    assert sorted((x["doc_id"], x["label"], x["text"]) for x in out) == [(1, 1, "a"), (2, 0, None)]


def test_cascade_order_does_not_change_verdicts(spark, make_docs):
    rows = [(1, prose(1, 60)), (2, "few words"), (3, "SHOUTING " * 20), (4, "a# b$ c% " * 10), (5, "one line of five words\n" * 9), (6, "x" * 400 + " y" * 10)]
    docs = make_docs(rows)
    found = rules.estimate(docs, rules.default_rules())
    assert {e.rule.name for e in found if e.rejected > 0} >= {"few_words", "capitals", "symbols"}
    assert all(e.seconds >= rules.LEAST_COST for e in found)
    speed = [e.rejected / e.seconds for e in found]
    assert speed == sorted(speed, reverse=True)
    verdicts = [{x["doc_id"]: x["f"] is None for x in docs.select("doc_id", rules.cascade(order).alias("f")).collect()} for order in (found, found[::-1])]
    assert verdicts[0] == verdicts[1] == {1: True, **{i: False for i in range(2, 7)}}


def test_ownership_tells_examples_from_live_secrets(spark, make_docs):
    shared, own = "token = 'abcdefghijklmnop'", "Secret: zyxwvutsrqpo0987"
    rows = [(d, f"é {shared} é", f"source{d % 4}") for d in range(8)] + [(20, own, "source0"), (21, own, "source0"), (22, "password: token: abcdefghijkl AKIA" + "B" * 16, None)]
    got = {x["doc_id"]: x for x in secrets.digest(secrets.secrets(make_docs(rows))).collect()}
    assert [got[3][c] for c in ("n_assign", "n_example", "n_live", "spans")] == [1, 1, 0, "assign:2:27"]
    assert (got[20]["n_example"], got[20]["n_live"]) == (0, 1)
    assert (got[22]["n_assign"], got[22]["n_access"], got[22]["spans"]) == (0, 1, "access:30:50")


def test_bpe_equals_the_library():
    from tokenizers import Tokenizer
    path = bpe.tokenizer_path()
    library, mine = Tokenizer.from_file(path), bpe.Encoder(bpe.Vocabulary(path))
    r = random.Random(6)
    pieces = [b.decode("utf-8", "ignore") for b in list(mine.v.id_of)[::7]]
    texts = ["".join(r.choice("abcdetinoß漢😀 \n\t019'#-́") for _ in range(r.randrange(50))) for _ in range(1500)]
    texts += ["".join(r.choice(pieces) for _ in range(r.randrange(6))) for _ in range(3000)]
    texts += ["a" * 150, " " * 60, "x<|endoftext|> y<|endoftext|><|endoftext|>", ""]
    ids = [[int(i) for i in x.split(",")] if x else [] for x in mine.encode_all(texts)]
    want = [x.ids for x in library.encode_batch(texts, add_special_tokens=False)]
    assert ids == want
    assert [mine.decode(x) for x in ids] == [library.decode(x, skip_special_tokens=False) for x in want] == texts


def test_bpe_cache_stays_bounded(monkeypatch):
    monkeypatch.setattr(bpe, "CACHE_PIECES", 50)
    e = bpe.Encoder(bpe.Vocabulary(bpe.tokenizer_path()))
    texts = [prose(i, 60) for i in range(6)]
    whole = [e.encode_all([t])[0] for t in texts]
    assert e.encode_all(texts) == whole and len(e.cache) <= 50 + sum(len(set(t.split())) for t in texts)


def test_bpe_automaton_gives_the_tokens_that_end_a_prefix(monkeypatch):
    """One step a byte, against every end of the prefix looked up; with kept steps and without room for them."""
    r = random.Random(9)
    v = bpe.Vocabulary(bpe.tokenizer_path())
    spelled = list(v.id_of)
    words = [b"".join(r.choice(spelled) for _ in range(r.randrange(1, 5))) for _ in range(300)]
    words += [bytes(r.randrange(256) for _ in range(20)) for _ in range(100)] + [b" " * 300]
    for room in (bpe.KEPT_STEPS, 10):
        monkeypatch.setattr(bpe, "KEPT_STEPS", room)
        e = bpe.Encoder(v)
        for word in words:
            lasts, nodes = [], []
            e._last_tokens(word, lasts, nodes)
            assert len(lasts) == len(nodes) == len(word)
            for end, node in enumerate(nodes, 1):
                token, ends = node[bpe.LONGEST], []
                while token is not None:
                    ends.append(token)
                    token = e.shorter[token]
                every = [v.id_of.get(word[at:end]) for at in range(max(0, end - v.longest), end)]
                assert ends == [t for t in every if t is not None and e._whole(t)]
        assert e.kept_steps <= room


def test_bpe_levels_equal_the_depth_first_walk(monkeypatch):
    """Pieces walked level by level against the same pieces one by one, with few places for pairs too."""
    r = random.Random(10)
    v = bpe.Vocabulary(bpe.tokenizer_path())
    words = {"".join(r.choice("abcdetino ß漢😀́\n019'#-") for _ in range(r.randrange(1, 34))) for _ in range(3000)}
    words |= {prefix + tail for prefix in ("inter", " inter", "é" * 15, "a" * 31) for tail in ("", "a", "ab", "national", "é")}
    monkeypatch.setattr(bpe, "SHORT_BYTES", 0)
    one_by_one = bpe.Encoder(v)
    monkeypatch.setattr(one_by_one, "_learn_short", lambda some: pytest.fail("no piece is short"))
    one_by_one.learn(list(words))
    monkeypatch.undo()
    for slots, block in ((bpe.PAIR_SLOTS, bpe.BLOCK_PIECES), (8, 100)):
        monkeypatch.setattr(bpe, "PAIR_SLOTS", slots)
        monkeypatch.setattr(bpe, "BLOCK_PIECES", block)
        e = bpe.Encoder(v)
        for some in (sorted(words)[::2], sorted(words)[1::2], []):
            e.learn(some)
        assert e.cache == one_by_one.cache and e.spelled == one_by_one.spelled
        assert all(e.spelled[w] == w.encode() for w in words)


def test_bpe_pieces_in_use_outlast_new_ones(monkeypatch):
    """A piece of every other slice is encoded once, however many others pass by."""
    monkeypatch.setattr(bpe, "CACHE_PIECES", 40)
    e, learned = bpe.Encoder(bpe.Vocabulary(bpe.tokenizer_path())), []
    learn = e.learn
    monkeypatch.setattr(e, "learn", lambda words: (learned.extend(words), learn(words)))
    want = e.encode_all(["steady"])
    for i in range(60):
        e.encode_all([" ".join(f"x{i}y{j}" for j in range(2))])
        assert i % 2 or e.encode_all(["steady"]) == want
        assert len(e.cache) <= 40 and len(e.older[0]) <= 40 and e.cache.keys() == e.spelled.keys()
    assert learned.count("steady") == 1


@pytest.mark.parametrize("k", [4, 5])
def test_near_duplicates(spark, make_docs, k):
    r = random.Random(k)
    rows, texts = [], {}
    for d in range(160):
        base = r.randrange(12)
        words = prose(base, 60).split()
        for _ in range(r.choice([0, 0, 1, 2, 3, 6])):
            words[r.randrange(len(words))] = f"new{r.randrange(30)}"
        texts[d] = " ".join(words[: len(words) - r.choice([0, 0, 2, 8])]).upper() if d % 2 else " ".join(words)
        rows.append((d, texts[d]))
    rows += [(500, "two words"), (501, "Two  WORDS"), (502, "")]
    got = {x["doc_id"]: x for x in near_dup.near_duplicates(make_docs(rows), k=k).collect()}
    sets = {}
    for d, t in rows:
        w = t.lower().split()
        sets[d] = {tuple(w[i: i + k]) for i in range(max(1, len(w) - k + 1))} if w else set()
    links = [(a, b) for a, b in itertools.combinations(sets, 2)
             if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])]
    want = closure(sets, links)
    assert {d: (x["component_id"], x["n_shingles"], x["kept"]) for d, x in got.items()} == {d: (want[d], len(sets[d]), want[d] == d) for d in sets}


def test_one_id_with_two_texts(spark, make_docs):
    a, b = prose(1, 80), prose(2, 80)
    got = near_dup.near_duplicates(make_docs([(1, a), (2, b), (3, a), (3, b + " end")])).collect()
    assert sorted((x["doc_id"], x["component_id"]) for x in got) == [(1, 1), (2, 1), (3, 1), (3, 1)]


def test_chain_marginals():
    """Forward-backward against the sum over all label sequences."""
    r = np.random.default_rng(2)
    u, move = r.normal(size=9), r.normal(size=(2, 2))
    starts, sizes = np.array([0, 4, 5]), np.array([4, 1, 4])
    got = toxicity._marginals(u, starts, sizes, move)
    for s, n in zip(starts, sizes):
        total, each = 0.0, np.zeros(n)
        for y in itertools.product((0, 1), repeat=int(n)):
            p = np.exp(sum(u[s + i] * y[i] for i in range(n)) + sum(move[y[i], y[i + 1]] for i in range(n - 1)))
            total += p
            each += p * np.array(y)
        assert np.allclose(got[s: s + n], each / total)


def test_toxic_spans(spark, make_docs):
    r = random.Random(9)
    rows, labels = [], []
    for d in range(400):
        words = prose(d, 40).split()
        bad = d % 4 == 0
        if bad:
            for x in ("Vile", "nasty,"):
                words[r.randrange(40)] = x
        rows.append((d, " ".join(words)))
        labels.append((d, int(bad)))
    docs = make_docs([*rows, (900, "é vile"), (901, "é fine")])
    model = toxicity.fit(docs, spark.createDataFrame(labels, "doc_id long, toxic int"))
    got = {x["doc_id"]: x for x in toxicity.toxicity(docs, model).collect()}
    assert all((got[d]["score"] >= 0.5) == bool(y) for d, y in labels)
    assert [(s["start"], s["end"]) for s in got[900]["spans"]] == [(2, 6)] and not got[901]["spans"]


def test_trees():
    """Flat traversal equals walking each tree; a rule is learnt."""
    r = np.random.default_rng(3)
    x = r.normal(size=(1500, 4))
    y = ((x[:, 1] > 0.3) ^ (x[:, 2] > 0)).astype(float)
    model = quality.grow(x, y)
    new = r.normal(size=(300, 4))
    assert ((model.score(new) >= 0.5) == ((new[:, 1] > 0.3) ^ (new[:, 2] > 0))).mean() > 0.93
    total = np.full(300, model.base)
    for i in range(300):
        for f, lim, v in zip(model.feature, model.limit, model.value):
            at = 0
            while at < len(f):
                at = 2 * at + (2 if new[i, f[at]] > lim[at] else 1)
            total[i] += v[at - len(f)]
    assert np.allclose(model.score(new), 1 / (1 + np.exp(-total)))


def test_statistics_of_a_text_do_not_depend_on_its_neighbours():
    texts = ["one two two\none two two", "", "A#b! " * 30, "é" * 50, prose(1, 80)]
    data = np.frombuffer("".join(texts).encode(), np.uint8)
    offsets = np.cumsum([0, *(len(t.encode()) for t in texts)])
    whole = quality.statistics(data, offsets)
    for i in range(5):
        assert np.allclose(whole[i], quality.statistics(data, offsets[i: i + 2])[0])


def test_held_out_labels(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.01/{t}.parquet") for t in ("documents", "labels"))
    q = quality.quality(docs, quality.fit(docs, labels)).join(labels, "doc_id").filter("pmod(crc32(cast(cast(doc_id as string) as binary)), 4) = 2")
    rows = q.select(F.col("score") >= 0.7, F.col("quality") == 1).collect()
    assert len(rows) > 50 and sum(a == b for a, b in rows) >= 0.93 * len(rows)
    t = toxicity.toxicity(docs, toxicity.fit(docs, labels)).join(labels, "doc_id").filter("pmod(crc32(cast(cast(doc_id as string) as binary)), 5) = 0")
    rows = t.select(F.col("score") >= 0.5, F.col("toxic") == 1).collect()
    assert len(rows) > 50 and sum(a and not b for a, b in rows) <= 0.02 * len(rows)  # labels also mark documents without a sign
    assert sum(a and b for a, b in rows) >= 0.4 * sum(b for _, b in rows)


def test_texts_that_change_between_passes_are_refused(spark, make_docs):
    """Answers that belong to other texts are an error, never a score."""
    import pyarrow as pa
    texts = pa.table({"text": ["one two three"]})
    none = pa.table({"shard": pa.array([0]), "grams": pa.array([b"\x01"], pa.binary()), "words": pa.array([b""], pa.binary())})
    with pytest.raises(RuntimeError, match="partitions"):
        lm._met(texts, none)


def test_unknown_words_have_no_weight():
    """A word that shares the top bits of a toxic word's hash is not that word."""
    data = " ".join(["vile", *(f"x{i}" for i in range(1_500_000))]).encode()
    h = tokens.words_of(np.frombuffer(data, np.uint8), np.array([0, len(data)]), tokens.ALNUM).hashes()
    near = np.flatnonzero(h[1:] >> np.uint64(46) == h[0] >> np.uint64(46))
    assert len(near)
    rows = [{"words": tokens.signed(np.array([h[i + 9], h[0] if i % 2 else h[i + 2000], h[i + 4000]])).tolist(), "tags": [0, i % 2, 0]} for i in range(600)]
    model = toxicity._fit_chain(rows)
    p = [toxicity._tag(model, tokens.words_of(np.frombuffer(t, np.uint8), np.array([0, len(t)]), tokens.ALNUM)).max()
         for t in (b"vile", *(b"x%d" % i for i in near))]
    assert p[0] > 0.5 > max(p[1:])


def test_all_toxic_lines_give_windows():
    text = "\n".join(f"a{i} vile b{i}" for i in range(9))
    vile = tokens.words_of(np.frombuffer(b"vile", np.uint8), np.array([0, 4]), tokens.ALNUM).hashes()
    batch = pa.RecordBatch.from_arrays([pa.array([1], pa.int32()), pa.array([text])], names=["label", "text"])
    shared = type("Shared", (), {"value": {int(vile[0])}})
    assert sum(x.column(2).to_pylist().count(True) for x in toxicity._windows(shared)(iter([batch]))) == 9


def test_latin_pieces_are_the_patterns_pieces():
    """The cut for Latin texts against the general one, on every character it is for."""
    r = random.Random(8)
    plain = [c for c in map(chr, [*range(0x0, 0x250), *range(0x200B, 0x2028), *range(0x2030, 0x205F)]) if not bpe.BEYOND_LATIN.search(c)]
    assert len(plain) > 600 and bpe.BEYOND_LATIN.search("漢") and bpe.BEYOND_LATIN.search(" ")
    general = bpe.regex.compile(bpe.PIECES)
    for c in plain:
        text = f"a{c}b {c}{c} 1{c} .{c}'s"
        assert bpe.LATIN_PIECES.findall(text) == general.findall(text), hex(ord(c))
    for _ in range(300):
        text = "".join(r.choice(plain + [" ", " ", "'", "s", "1", "\n"] * 60) for _ in range(120))
        assert bpe.LATIN_PIECES.findall(text) == general.findall(text)


def test_tokenised_replaces_columns_of_its_names(spark):
    docs = spark.createDataFrame([(1, "one two", 7, "x")], "doc_id long, text string, n_tokens long, ids_sha256 string")
    out = stages.tokenised(spark, docs, SF)
    assert sorted(out.columns) == ["decoded_sha256", "doc_id", "ids_sha256", "n_tokens", "text"] and out.first()["n_tokens"] < 7
