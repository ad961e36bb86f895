"""Toxic spans by a linear-chain conditional random field.

Only documents are labelled, so token labels are derived first: words
whose documents are toxic far beyond chance, in enough different contexts,
are marked as toxic where they occur in a toxic document. A two-label chain (word, previous and next word;
transitions) is fitted on windows of those tokens. Forward-backward over
each line gives every token's marginal; a document's marginals give its
score through a small logistic fit, and the tokens over one half its spans.

Scale. Fitting reads a bounded sample (``TRAIN_DOCS``, ``TRAIN_WINDOWS``);
only word counts and windows of it reach the driver, and the broadcast model
holds the words of the windows, TRAIN_WINDOWS * WINDOW at most. Scoring is one pass over the texts without a shuffle.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import tokens
from .labelled import training_texts
from .store import stored

TRAIN_DOCS = 20_000
TRAIN_WINDOWS = 24_000      # half of them at most around toxic tokens
WINDOW = 24                 # tokens
CANDIDATES = 20_000         # words that may mark toxic documents
MIN_DOCS, MIN_PRECISION = 3, 0.9
CHANCE = 0.01               # expected number of words that mark by chance
EPOCHS, BATCH, RATE, DECAY = 12, 128, 1.0, 1e-4


@dataclass
class Chain:
    """Score differences between the toxic and the plain label."""

    words: np.ndarray      # sorted hashes of the words of the training windows
    word: np.ndarray       # by place in words: own, previous, next; one more column, unused
    bias: float
    move: np.ndarray       # move[i, j]: from label i to label j
    level: np.ndarray      # document score: weights of (1, peak, log expected count)

    @classmethod
    def blank(cls, words: np.ndarray | None = None) -> Chain:
        words = np.zeros(0, np.uint64) if words is None else words
        return cls(words, np.zeros((3, len(words) + 1)), -4.0, np.zeros((2, 2)), np.array([-3.0, 0.0, 0.0]))


def _slots(words: np.ndarray, h: np.ndarray, head: np.ndarray, tail: np.ndarray) -> np.ndarray:
    """(3, n) weight slots of each token: own, previous and next word; -1 beyond its line and for unknown words."""
    own = np.full(len(h), -1, np.int64)
    if len(words):
        at = np.minimum(np.searchsorted(words, h), len(words) - 1)
        own = np.where(words[at] == h, at, -1)
    out = np.full((3, len(h)), -1, np.int64)
    out[0] = own
    out[1, 1:] = own[:-1]
    out[1, head] = -1
    out[2, :-1] = own[1:]
    out[2, tail] = -1
    return out


def _potential(model: Chain, slots: np.ndarray) -> np.ndarray:
    u = np.full(slots.shape[1:], model.bias)
    for j in range(3):
        u += np.where(slots[j] >= 0, model.word[j][np.maximum(slots[j], 0)], 0.0)
    return u


def _marginals(u: np.ndarray, starts: np.ndarray, sizes: np.ndarray, move: np.ndarray) -> np.ndarray:
    """P(token is toxic) by forward-backward over the chains u[starts[i]:starts[i]+sizes[i]].

    Chains are handled side by side, longest first; the recursions run on the
    log odds of the forward and backward messages.
    """
    order = np.argsort(-sizes, kind="stable")
    starts, sizes = starts[order], sizes[order]
    longest = int(sizes[0]) if len(sizes) else 0
    active = np.searchsorted(-sizes, -np.arange(1, longest + 1), side="right")  # chains with over t tokens
    fore, back = np.empty_like(u), np.zeros_like(u)
    add = np.logaddexp
    if longest:
        fore[starts] = u[starts]
    for t in range(1, longest):
        at = starts[: active[t]] + t
        r = fore[at - 1]
        fore[at] = u[at] + add(move[0, 1], r + move[1, 1]) - add(move[0, 0], r + move[1, 0])
    for t in range(longest - 1, 0, -1):
        at = starts[: active[t]] + t
        r = u[at] + back[at]
        back[at - 1] = add(move[1, 0], r + move[1, 1]) - add(move[0, 0], r + move[0, 1])
    return 1 / (1 + np.exp(-np.clip(fore + back, -500, 500)))


def _lines(w: tokens.Words) -> tuple[np.ndarray, np.ndarray]:
    """(first word, number of words) of each line that has words; a text's end also ends a line."""
    n = len(w.starts)
    if not n:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    new = np.zeros(n, bool)
    new[w.offsets[:-1][w.counts > 0]] = True
    breaks = np.flatnonzero(w.text == 10)
    after = np.searchsorted(w.starts, breaks)
    new[after[after < n]] = True
    starts = np.flatnonzero(new)
    return starts, np.diff(np.append(starts, n))


def _tag(model: Chain, w: tokens.Words) -> np.ndarray:
    starts, sizes = _lines(w)
    slots = _slots(model.words, w.hashes(), starts, starts + sizes - 1)
    return _marginals(_potential(model, slots), starts, sizes, model.move)


def _levels(p: np.ndarray, w: tokens.Words) -> np.ndarray:
    """(texts, 3): 1, highest marginal, log(1 + expected number of toxic tokens)."""
    out = np.zeros((len(w.counts), 3))
    out[:, 0] = 1
    some = w.counts > 0
    if len(p):
        heads = w.offsets[:-1][some]
        out[some, 1] = np.maximum.reduceat(p, heads)
        out[some, 2] = np.log1p(np.add.reduceat(p, heads))
    return out


# Fitting ------------------------------------------------------------------

def _word_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(label, text) -> per batch: word, documents with it labelled 1 and 0."""
    for batch in batches:
        label = batch.column(0).to_numpy(zero_copy_only=False)
        for at, to, w in tokens.slices(batch.column(1), tokens.ALNUM):
            pairs = np.stack([w.hashes(), tokens.owners(w.offsets).astype(np.uint64)])
            pairs = np.unique(pairs, axis=1) if pairs.size else pairs
            words, back = np.unique(pairs[0], return_inverse=True)
            bad = np.bincount(back, weights=label[at:to][pairs[1].astype(np.int64)], minlength=len(words)).astype(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(tokens.signed(words)), pa.array(bad), pa.array(np.bincount(back, minlength=len(words)) - bad)],
                                             names=["word", "bad", "good"])


def _contexts(shared):
    """(label, text) -> distinct (word, context) per batch for the candidate
    words in toxic documents; the context is the word with its neighbours."""
    def run(batches):
        for batch in batches:
            label = batch.column(0).to_numpy(zero_copy_only=False)
            for at, to, w in tokens.slices(batch.column(1), tokens.ALNUM):
                h = np.concatenate([[np.uint64(0)], w.hashes(), [np.uint64(0)]])
                hit = np.flatnonzero((label[at:to] == 1)[tokens.owners(w.offsets)] & np.isin(h[1:-1], shared.value))
                pairs = np.unique(np.stack([h[1:-1][hit], tokens.runs(h, 3)[hit]]), axis=1) if len(hit) else np.zeros((2, 0), np.uint64)
                yield pa.RecordBatch.from_arrays([pa.array(tokens.signed(pairs[0])), pa.array(tokens.signed(pairs[1]))], names=["word", "context"])
    return run


def _by_chance(bad: int, good: int, rate: float) -> float:
    """Bound (Chernoff) on the chance that a word of bad + good documents has
    so many toxic ones when a share ``rate`` of all documents is toxic."""
    n = bad + good
    share = bad / n
    if share <= rate:
        return 1.0
    rest = (1 - share) * np.log((1 - share) / (1 - rate)) if share < 1 else 0.0
    return float(np.exp(-n * (share * np.log(share / rate) + rest)))


def _windows(shared):
    """(label, text) -> windows of word hashes and their token labels: around
    each toxic token, and one window per text anywhere else."""
    def run(batches):
        marking = np.array(sorted(shared.value), np.uint64)
        for batch in batches:
            label = batch.column(0).to_numpy(zero_copy_only=False)
            words, tags, kind = [], [], []
            for at, to, w in tokens.slices(batch.column(1), tokens.ALNUM):
                h = w.hashes()
                starts, sizes = _lines(w)
                who = np.searchsorted(w.offsets, starts, side="right") - 1
                toxic = np.isin(h, marking) & (label[at:to] == 1)[tokens.owners(w.offsets)]
                for text in range(to - at):
                    mine = np.flatnonzero(who == text) if to - at < 2 else np.arange(*np.searchsorted(who, [text, text + 1]))
                    if not len(mine):
                        continue
                    hot = [i for i in mine if toxic[starts[i]: starts[i] + sizes[i]].any()]
                    plain = mine[int(h[starts[mine[0]]] % np.uint64(len(mine)))]
                    for i in {*hot, plain}:
                        span = slice(starts[i], starts[i] + sizes[i])
                        first = int(np.argmax(toxic[span]))
                        first = max(0, min(first - int(h[span][0] % np.uint64(WINDOW)), int(sizes[i]) - WINDOW))
                        span = slice(starts[i] + first, min(starts[i] + first + WINDOW, starts[i] + sizes[i]))
                        words.append(tokens.signed(h[span]).tolist())
                        tags.append(toxic[span].astype(np.int8).tolist())
                        kind.append(bool(toxic[span].any()))
            yield pa.RecordBatch.from_arrays([pa.array(words, pa.list_(pa.int64())), pa.array(tags, pa.list_(pa.int8())), pa.array(kind, pa.bool_())],
                                             names=["words", "tags", "toxic"])
    return run


def _gradients(model: Chain, slots, y, sizes):
    """Log-likelihood gradients of padded chains: y and the marginals' difference, and moves."""
    n, length = y.shape
    inside = np.arange(length) < sizes[:, None]
    u = _potential(model, slots)
    add, move = np.logaddexp, model.move
    a = np.zeros((n, length, 2))
    b = np.zeros((n, length, 2))
    a[:, 0, 1] = u[:, 0]
    for t in range(1, length):
        for j in (0, 1):
            a[:, t, j] = add(a[:, t - 1, 0] + move[0, j], a[:, t - 1, 1] + move[1, j]) + (u[:, t] if j else 0)
    for t in range(length - 2, -1, -1):
        go = t + 1 < sizes
        for i in (0, 1):
            b[:, t, i] = np.where(go, add(move[i, 0] + b[:, t + 1, 0], move[i, 1] + u[:, t + 1] + b[:, t + 1, 1]), 0)
    end = a[np.arange(n), sizes - 1]
    z = add(end[:, 0], end[:, 1])
    p = np.exp(a[:, :, 1] + b[:, :, 1] - z[:, None])
    moves = np.zeros((2, 2))
    both = inside[:, 1:]
    for i in (0, 1):
        for j in (0, 1):
            e = np.exp(a[:, :-1, i] + move[i, j] + (u[:, 1:] if j else 0) + b[:, 1:, j] - z[:, None])
            moves[i, j] = (((y[:, :-1] == i) & (y[:, 1:] == j)) * both).sum() - (e * both).sum()
    return np.where(inside, y - p, 0.0), moves / n


def _fit_chain(rows: list) -> Chain:
    rows = [r for r in rows if r["words"]]
    if not rows:
        return Chain.blank()
    model = Chain.blank(np.unique(np.concatenate([np.array(r["words"], np.int64) for r in rows]).view(np.uint64)))
    width = model.word.shape[1]
    n = len(rows)
    sizes = np.array([len(r["words"]) for r in rows])
    slots = np.full((3, n, WINDOW), -1, np.int64)
    y = np.zeros((n, WINDOW), np.int64)
    for i, r in enumerate(rows):
        h = np.array(r["words"], np.int64).view(np.uint64)
        slots[:, i, : len(h)] = _slots(model.words, h, np.array([0]), np.array([len(h) - 1]))
        y[i, : len(h)] = r["tags"]
    rng = np.random.default_rng(7)
    seen = [np.full(width, 0.5) for _ in range(3)]
    seen_move, seen_bias = np.ones((2, 2)), 1.0
    for _ in range(EPOCHS):
        order = rng.permutation(n)
        for s in range(0, n, BATCH):
            take = order[s: s + BATCH]
            g, moves = _gradients(model, slots[:, take], y[take], sizes[take])
            for j in range(3):
                at = slots[j][take]
                ok = at >= 0
                grad = np.bincount(at[ok], weights=g[ok], minlength=width) - DECAY * model.word[j]
                if j:
                    grad *= 0.1  # context weights move more slowly than the word's own
                seen[j] += grad * grad
                model.word[j] += RATE * grad / np.sqrt(seen[j])
            seen_move += moves * moves
            model.move += RATE * moves / np.sqrt(seen_move)
            bias = g.sum() / len(take)
            seen_bias += bias * bias
            model.bias += RATE * bias / np.sqrt(seen_bias)
    model.word[np.abs(model.word) < 1e-3] = 0
    used = model.word[:, :-1].any(axis=0)
    model.words, model.word = model.words[used], model.word[:, np.append(used, True)]
    return model


def _fit_level(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Ridge logistic regression by Newton's method."""
    v = np.zeros(x.shape[1])
    ridge = np.diag([1e-3, 1e-2, 1e-2])
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(x @ v, -30, 30)))
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + ridge, x.T @ (y - p) - ridge @ v)
        v = v + step
        if np.abs(step).max() < 1e-8:
            break
    return v


def _level_rows(shared):
    def run(batches):
        for batch in batches:
            for at, to, w in tokens.slices(batch.column(1), tokens.ALNUM):
                x = _levels(_tag(shared.value, w), w)
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(at, to - at), pa.array(x[:, 1]), pa.array(x[:, 2])], names=["label", "peak", "mass"])
    return run


def fit(docs: DataFrame, labels: DataFrame, column: str = "toxic", modulus: int = 5, held: int = 0) -> Chain:
    """A chain fitted on labelled documents outside the held-out bucket.

    Without a labelled row the model is neutral: no weights, a low base rate.
    """
    spark = docs.sparkSession
    train = training_texts(docs, labels, column, modulus, held, TRAIN_DOCS, "toxicity")
    per_word = (train.select("label", "text").mapInArrow(_word_counts, "word long, bad long, good long")
                .groupBy("word").agg(F.sum("bad").alias("bad"), F.sum("good").alias("good")))
    per_word = stored(per_word, "toxicity-words")
    vocabulary = per_word.count()
    counts = (per_word.filter((F.col("bad") >= MIN_DOCS) & (F.col("bad") >= MIN_PRECISION * (F.col("bad") + F.col("good"))))
              .orderBy(F.desc("bad"), "good", "word").limit(CANDIDATES).collect())
    # Labels are noisy and copies share their words: a word marks toxic documents
    # if its documents, and also its distinct contexts, are too many for chance.
    total = train.agg(F.avg("label").alias("rate"), F.count(F.lit(1)).alias("n")).first()
    rate, tries = min(max(total["rate"] or 0.0, 1e-3), 0.9), max(1, vocabulary)
    counts = [r for r in counts if tries * _by_chance(r["bad"], r["good"], rate) <= CHANCE]
    words = np.array(sorted(r["word"] for r in counts), np.int64).view(np.uint64)
    contexts = {}
    if len(words):
        found = train.select("label", "text").mapInArrow(_contexts(spark.sparkContext.broadcast(words)), "word long, context long")
        contexts = dict(found.distinct().groupBy("word").count().collect())
    marking = [r["word"] for r in counts if tries * _by_chance(min(r["bad"], contexts.get(r["word"], 0)) or 1, r["good"], rate) <= CHANCE]
    chosen = spark.sparkContext.broadcast({x & (2**64 - 1) for x in marking})
    cut = train.select("label", "text").mapInArrow(_windows(chosen), "words array<long>, tags array<byte>, toxic boolean").persist()
    rows = []
    for toxic in (True, False):
        part = cut.filter(F.col("toxic") == toxic)
        rows += part.orderBy(F.xxhash64("words")).limit(TRAIN_WINDOWS // 2).collect()
    cut.unpersist()
    model = _fit_chain(rows)
    level = train.select("label", "text").mapInArrow(_level_rows(spark.sparkContext.broadcast(model)), "label int, peak double, mass double").toArrow().to_pandas()
    if level["label"].nunique() == 2:
        x = np.column_stack([np.ones(len(level)), level["peak"], level["mass"]])
        model.level = _fit_level(x, level["label"].to_numpy(float))
    return model


# Scoring ------------------------------------------------------------------

def _score(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for batch in batches:
            for at, to, w in tokens.slices(batch.column(1), tokens.ALNUM):
                p = _tag(model, w)
                score = 1 / (1 + np.exp(-np.clip(_levels(p, w) @ model.level, -500, 500)))
                hot = np.flatnonzero(p >= 0.5)
                spans: list[list] = [[] for _ in range(to - at)]
                if len(hot):
                    who = np.searchsorted(w.offsets, hot, side="right") - 1
                    # Code points before each byte: all but continuation bytes count.
                    points = np.concatenate([[0], np.cumsum((w.text & 0xC0) != 0x80)])
                    for i, t in zip(hot.tolist(), who.tolist()):
                        zero = points[w.bounds[t]]
                        spans[t].append({"start": int(points[w.starts[i]] - zero), "end": int(points[w.ends[i]] - zero), "p": float(p[i])})
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(at, to - at), pa.array(score),
                     pa.array(spans, pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()), ("p", pa.float64())])))],
                    names=["doc_id", "score", "spans"])
    return run


def toxicity(docs: DataFrame, model: Chain) -> DataFrame:
    """doc_id, score (0 to 1), spans (start, end in code points, p) per row of ``docs``.

    A null, empty or wordless text has no spans and the score of no evidence.
    Repeated rows are scored each by itself; a null doc_id is passed on; an
    empty table gives an empty result. Only doc_id and text are read.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(_score(shared), "doc_id long, score double, spans array<struct<start:long,end:long,p:double>>")
