"""Quality scores by histogram gradient-boosted trees over text statistics.

Statistics are vectorised numpy over Arrow batches. The trees are fitted on
a bounded sample of labelled rows (features only reach the driver) and kept
as flat arrays of complete binary trees; scoring walks all rows of a slice
down one level at a time.
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

TRAIN_ROWS = 30_000
BINS, DEPTH, TREES, RATE, RIDGE, MIN_ROWS = 64, 4, 80, 0.15, 1.0, 20

NAMES = ("log_words", "log_bytes", "mean_word", "longest_word", "upper", "digit", "symbol", "bar", "bang",
         "comma_stop", "wide", "blank", "log_lines", "mean_line", "same_lines", "distinct_words",
         "repeated_runs", "short_words", "upper_words", "marked_words")


def _per_text(flags: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    total = np.concatenate([[0], np.cumsum(flags)])
    return total[bounds[1:]] - total[bounds[:-1]]


def _distinct(h: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Distinct hashes in each text."""
    who = tokens.owners(offsets)
    order = np.lexsort((h, who))
    h, who = h[order], who[order]
    fresh = np.ones(len(h), bool)
    fresh[1:] = (h[1:] != h[:-1]) | (who[1:] != who[:-1])
    return np.bincount(who[fresh], minlength=len(offsets) - 1)


def statistics(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """(texts, len(NAMES)) of the texts data[offsets[i]:offsets[i + 1]]."""
    w = tokens.words_of(data, offsets, tokens.BLANK_SPLIT)
    text = data[offsets[0]: offsets[-1]]
    n = len(w.counts)
    size = np.maximum(np.diff(w.bounds), 1)
    words = np.maximum(w.counts, 1)

    def share(flags):
        return _per_text(flags, w.bounds) / size

    upper = (text >= 65) & (text <= 90)
    line_break = text == 10
    h = w.hashes()
    lengths = (w.ends - w.starts).astype(np.float64)
    sums = lambda x: np.diff(np.concatenate([[0], np.cumsum(x)])[w.offsets])
    longest = np.zeros(n)
    some = w.counts > 0
    if len(lengths):
        longest[some] = np.maximum.reduceat(lengths, w.offsets[:-1][some])
    # Lines: runs of all but line ends, hashed like words.
    line_byte = np.ones(256, bool)
    line_byte[10] = False
    lines = tokens.words_of(data, offsets, line_byte)
    n_lines = np.maximum(lines.counts, 1)
    # Runs of five words within one text.
    five = tokens.runs(h, 5)
    inside = np.zeros(len(five), bool)
    who = tokens.owners(w.offsets)
    if len(five):
        inside = who[: len(five)] == who[4:]
    run_offsets = np.concatenate([[0], np.cumsum(np.maximum(w.counts - 4, 0))])
    n_runs = np.maximum(w.counts - 4, 0)
    last = text[w.ends - 1] if len(w.ends) else np.zeros(0, np.uint8)
    first_upper = upper[w.starts] if len(w.starts) else np.zeros(0, bool)
    sym = np.isin(text, np.frombuffer(b"#*$%&|<>", np.uint8))
    return np.column_stack([
        np.log1p(w.counts), np.log1p(np.diff(w.bounds)), sums(lengths) / words, np.log1p(longest),
        share(upper), share((text >= 48) & (text <= 57)), share(sym), share(text == 124), share(text == 33),
        share((text == 44) | (text == 46)), share(text >= 128), share((text == 32) | ((text >= 9) & (text <= 13))),
        np.log1p(_per_text(line_break, w.bounds)), np.log1p(w.counts / n_lines),
        1 - _distinct(lines.hashes(), lines.offsets) / n_lines, _distinct(h, w.offsets) / words,
        np.where(n_runs > 0, 1 - _distinct(five[inside], run_offsets) / np.maximum(n_runs, 1), 0.0),
        sums(lengths <= 3) / words, sums(first_upper) / words,
        sums(~(((last >= 97) & (last <= 122)) | ((last >= 65) & (last <= 90)) | (last >= 128) | np.isin(last, [44, 46]))) / words,
    ])


@dataclass
class Trees:
    """Complete binary trees of depth DEPTH in flat arrays; node i has children 2i+1 and 2i+2."""

    base: float
    feature: np.ndarray    # (trees, inner nodes)
    limit: np.ndarray      # (trees, inner nodes): to the right when above it
    value: np.ndarray      # (trees, leaves)

    def score(self, x: np.ndarray) -> np.ndarray:
        total = np.full(len(x), self.base)
        rows = np.arange(len(x))
        inner = self.feature.shape[1]
        for f, lim, v in zip(self.feature, self.limit, self.value):
            at = np.zeros(len(x), np.int64)
            for _ in range(DEPTH):
                at = 2 * at + 1 + (x[rows, f[at]] > lim[at])
            total += v[at - inner]
        return 1 / (1 + np.exp(-np.clip(total, -500, 500)))


def grow(x: np.ndarray, y: np.ndarray) -> Trees:
    """Trees fitted to labels y in {0, 1} by gradient boosting on binned features."""
    inner = (1 << DEPTH) - 1
    rate = np.clip(y.mean(), 1e-3, 1 - 1e-3) if len(y) else 0.5
    base = float(np.log(rate / (1 - rate)))
    features, limits, values = [], [], []
    if len(y) and 0 < y.mean() < 1:
        cuts = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, BINS + 1)[1:-1])) for j in range(x.shape[1])]
        binned = np.column_stack([np.searchsorted(c, x[:, j], side="left") for j, c in enumerate(cuts)])
        flat = binned + np.arange(x.shape[1]) * BINS
        width = x.shape[1] * BINS
        score = np.full(len(y), base)
        for _ in range(TREES):
            p = 1 / (1 + np.exp(-score))
            g, h = y - p, p * (1 - p)
            feature, limit = np.zeros(inner, np.int64), np.full(inner, np.inf)
            at = np.zeros(len(y), np.int64)
            for level in range(DEPTH):
                first, nodes = (1 << level) - 1, 1 << level
                key = ((at - first)[:, None] * width + flat).ravel()
                shape = (nodes, x.shape[1], BINS)
                hist = [np.bincount(key, weights=np.repeat(v, x.shape[1]), minlength=nodes * width).reshape(shape).cumsum(2)
                        for v in (g, h, np.ones(len(y)))]
                gl, hl, nl = hist
                gt, ht, nt = (v[:, :, -1:] for v in hist)
                gain = gl**2 / (hl + RIDGE) + (gt - gl)**2 / (ht - hl + RIDGE) - gt**2 / (ht + RIDGE)
                gain[(nl < MIN_ROWS) | (nt - nl < MIN_ROWS)] = -1
                best = gain.reshape(nodes, -1).argmax(1)
                for i in range(nodes):
                    j, b = divmod(int(best[i]), BINS)
                    if gain[i, j, b] > 1e-9 and b < len(cuts[j]):
                        feature[first + i], limit[first + i] = j, cuts[j][b]
                at = 2 * at + 1 + (x[np.arange(len(y)), feature[at]] > limit[at])
            leaf = at - inner
            value = RATE * np.bincount(leaf, g, inner + 1) / (np.bincount(leaf, h, inner + 1) + RIDGE)
            score += value[leaf]
            features.append(feature)
            limits.append(limit)
            values.append(value)
    shape = (len(features), inner)
    return Trees(base, np.array(features, np.int64).reshape(shape), np.array(limits, float).reshape(shape),
                 np.array(values, float).reshape(len(values), inner + 1))


def _rows(key: int, text: int, make, names: list[str]):
    """Arrow function: the key column and make(statistics)'s columns."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = tokens.raw(batch.column(text))
            for at, to in tokens.cut(offsets):
                yield pa.RecordBatch.from_arrays(
                    [batch.column(key).slice(at, to - at), *map(pa.array, make(statistics(data, offsets[at: to + 1])))], names=names)
    return run


def fit(docs: DataFrame, labels: DataFrame, column: str = "quality", modulus: int = 4, held: int = 2) -> Trees:
    """Trees fitted on at most TRAIN_ROWS labelled rows outside the held-out bucket.

    Without labelled rows of both kinds there are no trees: every score is the
    base rate of the labels (one half without any).
    """
    train = training_texts(docs, labels, column, modulus, held, TRAIN_ROWS, "quality")
    schema = "label int, " + ", ".join(f"{n} double" for n in NAMES)
    rows = (train.select("label", "text").mapInArrow(_rows(0, 1, lambda x: x.T.copy(), ["label", *NAMES]), schema)
            .toArrow().to_pandas().sort_values(list(NAMES)))
    return grow(rows[list(NAMES)].to_numpy(float).reshape(len(rows), len(NAMES)), rows["label"].to_numpy(float))


def quality(docs: DataFrame, model: Trees) -> DataFrame:
    """doc_id, score (0 to 1) for each row of ``docs`` (doc_id, text).

    A null text counts as empty and is scored like any other; repeated rows
    are scored each by itself; a null doc_id is passed on; an empty table
    gives an empty result. Only doc_id and text are read.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(_rows(0, 1, lambda x: [shared.value.score(x)], ["doc_id", "score"]), "doc_id long, score double")
