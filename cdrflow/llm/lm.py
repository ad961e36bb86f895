"""Language-model scores from a log-frequency Bloom filter of n-gram counts.

n-gram counts are quantised: to 15 exactly, beyond in eight steps an octave. The
filter holds, for an n-gram of level q, the q events (n-gram, 1) to (n-gram, q). A
count is read back by probing levels until one is missing, and an n-gram counts
only where its shorter suffix does. Word counts are exact. Probabilities are
interpolated from the word up; an n-gram's share of its history takes the least
count of its level over the greatest of its history's, so shares of a history sum
to one at most, and so do the probabilities but for false hits of the filter. The
weights go by the level of the history's count and are fitted on every training
text: each text is foreseen from the counts of all the others, its own occurrences
taken off what the filter gives (deleted estimation). Order by order, a place says
how many times likelier its token's share is than the shorter n-grams' probability;
places are counted by level and that ratio, in cells of fixed number, and the
weights come from the cells.

Scale. n-grams are fingerprints of 64 bits; their top bits name a shard, and the
number of shards grows with the bytes of text, so a shard stays about as large at
any size. A filter of all n-grams has no size bound, so it isn't broadcast: a
shard's segment of it is made and probed in one task, and what is to be probed
travels there. Texts are taken in chunks of about CHUNK_BYTES; a chunk sends each
shard its distinct fingerprints with their counts, which serve as counts and as
probes, and gets levels back in the same order. Then a chunk's texts meet its
answers, and what is read at each place is stored: the weights of each order and the
scores are worked out from that. The driver holds the numbers of words and texts, the
cells of an order and the weights.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import tokens
from .labelled import bucket
from .store import stored

ORDER = 3
BITS_PER_EVENT, PROBES = 40, 12   # at most 1e-7 of unseen n-grams read as seen
SEGMENTS = 4                 # of a shard, so that one's bits stay near the caches
SHARD_BYTES = 4 << 20        # bytes of text a shard stands for
CHUNK_BYTES = 3 << 20        # of text taken together, or one text
GRAM, WORD = 5, 8            # bytes kept of a fingerprint beside its shard
COUNT = 5                    # bytes kept of a word's count at a place
PLACES_AT_ONCE = 500_000     # or one text's
TOP = 255                    # the highest level, of counts from 2**34
GRAIN, RATIOS = 64, 8192     # cells of ratios of an octave, and of all: 2**-64 to 2**64
FILES_NUMBER = "spark.sql.files.minPartitionNum"
FREE_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"

END = np.uint64(0xA0761D6478BD642F)     # the token that ends a text
BEGIN = np.uint64(0xE7037ED1A0B428DB)   # the context before its first word

#: The least count of each level.
VALUE = np.array([q if q < 8 else ((q - 8) % 8 + 8) << ((q - 8) // 8) for q in range(TOP + 2)], np.int64)


def _times(factor: int, x: np.uint64 = tokens.STEP) -> np.uint64:
    return np.uint64((factor * int(x)) & (2**64 - 1))


def _sequence(w: tokens.Words) -> tuple[np.ndarray, np.ndarray]:
    """(token hashes, offsets) of the texts: each one's words and an end."""
    n = w.counts + 1
    offsets = np.concatenate([[0], np.cumsum(n)])
    out = np.empty(offsets[-1], np.uint64)
    ends = offsets[1:] - 1
    word = np.ones(len(out), bool)
    word[ends] = False
    out[word] = w.hashes()
    out[ends] = END
    return out, offsets


def _grams(x: np.ndarray, offsets: np.ndarray) -> list[np.ndarray]:
    """For n = 1..ORDER the fingerprint of the n tokens that end at each place;
    before a text's first token stands BEGIN."""
    place = np.arange(len(x)) - np.repeat(offsets[:-1], np.diff(offsets))
    out = [tokens.mix(x + np.uint64(1))]
    total = x.copy()
    factor = np.uint64(1)
    for n in range(2, ORDER + 1):
        factor = _times(int(factor))
        older = np.full(len(x), BEGIN)
        older[n - 1:] = np.where(place[n - 1:] >= n - 1, x[: len(x) - n + 1], BEGIN)
        total = total + older * factor
        out.append(tokens.mix(total + np.uint64(n)))
    return out


# Levels and the filter ----------------------------------------------------

def _level(counts: np.ndarray) -> np.ndarray:
    """The level of each count: the count to 15, then eight steps an octave; 0 for 0."""
    octave = np.maximum(np.floor(np.log2(np.maximum(counts, 1))).astype(np.int64) - 3, 0)
    return np.minimum(8 * octave + (counts >> octave), TOP)


class Segment:
    """A Bloom filter of the events (key, 1) to (key, level), a byte to a bit: it never leaves its task."""

    def __init__(self, keys: np.ndarray, levels: np.ndarray):
        size = 64
        while size < BITS_PER_EVENT * int(levels.sum()):
            size *= 2
        self.mask, self.bits = np.uint64(size - 1), np.zeros(size, bool)
        first = np.cumsum(levels) - levels
        at, step = self._probes(np.repeat(keys, levels), np.arange(levels.sum()) - np.repeat(first, levels) + 1)
        for _ in range(PROBES):
            self.bits[(at & self.mask).astype(np.int64)] = True
            at = at + step

    def _probes(self, keys: np.ndarray, levels: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(first place, step to the next) of each event's probes."""
        at = tokens.mix(keys + levels.astype(np.uint64) * tokens.STEP)
        return at, (at >> np.uint64(32)) | np.uint64(1)

    def _held(self, keys: np.ndarray, levels: np.ndarray) -> np.ndarray:
        """Whether each event is held: the first two probes tell most of those that aren't."""
        at, step = self._probes(keys, levels)
        held = self.bits[(at & self.mask).astype(np.int64)] & self.bits[(at + step & self.mask).astype(np.int64)]
        some = np.flatnonzero(held)
        at, step, all_ = at[some] + step[some], step[some], np.ones(len(some), bool)
        for _ in range(PROBES - 2):
            at = at + step
            all_ &= self.bits[(at & self.mask).astype(np.int64)]
        held[some] = all_
        return held

    def levels(self, keys: np.ndarray) -> np.ndarray:
        """The level of each key: how many events from the first on are held."""
        out, left, q = np.zeros(len(keys), np.int64), np.arange(len(keys)), 1
        while len(left) and q <= TOP:
            span = np.arange(q, q + 1 if q < 3 else min(2 * q, TOP + 1))  # few have higher levels
            held = self._held(np.repeat(keys[left], len(span)), np.tile(span, len(left)))
            run = np.logical_and.accumulate(held.reshape(-1, len(span)), axis=1).sum(1)
            out[left] += run
            left = left[run == len(span)]
            q += len(span)
        return out


def _read_back(keys: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """The levels that a filter of the counted keys gives, segment by segment."""
    out = np.zeros(len(keys), np.int64)
    segment = (keys >> np.uint64(8 * GRAM - 8)).astype(np.int64) % SEGMENTS
    for s in range(SEGMENTS):
        mine = np.flatnonzero(segment == s)
        own = mine[counts[mine] > 0]
        out[mine] = Segment(keys[own], _level(counts[own])).levels(keys[mine])
    return out


# Chunks and shards --------------------------------------------------------

def _packed(values: np.ndarray, width: int) -> np.ndarray:
    """The low ``width`` bytes of each number."""
    return values.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :width].ravel()


def _unpacked(data: np.ndarray, width: int) -> np.ndarray:
    out = np.zeros((len(data) // width, 8), np.uint8)
    out[:, :width] = data.reshape(-1, width)
    return out.ravel().view("<u8").astype(np.uint64)


def _binaries(data: np.ndarray, bounds: np.ndarray) -> pa.Array:
    """``data`` cut at ``bounds`` (first, ..., end), in bytes."""
    return pa.Array.from_buffers(pa.binary(), len(bounds) - 1, [None, pa.py_buffer(bounds.astype(np.int32)), pa.py_buffer(np.ascontiguousarray(data).view(np.uint8))])


def _bytes(table: pa.Table, name: str) -> tuple[np.ndarray, np.ndarray]:
    """(bytes of all rows, offsets) of a binary column."""
    return tokens.raw(pa.chunked_array(table.column(name).cast(pa.binary()).chunks, pa.binary()).combine_chunks())


@dataclass
class Chunk:
    """The tokens of some texts, and their distinct words and n-grams in order of fingerprints."""

    offsets: np.ndarray
    words: np.ndarray      # distinct
    word_at: np.ndarray    # each place's word among them
    grams: np.ndarray      # distinct n-grams of two tokens and more
    gram_at: np.ndarray    # (ORDER - 1, places)

    @classmethod
    def of(cls, texts: pa.Array) -> Chunk:
        data, bounds = tokens.raw(texts)
        x, offsets = _sequence(tokens.words_of(data, bounds, tokens.BLANK_SPLIT))
        first, *rest = _grams(x, offsets)
        words, word_at = np.unique(first, return_inverse=True)
        grams, gram_at = np.unique(np.concatenate(rest), return_inverse=True)
        return cls(offsets, words, word_at, grams, gram_at.reshape(ORDER - 1, -1))

    def counts(self, texts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """How often each word and n-gram occurs in the texts that ``texts`` marks."""
        places = np.repeat(texts, np.diff(self.offsets))
        return (np.bincount(self.word_at[places], minlength=len(self.words)),
                np.bincount(self.gram_at[:, places].ravel(), minlength=len(self.grams)))


def _chunks(batches: Iterator[pa.RecordBatch], most: int) -> Iterator[tuple[int, pa.Table]]:
    """(number, rows) of consecutive rows with ``most`` bytes of text (column 1), or one row. The
    numbers are the same in every pass over the same partitions."""
    number, held, size = TaskContext.get().partitionId() << 32, [], 0
    for batch in batches:
        _, offsets = tokens.raw(batch.column(1))
        for at, to in tokens.cut(offsets, most):
            more = int(offsets[to] - offsets[at])
            if held and size + more > most:
                yield number, pa.Table.from_batches(held)
                number, held, size = number + 1, [], 0
            held.append(batch.slice(at, to - at))
            size += more
    if held:
        yield number, pa.Table.from_batches(held)


def _texts(table: pa.Table) -> pa.Array:
    return table.column("text").combine_chunks()


def _within(at: np.ndarray, text: np.ndarray) -> np.ndarray:
    """How often the item of each place (``at``) occurs in the place's ``text``."""
    n = np.bincount(at)
    more = np.flatnonzero(n[at] > 1)
    _, back, times = np.unique(text[more] * len(n) + at[more], return_inverse=True, return_counts=True)
    out = np.ones(len(at), np.int64)
    out[more] = times[back]
    return out


SENT = "shard long, chunk long, " + ", ".join(f"{k} binary, {k}_few binary, {k}_many binary" for k in ("grams", "words"))


def _sent(shard_bits: int, most: int):
    """(doc_id, text, train) -> SENT: per chunk and shard the distinct n-grams and words, and how
    often they occur in training texts."""
    edges = np.arange(1 << shard_bits, dtype=np.uint64) << np.uint64(64 - shard_bits)

    def rows(number: int, c: Chunk, counted: np.ndarray) -> pa.RecordBatch:
        words, grams = c.counts(counted)
        bounds = {"grams": np.append(np.searchsorted(c.grams, edges), len(c.grams)), "words": np.append(np.searchsorted(c.words, edges), len(c.words))}
        some = np.flatnonzero((np.diff(bounds["grams"]) > 0) | (np.diff(bounds["words"]) > 0))
        columns = [pa.array(some), pa.array(np.full(len(some), number))]
        for name, keys, n, width in (("grams", c.grams, grams, GRAM), ("words", c.words, words, WORD)):
            cut = np.append(bounds[name][some], len(keys))
            many = n >= 255    # a count that a byte can't hold
            before = np.concatenate([[0], np.cumsum(many)])
            columns += [_binaries(_packed(keys, width), cut * width), _binaries(np.minimum(n, 255).astype(np.uint8), cut),
                        _binaries(n[many].astype("<u4"), before[cut] * 4)]
        return pa.RecordBatch.from_arrays(columns, names=["shard", "chunk", "grams", "grams_few", "grams_many", "words", "words_few", "words_many"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for number, table in _chunks(batches, most):
            yield rows(number, Chunk.of(_texts(table)), table.column("train").to_numpy().astype(bool))
    return run


ANSWERS = "chunk long, shard long, grams binary, words binary, distinct long, total long"


def _answered(shard_bits: int):
    """All rows of a shard -> ANSWERS: per chunk the levels of its n-grams and the counts of its words
    in their order; and a row (chunk -1) of the shard's distinct words and tokens."""
    def run(group: pa.Table) -> pa.Table:
        shard = group.column("shard")[0].as_py()
        high = np.uint64(shard << (64 - shard_bits))
        answers, bounds, distinct, tokens_ = {}, {}, 0, 0
        for name, width in (("grams", GRAM), ("words", WORD)):
            data, at = _bytes(group, name)
            keys, back = np.unique(_unpacked(data, width) | high, return_inverse=True)
            n = _bytes(group, f"{name}_few")[0].astype(np.int64)
            n[n == 255] = _bytes(group, f"{name}_many")[0].view("<u4")
            total = np.bincount(back, n, len(keys)).astype(np.int64)
            if name == "grams":
                answers[name], bounds[name] = _read_back(keys, total).astype(np.uint8)[back], at // width
            else:
                answers[name], bounds[name] = total.astype("<i8")[back], at // width * 8
                distinct, tokens_ = int((total > 0).sum()), int(total.sum())
        n = group.num_rows
        out = pa.table({
            "chunk": group.column("chunk"), "shard": group.column("shard"),
            "grams": _binaries(answers["grams"], bounds["grams"]), "words": _binaries(answers["words"], bounds["words"]),
            "distinct": pa.array(np.zeros(n, np.int64)), "total": pa.array(np.zeros(n, np.int64))})
        own = pa.table({"chunk": [-1], "shard": [shard], "grams": [b""], "words": [b""], "distinct": [distinct], "total": [tokens_]}, out.schema)
        return pa.concat_tables([out, own])
    return run


# The model ----------------------------------------------------------------

@dataclass
class Model:
    total: int               # training tokens
    vocabulary: int          # distinct training tokens
    begins: int              # training texts
    weights: np.ndarray      # (ORDER, TOP + 1): of an order, by the level of its history

    def parts(self, words: np.ndarray, levels: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(word probabilities, levels of histories, shares of their histories) of all
        places, from word counts and levels of n-grams; the latter two have a row for each order from two on."""
        heads = offsets[:-1]
        known, ends = words > 0, words       # what the place's shorter n-gram counts, at most
        before = np.zeros((ORDER - 1, len(words)), np.int64)
        share = np.zeros((ORDER - 1, len(words)))
        for n in range(1, ORDER):
            # A place's history is the shorter n-gram that ends at the place before.
            history = np.empty(len(words), np.int64)
            history[1:] = ends[:-1]
            history[heads] = self.begins
            known = known & (levels[n - 1] > 0)
            least = np.where(known, VALUE[levels[n - 1]], 0)
            share[n - 1] = np.divide(np.minimum(least, history), history, out=np.zeros(len(words)), where=history > 0)
            before[n - 1] = _level(history)
            ends = np.where(known, VALUE[levels[n - 1] + 1] - 1, 0)
        return (words + 0.1) / (self.total + 0.1 * (self.vocabulary + 1)), before, share

    def mixed(self, p: np.ndarray, before: np.ndarray, share: np.ndarray, order: int = ORDER) -> np.ndarray:
        """Probabilities interpolated from the parts of the orders below ``order``."""
        for n in range(1, order):
            weight = self.weights[n][before[n - 1]]
            p = weight * share[n - 1] + (1 - weight) * p
        return p

    def log10(self, words: np.ndarray, levels: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """log10 of each token's interpolated probability."""
        return np.log10(self.mixed(*self.parts(words, levels, offsets)))


def _weights(cells: np.ndarray, places: np.ndarray) -> np.ndarray:
    """Interpolation weights of an order by level, by expectation maximisation over the places counted in cells."""
    level, ratio = np.divmod(cells, RATIOS)
    r = np.where(ratio > 0, 2.0 ** ((ratio + 0.5 - RATIOS // 2) / GRAIN), 0)
    size = np.bincount(level, places, TOP + 1)
    w = np.full(TOP + 1, 0.5)
    for _ in range(30):
        w[0] = 0
        own = w[level] * r
        part = np.bincount(level, places * (own / (own + 1 - w[level])), TOP + 1)
        w = np.where(size > 0, np.clip((part + 0.1) / (size + 1.0), 0, 0.98), 0.1)
    w[0] = 0
    return w


def _met(texts: pa.Table, answers: pa.Table) -> tuple[Chunk, np.ndarray, np.ndarray]:
    """(chunk, counts of each place's word, levels of its n-grams) of a chunk's texts and its answers."""
    chunk = Chunk.of(_texts(texts))
    answers = answers.sort_by("shard")
    levels, words = _bytes(answers, "grams")[0], _bytes(answers, "words")[0].view("<i8")
    if len(levels) != len(chunk.grams) or len(words) != len(chunk.words):
        raise RuntimeError("the partitions of the texts changed between two passes over them; store them first")
    return chunk, words[chunk.word_at], levels[chunk.gram_at].astype(np.int64)


PLACES = "doc_id long, train boolean, words binary, levels binary, own binary, left binary"


def _placed(texts: pa.Table, answers: pa.Table) -> pa.Table:
    """A chunk's texts and its answers -> PLACES: at each place of a text its word's count and its
    n-grams' levels; in a training text also how often the word is the text's own, and the levels
    left without the text. A level stands for its least count when the text's own are taken off."""
    chunk, words, levels = _met(texts, answers)
    train, sizes, text = texts.column("train").to_numpy().astype(bool), np.diff(chunk.offsets), tokens.owners(chunk.offsets)
    left = [_level(np.maximum(VALUE[q] - _within(at, text), 0)) for q, at in zip(levels, chunk.gram_at, strict=True)]
    mine, kept = train[text], np.concatenate([[0], np.cumsum(sizes * train)])
    flat = lambda rows: np.stack(rows, 1).astype(np.uint8)
    return pa.table({
        "doc_id": texts.column("doc_id"), "train": texts.column("train"),
        "words": _binaries(_packed(words, COUNT), chunk.offsets * COUNT), "levels": _binaries(flat(levels).ravel(), chunk.offsets * (ORDER - 1)),
        "own": _binaries(_within(chunk.word_at, text)[mine].astype("<u4"), kept * 4), "left": _binaries(flat(left)[mine].ravel(), kept * (ORDER - 1))})


def _parted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """PLACES in tables of PLACES_AT_ONCE, or one text's."""
    for batch in batches:
        _, offsets = tokens.raw(batch.column("words"))
        for at, to in tokens.cut(offsets, COUNT * PLACES_AT_ONCE):
            yield pa.Table.from_batches([batch.slice(at, to - at)])


def _at_places(table: pa.Table, levels: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(counts of words, levels, offsets of the texts) of PLACES."""
    words, bounds = _bytes(table, "words")
    return _unpacked(words, COUNT).astype(np.int64), _bytes(table, levels)[0].reshape(-1, ORDER - 1).T.astype(np.int64), bounds // COUNT


CELLS = "cell long, places long"


def _celled(model: Model, order: int):
    """PLACES of training texts -> CELLS of an order (from 0 for words): how many have a level and a
    ratio, each text without itself, by a model that has the weights of the orders below."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        places = np.zeros((TOP + 1) * RATIOS, np.int64)
        for table in _parted(batches):
            words, levels, offsets = _at_places(table, "left")
            own, sizes = _bytes(table, "own")[0].view("<u4"), np.diff(offsets)
            words = words - own
            gone = np.add.reduceat((words == 0) / own, offsets[:-1])   # words that no other text has
            others = replace(model, total=model.total - np.repeat(sizes, sizes), vocabulary=model.vocabulary - np.repeat(gone, sizes), begins=model.begins - 1)
            p, before, share = others.parts(words, levels, offsets)
            ratio = share[order - 1] / others.mixed(p, before, share, order)
            cell = np.floor(np.log2(ratio, out=np.zeros(len(p)), where=ratio > 0) * GRAIN).astype(np.int64) + RATIOS // 2
            cell = np.where(ratio > 0, np.clip(cell, 1, RATIOS - 1), 0) + before[order - 1] * RATIOS
            places += np.bincount(cell, minlength=len(places))
        some = np.flatnonzero(places)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(places[some])], names=["cell", "places"])
    return run


SCORED = "doc_id long, n_tokens long, n_known long, base_score double, score double"


def _scored(model: Model):
    """PLACES -> SCORED."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in _parted(batches):
            words, levels, offsets = _at_places(table, "levels")
            base = np.log10((words + 0.1) / (model.total + 0.1 * (model.vocabulary + 1)))
            sums = (np.add.reduceat(x, offsets[:-1]) for x in ((words > 0).astype(np.int64), base, model.log10(words, levels, offsets)))
            yield pa.RecordBatch.from_arrays([table.column("doc_id").combine_chunks(), pa.array(np.diff(offsets)), *map(pa.array, sums)],
                                             names=["doc_id", "n_tokens", "n_known", "base_score", "score"])
    return run


def _numbered(most: int):
    """(doc_id, text, train) -> (chunk, doc_id, text, train)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for number, table in _chunks(batches, most):
            for b in table.to_batches():
                yield pa.RecordBatch.from_arrays([pa.array(np.full(b.num_rows, number)), *b.columns], names=["chunk", "doc_id", "text", "train"])
    return run


@contextmanager
def _shuffles_freed(spark: SparkSession) -> Iterator[None]:
    """The shuffles of queries within leave the disk when they end."""
    was = spark.conf.get(FREE_SHUFFLES)
    spark.conf.set(FREE_SHUFFLES, "true")
    try:
        yield
    finally:
        spark.conf.set(FREE_SHUFFLES, was)


def fit(rows: DataFrame) -> tuple[Model, DataFrame, DataFrame]:
    """(model, answers, places) of ``rows`` (doc_id, text, train): the model learns from those
    marked train, the answers are its filter's levels for the n-grams of all, the places what is read
    at each place of each text.

    ``rows`` must give the same partitions each time, as a table in files does;
    where it doesn't, fitting fails rather than mixing texts up.
    """
    spark = rows.sparkSession
    if spark.conf.get(FILES_NUMBER, None) is None:   # else an executor that comes or goes changes the splits
        spark.conf.set(FILES_NUMBER, str(spark.sparkContext.defaultParallelism))
    rows = rows.select("doc_id", "text", "train")
    size, learnt = rows.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0)), F.count(F.when(F.col("train"), 1))).first()
    shard_bits = max(4, int(np.ceil(np.log2(max(size / SHARD_BYTES, 1)))))
    with _shuffles_freed(spark):
        sent = rows.mapInArrow(_sent(shard_bits, CHUNK_BYTES), SENT)
        answers = stored(sent.groupBy("shard").applyInArrow(_answered(shard_bits), ANSWERS), "lm-answers")
        distinct, total = answers.filter("chunk = -1").agg(F.coalesce(F.sum("distinct"), F.lit(0)), F.coalesce(F.sum("total"), F.lit(0))).first()
        texts = rows.mapInArrow(_numbered(CHUNK_BYTES), "chunk long, doc_id long, text string, train boolean")
        found = answers.filter("chunk >= 0").select("chunk", "shard", "grams", "words")
        places = stored(texts.groupBy("chunk").cogroup(found.groupBy("chunk")).applyInArrow(_placed, PLACES), "lm-places", compression="zstd")
        model = Model(int(total), int(distinct), int(learnt), np.zeros((ORDER, TOP + 1)))
        learning = places.filter("train").select("words", "own", "left")
        for n in range(1, ORDER):
            cells = learning.mapInArrow(_celled(model, n), CELLS).groupBy("cell").agg(F.sum("places").alias("places")).toArrow()
            model.weights[n] = _weights(cells["cell"].to_numpy(), cells["places"].to_numpy())
    return model, answers, places


def scores(docs: DataFrame, modulus: int = 10, held: int = 0) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score per row of ``docs``.

    Learns from the rows outside the held-out bucket of crc32(doc_id); a null
    doc_id is in no bucket and is not learnt from. A null text counts as empty
    and has one token, its end. Repeated rows are learnt and scored each. An
    empty table gives an empty result. Only doc_id and text are read. What ``fit`` asks of its
    rows holds for ``docs``.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
                       F.coalesce(bucket(modulus) != held, F.lit(False)).alias("train"))
    model, _, places = fit(rows)
    out = places.select("doc_id", "words", "levels").mapInArrow(_scored(model), SCORED)
    return out.select("doc_id", (bucket(modulus) == held).alias("held_out"), "n_tokens", "n_known",
                      F.lit(model.total).cast("long").alias("train_tokens"), "base_score", "score")
