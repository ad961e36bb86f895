"""Benchmark decontamination by a prefix-filtered set join.

Items are cut into windows of words. A window's shingles are ordered by
rarity in the corpus; a document that contains the window must contain one
of its rarest shingles (with containment 1.0: the rarest one), so only those
prefix tokens are looked up. The token's place in the window bounds where
the window can start and end in the document; what passes is verified on the
words themselves.

Scale. The benchmark is dealt into blocks of at most ``BLOCK_WINDOWS``
windows, so what is broadcast has a fixed bound; a larger benchmark takes
more blocks. The corpus is read once for the shingle frequencies and once per
block, and never written: with several blocks what each finds is kept by the
text's digest, one row per text with hits, and joined to the rows of the last.
With one block nothing of the corpus is shuffled but one count per benchmark
shingle and task.
"""

from __future__ import annotations

import functools
import math
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import tokens
from .store import stored

BLOCK_WINDOWS = 500_000
SHINGLE = 3

MARKS = "doc_id long, n_words long, spans array<struct<start:long,end:long>>, items array<string>, digest string"
_SPANS, _ITEMS = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())])), pa.list_(pa.string())


def _item_windows(size: int):
    """Arrow batches (item_id, text) -> one row per window: item_id, words."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, to, w in tokens.slices(batch.column(1), tokens.ALNUM):
                ids, wins = [], []
                for i in range(to - at):
                    words = [w.word(j) for j in range(w.offsets[i], w.offsets[i + 1])]
                    for s in range(max(1, len(words) - size + 1) if words else 0):
                        ids.append(at + i)
                        wins.append(b" ".join(words[s: s + size]).decode("utf-8", "surrogatepass"))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(pa.array(ids, pa.int64())), pa.array(wins, pa.string())], names=["item_id", "words"])
    return run


def _hash_words(words: list[bytes]) -> np.ndarray:
    text = np.frombuffer(b" ".join(words), np.uint8)
    return tokens.words_of(text, np.array([0, len(text)]), tokens.ALNUM).hashes()


class Block:
    """A bounded set of windows, as arrays for lookup."""

    def __init__(self, rows, shingle: int):
        self.words = [r["words"].encode().split(b" ") for r in rows]
        self.items = [list(r["items"]) for r in rows]
        self.sizes = np.array([len(x) for x in self.words], np.int64)
        self.k = [min(shingle, len(x)) for x in self.words]
        self.shingles = [tokens.runs(_hash_words(x), k) for x, k in zip(self.words, self.k)]
        self.by_k = {k: np.unique(np.concatenate([s for s, q in zip(self.shingles, self.k) if q == k])) for k in sorted(set(self.k))}

    def prefixes(self, counts: dict[int, np.ndarray], containment: float) -> dict:
        """k -> (sorted tokens, first entry of each, window of each entry, offset of each entry)."""
        found = defaultdict(list)
        for w, (sh, k) in enumerate(zip(self.shingles, self.k)):
            known = counts[k][np.searchsorted(self.by_k[k], sh)]
            order = sorted(range(len(sh)), key=lambda i: (known[i], int(sh[i]), i))
            need = len(sh) - math.ceil(containment * len(sh) - 1e-9) + 1
            if containment >= 1 and known[order[0]] == 0:
                continue  # a shingle that no document has
            found[k] += [(int(sh[i]), w, i) for i in order[:need]]
        out = {}
        for k, rows in found.items():
            rows.sort()
            keys = np.array([r[0] for r in rows], np.uint64)
            uniq, first = np.unique(keys, return_index=True)
            out[k] = (uniq, np.append(first, len(keys)), np.array([r[1] for r in rows]), np.array([r[2] for r in rows]))
        return out


def _counts(shared, shingle_of):
    """Occurrences in the corpus of each shingle of the block, per task."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        by_k = shared.value.by_k
        total = {k: np.zeros(len(v), np.int64) for k, v in by_k.items()}
        quick = {k: _bits(v) for k, v in by_k.items()}
        for batch in batches:
            for _, _, w in tokens.slices(batch.column(shingle_of), tokens.ALNUM):
                h = w.hashes()
                for k, keys in by_k.items():
                    x = tokens.runs(h, k)
                    x = x[_inside(w, k, quick[k], x)]
                    at = np.minimum(np.searchsorted(keys, x), len(keys) - 1)
                    total[k] += np.bincount(at[keys[at] == x], minlength=len(keys))
        for k, n in total.items():
            at = np.flatnonzero(n)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(at), k, np.int32)), pa.array(at), pa.array(n[at])], names=["k", "at", "n"])
    return run


_BITS = 22


def _bits(keys: np.ndarray) -> np.ndarray:
    table = np.zeros(1 << _BITS, bool)
    table[(keys >> np.uint64(64 - _BITS)).astype(np.int64)] = True
    return table


def _inside(w: tokens.Words, k: int, quick: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Places of runs that may be wanted and don't cross into the next text."""
    at = np.flatnonzero(quick[(x >> np.uint64(64 - _BITS)).astype(np.int64)])
    text = np.searchsorted(w.offsets, at, side="right") - 1
    return at[at + k <= w.offsets[text + 1]]


def _mark(shared, containment: float):
    """Arrow batches (doc_id, text, digest) -> MARKS: the block's hits in each text."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, prefixes = shared.value
        quick = {k: _bits(v[0]) for k, v in prefixes.items()}

        def holds(w: tokens.Words, start: int, win: int) -> bool:
            words = block.words[win]
            if containment >= 1:
                return all(w.word(start + j) == x for j, x in enumerate(words))
            k = block.k[win]
            own = [w.word(j) for j in range(start, start + len(words))]
            sets = [{tuple(v[i: i + k]) for i in range(len(v) - k + 1)} for v in (words, own)]
            return len(sets[0] & sets[1]) >= containment * len(sets[0]) - 1e-9

        for batch in batches:
            marks = [[] for _ in range(batch.num_rows)]
            items = [set() for _ in range(batch.num_rows)]
            n_words = np.zeros(batch.num_rows, np.int64)
            for at, to, w in tokens.slices(batch.column(1), tokens.ALNUM):
                n_words[at:to] = w.counts
                h = w.hashes() if len(prefixes) else None
                hits: set[tuple[int, int]] = set()
                for k, (keys, first, wins, offs) in prefixes.items():
                    x = tokens.runs(h, k)
                    place = _inside(w, k, quick[k], x)
                    key = np.minimum(np.searchsorted(keys, x[place]), len(keys) - 1)
                    ok = keys[key] == x[place]
                    place, key = place[ok], key[ok]
                    # All (place, entry) combinations, then the positional and length bounds.
                    n = first[key + 1] - first[key]
                    entry = np.repeat(first[key], n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
                    place = np.repeat(place, n)
                    start, win = place - offs[entry], wins[entry]
                    text = np.searchsorted(w.offsets, place, side="right") - 1
                    ok = (start >= w.offsets[text]) & (start + block.sizes[win] <= w.offsets[text + 1])
                    hits.update(zip(start[ok].tolist(), win[ok].tolist()))
                for start, win in hits:
                    if holds(w, start, win):
                        text = int(np.searchsorted(w.offsets, start, side="right")) - 1
                        base = int(w.offsets[text])
                        items[at + text].update(block.items[win])
                        marks[at + text].append({"start": start - base, "end": start - base + int(block.sizes[win])})
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(n_words), pa.array(map(_union, marks), _SPANS), pa.array(map(sorted, items), _ITEMS), batch.column(2)],
                names=["doc_id", "n_words", "spans", "items", "digest"])
    return run


def _merged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(doc_id, n_words, spans, items, more spans, more items) -> the first four, with the others merged in."""
    for batch in batches:
        spans, items, more_spans, more_items = (c.to_pylist() for c in batch.columns[2:])
        yield pa.RecordBatch.from_arrays(
            [*batch.columns[:2], pa.array([_union(x + (y or [])) for x, y in zip(spans, more_spans)], _SPANS),
             pa.array([sorted({*x, *(y or [])}) for x, y in zip(items, more_items)], _ITEMS)], names=batch.schema.names[:4])


def _union(spans: list[dict]) -> list[dict]:
    out: list[dict] = []
    for s in sorted(spans, key=lambda s: (s["start"], s["end"])):
        if out and s["start"] <= out[-1]["end"]:
            out[-1]["end"] = max(out[-1]["end"], s["end"])
        else:
            out.append(dict(s))
    return out


def contamination(docs: DataFrame, items: DataFrame, window: int = 10, containment: float = 1.0,
                  shingle: int = SHINGLE) -> DataFrame:
    """doc_id, n_words, spans, items for each row of ``docs`` (doc_id, text).

    ``items`` (item_id, text) are cut into windows of ``window`` words; an
    item of fewer words, but not none, is one window. spans are the merged
    word ranges (start, end exclusive) that a window covers; items are the
    ids, as sorted strings, of items that have a window there. With
    ``containment`` under 1 a window counts where an equally long range of
    the document has at least that share of its shingles.

    A null, empty or wordless text has no words and no hits; items without
    words are never found; an item without id marks words but isn't named.
    Repeated rows are judged each by itself. Empty tables give rows without
    hits, or no rows. Other columns are not read.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    wins = (items.select(F.col("item_id").cast("string").alias("item_id"), F.col("text").cast("string").alias("text"))
            .mapInArrow(_item_windows(window), "item_id string, words string")
            .groupBy("words").agg(F.collect_set("item_id").alias("items")))
    wins = stored(wins, "leak-windows")
    blocks = max(1, -(-wins.count() // BLOCK_WINDOWS))
    # Hits depend on the text alone: its digest stands for a row, also one without an id or with another's.
    rows = rows.withColumn("digest", F.sha2("text", 256) if blocks > 1 else F.lit(None).cast("string"))
    found = []
    for b in range(blocks):
        part = wins.filter(F.pmod(F.xxhash64("words"), F.lit(blocks)) == b)
        block = Block(part.collect(), shingle)  # at most about BLOCK_WINDOWS rows
        shared = spark.sparkContext.broadcast(block)
        counts = {k: np.zeros(len(v), np.int64) for k, v in block.by_k.items()}
        if counts:
            seen = rows.select("text").mapInArrow(_counts(shared, 0), "k int, at long, n long").groupBy("k", "at").agg(F.sum("n").alias("n"))
            for r in seen.collect():  # one number per shingle of the block
                counts[r["k"]][r["at"]] = r["n"]
        lookup = spark.sparkContext.broadcast((block, block.prefixes(counts, containment) if counts else {}))
        out = rows.mapInArrow(_mark(lookup, containment), MARKS)
        if b + 1 < blocks:
            hits = out.filter(F.size("spans") > 0).select("digest", "spans", "items")
            found.append(stored(hits.dropDuplicates(["digest"]), f"leak-block{b}"))
    if not found:
        return out.drop("digest")
    more = functools.reduce(DataFrame.unionAll, found).groupBy("digest").agg(
        F.flatten(F.collect_list("spans")).alias("more_spans"), F.flatten(F.collect_list("items")).alias("more_items"))
    both = out.join(stored(more, "leak-found"), "digest", "left").drop("digest")
    return both.mapInArrow(_merged, both.drop("more_spans", "more_items").schema)


def digest(found: DataFrame) -> DataFrame:
    """The contract's columns from ``contamination``'s."""
    hit = F.aggregate("spans", F.lit(0).cast("long"), lambda t, s: t + s["end"] - s["start"])
    return found.select(
        "doc_id", "n_words", hit.alias("n_hit"), F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join(F.array_sort("items"), ","), 256).alias("items_sha256"),
        (hit > 0).alias("contaminated"))
