"""MinHash near-duplicate groups.

Method: per document the minima of many universal hash functions
(multiply-add over 64 bits) of its word shingles, cut into bands; documents
that share a band are candidates; candidates are thinned by a size bound and
a one-bit signature, and confirmed on their full shingle sets; the confirmed
links are closed by alternating large-star and small-star.

Scale. Equal sets are one representative before any banding. In a band,
every member is first compared with the band's most connected document only;
after the first components, a band's members outside its largest component
are compared with the others, once per pair, unless exact bounds rule a link
out: the shingles that no other member has, and the shingles of the band's
head that either of the two lacks. So a group of n copies or near copies
costs about n comparisons, yet every pair that shares a band is confirmed,
ruled out or already in one component.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import tokens
from .components import components
from .store import small, stored

ROWS, BANDS = 4, 28      # a pair at 0.8 shares no band with probability 4e-7
SIGN_BITS = 128          # one bit of each further minimum
SIGN_SLACK = 36          # bits by which a pair at 0.8 may differ: 12.8 expected, deviation 3.4
SEED = 20240229


def _family(n: int) -> tuple[np.ndarray, np.ndarray]:
    r = np.random.default_rng(SEED)
    draw = r.integers(0, 1 << 63, size=(2, n), dtype=np.uint64)
    return (draw[0] << np.uint64(1)) | np.uint64(1), draw[1]


def shingle_hashes(w: tokens.Words, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(hashes, offsets): the k-word shingles of each text, in order. A text
    with fewer words, but not none, has one shingle: all its words."""
    h = w.hashes()
    counts = w.counts
    n = np.where(counts >= k, counts - k + 1, (counts > 0).astype(np.int64))
    offsets = np.concatenate([[0], np.cumsum(n)])
    out = np.zeros(offsets[-1], np.uint64)
    whole = np.flatnonzero(counts >= k)
    if len(whole):
        all_runs = tokens.runs(h, k)
        size = n[whole]
        step = np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)
        out[np.repeat(offsets[whole], size) + step] = all_runs[np.repeat(w.offsets[whole], size) + step]
    for d in np.flatnonzero((counts > 0) & (counts < k)):
        own = h[w.offsets[d]: w.offsets[d + 1]]
        out[offsets[d]] = tokens.runs(own, len(own))[0] + np.uint64(len(own))
    return out, offsets


FEATURES = ("doc_id long, n_shingles long, set1 long, set2 long, sign1 long, sign2 long, bands array<long>")


def _features(k: int):
    """Arrow batches (doc_id, text) -> FEATURES."""
    mul, add = _family(ROWS * BANDS + SIGN_BITS)

    def one(x: np.ndarray, offsets: np.ndarray):
        """Of texts with at least one shingle each."""
        heads = offsets[:-1]
        # Sets: sort each text's hashes, keep the first of equal ones.
        who = tokens.owners(offsets)
        order = np.lexsort((x, who))
        s, so = x[order], who[order]
        fresh = np.ones(len(s), bool)
        fresh[1:] = (s[1:] != s[:-1]) | (so[1:] != so[:-1])
        s, so = s[fresh], so[fresh]
        size = np.bincount(so, minlength=len(heads))
        heads = np.concatenate([[0], np.cumsum(size)[:-1]])
        set1 = np.add.reduceat(tokens.mix(s), heads)
        set2 = np.add.reduceat(tokens.mix(s ^ tokens.STEP), heads)
        low = np.empty((len(mul), len(heads)), np.uint64)
        work = np.empty_like(s)
        for j in range(len(mul)):
            np.multiply(s, mul[j], out=work)
            work += add[j]
            np.minimum.reduceat(work, heads, out=low[j])
        bands = np.empty((len(heads), BANDS), np.uint64)
        for b in range(BANDS):
            key = np.full(len(heads), b + 1, np.uint64)
            for r in range(ROWS):
                key = tokens.mix(key + low[b * ROWS + r])
            bands[:, b] = key
        bit = (tokens.mix(low[ROWS * BANDS:]) & np.uint64(1)).T
        place = np.uint64(1) << np.arange(64, dtype=np.uint64)
        return size, set1, set2, (bit[:, :64] * place).sum(1, dtype=np.uint64), (bit[:, 64:] * place).sum(1, dtype=np.uint64), bands

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, to, w in tokens.slices(batch.column(1), tokens.BLANK_SPLIT):
                x, offsets = shingle_hashes(w, k)
                some = np.flatnonzero(np.diff(offsets))
                columns = [np.zeros(to - at, np.int64) for _ in range(5)]
                flat, ends = np.zeros(0, np.int64), np.zeros(to - at + 1, np.int32)
                if len(some):
                    *parts, bands = one(x, np.concatenate([offsets[some], offsets[-1:]]))
                    for c, p in zip(columns, parts):
                        c[some] = p.astype(np.int64) if p.dtype != np.uint64 else tokens.signed(p)
                    flat = tokens.signed(bands.reshape(-1))
                    has = np.zeros(to - at, np.int32)
                    has[some] = BANDS
                    ends[1:] = np.cumsum(has)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(at, to - at), *map(pa.array, columns),
                     pa.ListArray.from_arrays(pa.array(ends), pa.array(flat))],
                    names=["doc_id", "n_shingles", "set1", "set2", "sign1", "sign2", "bands"])

    return run


def _words(text: str) -> list[bytes]:
    return text.encode().lower().split()  # bytes: A-Z only, and blanks are 0x20 and 0x09-0x0D


def _shingles(text: str, k: int) -> set:
    words = _words(text)
    if len(words) < k:
        return {tuple(words)} if words else set()
    return set(zip(*(words[i:] for i in range(k))))


def _confirm(k: int, percent: int):
    """Arrow batches (a, b, text_a, text_b) -> the (a, b) whose full sets agree."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, held = None, set()
        for batch in batches:
            a, b, ta, tb = (c.to_pylist() for c in batch.columns)
            keep = []
            for i in range(len(a)):
                if a[i] != last:
                    last, held = a[i], _shingles(ta[i], k)
                other = _shingles(tb[i], k)
                both = len(held & other)
                keep.append(100 * both >= percent * (len(held) + len(other) - both) > 0)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], names=["a", "b"]).filter(pa.array(keep, pa.bool_()))
    return run


def _alike(x: str, y: str, percent: int):
    """Necessary conditions of a similarity of ``percent``: sizes, signature."""
    c = F.col
    return ((c(f"{x}.n") * 100 >= c(f"{y}.n") * percent) & (c(f"{y}.n") * 100 >= c(f"{x}.n") * percent)
            & (F.bit_count(c(f"{x}.sign1").bitwiseXOR(c(f"{y}.sign1")))
               + F.bit_count(c(f"{x}.sign2").bitwiseXOR(c(f"{y}.sign2"))) <= SIGN_SLACK))


def _texts(docs: DataFrame, pairs: DataFrame, x: str, y: str, name: str) -> DataFrame:
    """``pairs`` with text_a and text_b, the texts of the ids x and y; an id
    with two texts gives a row for each. Sorted runs of x."""
    ids = pairs.select(F.explode(F.array(x, y)).alias("doc_id")).distinct()
    ids = small(stored(ids, f"{name}-ids"))
    texts = stored(docs.join(ids, "doc_id", "left_semi").dropDuplicates(), f"{name}-texts")
    ta = texts.select(F.col("doc_id").alias(x), F.col("text").alias("text_a"))
    tb = texts.select(F.col("doc_id").alias(y), F.col("text").alias("text_b"))
    return pairs.join(tb, y).join(ta, x).select(x, y, "text_a", "text_b")


def confirmed(pairs: DataFrame, docs: DataFrame, k: int, percent: int, name: str) -> DataFrame:
    """The ``pairs`` (a, b) of doc_ids whose full sets of k-word shingles agree to ``percent``."""
    full = _texts(docs, stored(pairs, f"{name}-pairs"), "a", "b", name)
    return stored(full.mapInArrow(_confirm(k, percent), "a long, b long").distinct(), f"{name}-links")


LACKS = 4    # longs of a bitmap


def _lacking(k: int):
    """Arrow batches (head, id, text_a, text_b) -> what the text has beyond the
    head's shingles, and a bitmap of hashed shingles of the head that it lacks."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, held, places = None, set(), {}
        for batch in batches:
            heads, _, ta, tb = (c.to_pylist() for c in batch.columns)
            sizes, beyond, maps = [], [], []
            for i in range(len(heads)):
                if heads[i] != last:
                    last, held = heads[i], _shingles(ta[i], k)
                    # The same order of shingles on every worker: a place is a bit.
                    places = {x: p % (64 * LACKS) for p, x in enumerate(sorted(held))}
                other = _shingles(tb[i], k)
                sizes.append(len(held))
                beyond.append(len(other - held))
                bits = 0
                for x in held - other:
                    bits |= 1 << places[x]
                maps.append(bits)
            words = [tokens.signed(np.array([(m >> (64 * j)) & (2**64 - 1) for m in maps], np.uint64)) for j in range(LACKS)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(sizes, pa.int64()), pa.array(beyond, pa.int64()), *map(pa.array, words)],
                names=["head", "id", "n_head", "beyond", *(f"lack{j}" for j in range(LACKS))])
    return run


def _shingle_rows(k: int):
    """Arrow batches (doc_id, text) -> (id, shingle), each shingle once per text."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, to, w in tokens.slices(batch.column(1), tokens.BLANK_SPLIT):
                x, offsets = shingle_hashes(w, k)
                pairs = np.unique(np.stack([tokens.owners(offsets).astype(np.uint64), x]), axis=1)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(pa.array(pairs[0].astype(np.int64) + at)), pa.array(tokens.signed(pairs[1]))],
                    names=["id", "shingle"])
    return run


def _own_shingles(docs: DataFrame, member: DataFrame, k: int) -> DataFrame:
    """(id, own): how many shingles of each of the ``member`` ids no other of them has.

    Those can't be in an intersection, which bounds the similarity of any two
    members exactly.
    """
    ids = stored(member.select(F.col("id").alias("doc_id")).distinct(), "near-mixed-ids")
    texts = docs.join(small(ids), "doc_id", "left_semi")
    return (texts.mapInArrow(_shingle_rows(k), "id long, shingle long").groupBy("shingle")
            .agg(F.min("id").alias("id"), F.max("id").alias("last")).filter("id = last")
            .groupBy("id").agg(F.count(F.lit(1)).alias("own")))


def near_duplicates(docs: DataFrame, k: int = 5, percent: int = 80) -> DataFrame:
    """doc_id, n_shingles, component_id, kept for each row of ``docs`` (doc_id, text).

    Two documents are linked when 100 * |A & B| >= percent * |A | B| for their
    sets of k-word shingles; component_id is the smallest doc_id reachable.
    A null, empty or blank text has no shingles and is linked with nothing.
    Rows that repeat a doc_id are all returned, as one node (its texts' links
    are joined). A null doc_id is linked with nothing: component_id is null and
    the row is kept. An empty table gives an empty result. Other columns are
    not read.
    """
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    feats = stored(docs.mapInArrow(_features(k), FEATURES), "near-features")
    nodes = feats.filter("n_shingles > 0 and doc_id is not null")
    # Documents with equal sets: one representative.
    same = (nodes.groupBy("set1", "set2").agg(F.min("doc_id").alias("rep"), F.count(F.lit(1)).alias("n"))
            .filter("n > 1").drop("n"))
    copies = stored(nodes.select("doc_id", "set1", "set2").join(same, ["set1", "set2"])
                    .filter("doc_id <> rep").distinct(), "near-copies")
    lone = nodes.join(small(copies.drop("rep")), ["doc_id", "set1", "set2"], "left_anti")
    # Bands that more than one representative has.
    rows = lone.select(F.posexplode("bands").alias("slot", "band"), F.col("doc_id").alias("id"))
    shared = rows.groupBy("band").agg(F.count(F.lit(1)).alias("size")).filter("size > 1")
    facts = lone.select(F.col("doc_id").alias("id"), F.col("n_shingles").alias("n"), "sign1", "sign2")
    member = stored(rows.join(shared, "band").join(facts, "id"), "near-members")
    # A band's head is its member with the most company over all bands: of near
    # copies of one text, that text rather than one of the copies.
    weight = member.groupBy("id").agg(F.sum("size").alias("weight"))
    heads = (member.select("band", "id").join(weight, "id").groupBy("band")
             .agg(F.max(F.struct("weight", -F.col("id"))).alias("top")).select("band", (-F.col("top.col2")).alias("head")))
    facts = member.select("id", "n", "sign1", "sign2").distinct()
    star = member.join(heads, "band").filter("id <> head").select("id", "n", "sign1", "sign2", "head").distinct().alias("x").join(
        facts.alias("y"), (F.col("x.head") == F.col("y.id")) & _alike("x", "y", percent)).select(
        F.col("x.head").alias("a"), F.col("x.id").alias("b")).distinct()
    links = confirmed(star, docs, k, percent, "near-star")
    first = stored(components(links, "near-first"), "near-first-map")
    # In each band, members outside its largest component against the others.
    placed = (member.join(first.withColumnRenamed("node", "id"), "id", "left")
              .withColumn("component", F.coalesce("component", "id")))
    per = placed.groupBy("band", "component").agg(F.count(F.lit(1)).alias("m"))
    major = (per.groupBy("band").agg(F.max(F.struct("m", "component")).alias("top"), F.count(F.lit(1)).alias("c"))
             .filter("c > 1").select("band", F.col("top.component").alias("major")))
    mixed = placed.join(major, "band").join(heads, "band").drop("size")
    mixed = stored(mixed.join(lone.select(F.col("doc_id").alias("id"), "bands"), "id"), "near-mixed")
    twice = stored(lone.groupBy("doc_id").count().filter("count > 1").select(F.col("doc_id").alias("id")), "near-twice")
    own = stored(_own_shingles(docs, mixed, k).join(twice, "id", "left_anti"), "near-own")
    mixed = mixed.join(own, "id", "left").withColumn("own", F.coalesce("own", F.lit(0)))
    mixed = stored(mixed.filter((F.col("n") - F.col("own")) * 100 >= F.col("n") * percent), "near-bounded")
    against = stored(mixed.select("head", "id").distinct().join(twice, "id", "left_anti")
                     .join(twice.withColumnRenamed("id", "head"), "head", "left_anti"), "near-against")
    lacks = [f"lack{j}" for j in range(LACKS)]
    lacking = _texts(docs, against, "head", "id", "near-against").mapInArrow(
        _lacking(k), "head long, id long, n_head long, beyond long, " + ", ".join(f"{c} long" for c in lacks))
    # Where a text is unknown to its head, nothing is lacking and nothing bounded.
    mixed = stored(mixed.join(lacking, ["head", "id"], "left").fillna(0, lacks)
                   .withColumn("beyond", F.coalesce(F.greatest(F.col("beyond") - F.col("own"), F.lit(0)), F.col("n")))
                   .withColumn("n_head", F.coalesce("n_head", F.lit(2**40))), "near-cross-rows")
    x, y = mixed.filter("component <> major").alias("x"), mixed.alias("y")
    lacked = sum((F.bit_count(F.col(f"x.{c}").bitwiseOR(F.col(f"y.{c}"))) for c in lacks), F.lit(0))
    common = F.least(F.col("x.n") - F.col("x.own"), F.col("y.n") - F.col("y.own"),
                     F.greatest("x.n_head", "y.n_head") - lacked + F.least("x.beyond", "y.beyond"))
    first_shared = F.array_position(F.zip_with("x.bands", "y.bands", lambda p, q: p == q), True) == F.col("x.slot") + 1
    cross = x.join(y, (F.col("x.band") == F.col("y.band")) & (F.col("x.component") != F.col("y.component"))
                   & ((F.col("y.component") == F.col("y.major")) | (F.col("x.id") < F.col("y.id")))
                   & _alike("x", "y", percent)
                   & (common * 100 >= (F.col("x.n") + F.col("y.n") - common) * percent) & first_shared).select(
        F.least("x.id", "y.id").alias("a"), F.greatest("x.id", "y.id").alias("b")).distinct()
    more = confirmed(cross, docs, k, percent, "near-cross")
    if not more.isEmpty():
        links = first.select(F.col("component").alias("a"), F.col("node").alias("b")).unionAll(more)
        first = stored(components(links, "near-all"), "near-all-map")
    # Copies reach their representative's component.
    if nodes.groupBy("doc_id").count().filter("count > 1").isEmpty():
        whole = first.unionAll(
            copies.join(first.withColumnRenamed("node", "rep"), "rep", "left")
            .select(F.col("doc_id").alias("node"), F.coalesce("component", "rep").alias("component")))
    else:  # a doc_id with two texts may join two components
        whole = components(copies.select(F.col("rep").alias("a"), F.col("doc_id").alias("b")).unionAll(
            first.select(F.col("component").alias("a"), F.col("node").alias("b"))), "near-whole")
    return (feats.select("doc_id", "n_shingles").join(whole.withColumnRenamed("node", "doc_id"), "doc_id", "left")
            .select("doc_id", "n_shingles", F.coalesce("component", "doc_id").alias("component_id"))
            .withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True))))
