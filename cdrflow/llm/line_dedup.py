"""Near-duplicate lines by a segment-partition edit join.

Lines within EDITS edits of each other are linked. A line is cut into
EDITS + 1 even segments; of two linked lines the longer holds one of the
shorter's segments at a place near its own, so segments, keyed with the
line's length and the segment's number, are joined with the few substrings
that length and place allow. Candidates are verified by a banded
bit-parallel edit distance on code points; links are closed to classes.

Lines of under MIN_CHARS characters are classed where they are equal: two edits
are a large part of them.

Scale. Equal lines are one line before the join. The text stays where it is:
hashes and keys are shuffled, and only the texts of candidates are read
again. Under a key, every line is first compared with the key's head alone, and
what agrees is one component; a group of n variants of a line costs n
comparisons. Only lines outside a key's largest component are then compared with
the others, if they are at most HOT, so that no more than HOT times the key's
lines are compared; all comparisons begin with a signature of the lines, in the
join condition, which leaves few pairs to write and to verify. Under a key with more of them the lines' remainders, which must again be
within EDITS edits, are cut into segments in turn, until no key is so hot: what
is left of a line shrinks by a third each time, and remainders too short to be
cut are all within EDITS edits of the head's. So every pair within the bound is
compared or already in one component, at any group size.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import tokens
from .components import components
from .near_dup import confirmed
from .store import small, stored

EDITS = 2
MIN_CHARS = 24        # shorter lines are compared for equality only
HOT = 1_000           # lines outside a key's largest component beyond which the key is refined

LINE_BYTE = np.ones(256, bool)
LINE_BYTE[[10, 13]] = False
SAME = np.arange(256, dtype=np.uint8)
LINE_ENDS = re.compile(r"([\r\n]+)")


# Segments -----------------------------------------------------------------

def _points(w: tokens.Words) -> tuple[np.ndarray, np.ndarray]:
    """(code points of all lines one after another, bounds)."""
    text = w.text
    heads = np.concatenate([[0], np.cumsum((text & 0xC0) != 0x80)])
    whole = np.frombuffer(text.tobytes().decode("utf-8", "replace").encode("utf-32-le", "surrogatepass"), np.uint32)
    starts, ends = heads[w.starts], heads[w.ends]
    size = ends - starts
    bounds = np.concatenate([[0], np.cumsum(size)])
    at = np.arange(bounds[-1]) - np.repeat(bounds[:-1], size) + np.repeat(starts, size)
    return whole[at], bounds


def _of_texts(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    points = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), np.uint32)
    return points, np.concatenate([[0], np.cumsum([len(t) for t in texts], dtype=np.int64)]).astype(np.int64)


class Segments:
    """Segment and substring keys of lines, given as code points."""

    def __init__(self, points: np.ndarray, bounds: np.ndarray, prefix: np.ndarray):
        up, self.down = tokens.powers(len(points) + 1)
        self.sums = np.zeros(len(points) + 1, np.uint64)
        np.cumsum((points.astype(np.uint64) + np.uint64(1)) * up[: len(points)], out=self.sums[1:])
        self.starts, self.size, self.prefix = bounds[:-1], np.diff(bounds), prefix

    def _key(self, rows, start, length, line_size, number: int) -> np.ndarray:
        a = self.starts[rows] + start
        piece = (self.sums[a + length] - self.sums[a]) * self.down[a]
        tag = tokens.mix(self.prefix[rows] + line_size.astype(np.uint64) * np.uint64(EDITS + 1) + np.uint64(number))
        return tokens.mix(tokens.mix(piece + length.astype(np.uint64)) ^ tag)

    @staticmethod
    def _cut(size: np.ndarray, number: int) -> tuple[np.ndarray, np.ndarray]:
        """(start, length) of a segment of a line; the last ones are the longer ones."""
        base, extra = size // (EDITS + 1), size % (EDITS + 1)
        longer = number - (EDITS + 1 - extra)
        return number * base + np.maximum(longer, 0), base + (longer >= 0)

    def index(self) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
        """(rows, keys, starts, lengths) of each line's own segments."""
        rows = np.arange(len(self.size))
        for i in range(EDITS + 1):
            start, length = self._cut(self.size, i)
            yield rows, self._key(rows, start, length, self.size, i), start, length

    def probes(self) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
        """(rows, keys, starts, lengths) of the substrings that may be a segment
        of an equally long or shorter line: before a segment that matches first
        there are at most as many edits as segments, and likewise behind it."""
        for less in range(EDITS + 1):
            other = self.size - less
            for i in range(EDITS + 1):
                start, length = self._cut(np.maximum(other, 0), i)
                for shift in range(max(-i, less - (EDITS - i)), min(i, less + EDITS - i) + 1):
                    at = start + shift
                    rows = np.flatnonzero((other >= 0) & (at >= 0) & (at + length <= self.size))
                    if len(rows):
                        yield rows, self._key(rows, at[rows], length[rows], other[rows], i), at[rows], length[rows]


def _signature(text: str) -> int:
    """64 parities of hashed character pairs: an edit changes four at most."""
    sign = 0
    for a, b in zip(text, text[1:]):
        sign ^= 1 << ((ord(a) * 31 + ord(b) * 17) & 63)
    return sign - (1 << 64) if sign >> 63 else sign


def _agree(x: str, y: str) -> Column:
    """The signatures ``x`` and ``y`` may be of lines within EDITS edits."""
    return F.bit_count(F.col(x).bitwiseXOR(F.col(y))) <= 4 * EDITS


# Distance -----------------------------------------------------------------

def within(a: str, b: str, most: int) -> bool:
    """Edit distance of at most ``most``, by bit-parallel columns over the
    diagonal band of 2 * most + 1 cells."""
    if len(a) < len(b):
        a, b = b, a
    gap = len(a) - len(b)
    if gap > most:
        return False
    if a == b:
        return True
    band = (1 << (2 * most + 1)) - 1
    places: dict[str, int] = {}
    for i, c in enumerate(a):  # bit i + most: rows above the first are blank
        places[c] = places.get(c, 0) | 1 << (i + most)
    up, down = band & ~((1 << most) - 1), 0     # rows whose value is one more, or less, than the row's above
    value, cell = gap, 1 << (most + gap)        # the diagonal that ends in the last cell
    for j, c in enumerate(b):
        match = (places.get(c, 0) >> j) & band
        same = ((((match & up) + up) ^ up) | match | down) & band
        right, left = (down | ~(same | up)) & band, same & up
        if not same & cell:
            value += 1
            if value > most:
                return False
        moved = same >> 1
        up, down = (left | ~(moved | right)) & band, moved & right
    return True


# Spark --------------------------------------------------------------------

def _occurrences(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(doc_id, text) -> one row per line: id, place, characters, segment keys. Lines of
    under MIN_CHARS have no keys; of those, lines without a word are left out."""
    for batch in batches:
        data, offsets = tokens.raw(batch.column(1))
        for at, to in tokens.cut(offsets):
            w = _lines(data, offsets[at: to + 1])
            points, bounds = _points(w)
            chars = np.diff(bounds)
            number = np.arange(len(w.starts)) - np.repeat(w.offsets[:-1], w.counts)
            inked = np.concatenate([[0], np.cumsum(tokens.BLANK_SPLIT[w.text])])
            rows = np.flatnonzero((chars >= MIN_CHARS) | (inked[w.ends] > inked[w.starts]))
            short = chars[rows] < MIN_CHARS
            s = Segments(points, bounds, np.zeros(len(w.starts), np.uint64))
            doc = batch.column(0).take(pa.array(tokens.owners(w.offsets)[rows] + at))
            yield pa.RecordBatch.from_arrays(
                [pa.array(tokens.signed(w.hashes()[rows])), doc, pa.array(number[rows].astype(np.int32)), pa.array(chars[rows].astype(np.int32)),
                 *(pa.array(tokens.signed(k[rows]), mask=short) for _, k, _, _ in s.index())],
                names=["id", "doc_id", "line", "chars", *(f"k{i}" for i in range(EDITS + 1))])


OCCURRENCE = "id long, doc_id long, line int, chars int, " + ", ".join(f"k{i} long" for i in range(EDITS + 1))


def _lines(data: np.ndarray, offsets: np.ndarray) -> tokens.Words:
    return tokens.words_of(data, offsets, LINE_BYTE, SAME)


def _probe_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(text, repeats) -> (key, id) of the substrings of the lines not in repeats."""
    for batch in batches:
        data, offsets = tokens.raw(batch.column(0))
        for at, to in tokens.cut(offsets):
            w = _lines(data, offsets[at: to + 1])
            points, bounds = _points(w)
            keep = np.diff(bounds) >= MIN_CHARS
            for i, skip in enumerate(batch.column(1).slice(at, to - at).to_pylist()):
                if skip:
                    keep[w.offsets[i] + np.array(skip)] = False
            ids = tokens.signed(w.hashes())
            for rows, keys, _, _ in Segments(points, bounds, np.zeros(len(keep), np.uint64)).probes():
                rows_kept = keep[rows]
                yield pa.RecordBatch.from_arrays([pa.array(tokens.signed(keys[rows_kept])), pa.array(ids[rows[rows_kept]])], names=["key", "id"])


def _extracted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(text, wanted line numbers) -> (id, text, sign) of those lines."""
    for batch in batches:
        data, offsets = tokens.raw(batch.column(0))
        for at, to in tokens.cut(offsets):
            w = _lines(data, offsets[at: to + 1])
            wanted = [w.offsets[i] + np.array(x or [], np.int64) for i, x in enumerate(batch.column(1).slice(at, to - at).to_pylist())]
            rows = np.concatenate(wanted) if wanted else np.zeros(0, np.int64)
            ids = tokens.signed(w.hashes()[rows]) if len(rows) else np.zeros(0, np.int64)
            texts = [w.word(i).decode() for i in rows.tolist()]
            yield pa.RecordBatch.from_arrays([pa.array(ids), pa.array(texts, pa.string()), pa.array(map(_signature, texts), pa.int64())], names=["id", "text", "sign"])


def _refined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(prefix, id, own, text, hot keys) -> (prefix, id, own, text, sign): the
    remainders under the hot keys of a line's segments (own) or substrings."""
    for batch in batches:
        prefix, ids, own, texts, hot = (c.to_pylist() for c in batch.columns)
        points, bounds = _of_texts(texts)
        s = Segments(points, bounds, np.array(prefix, np.int64).view(np.uint64))
        wanted = [set(h) for h in hot]
        found = set()
        for mine, source in ((True, s.index()), (False, s.probes())):
            for rows, keys, starts, lengths in source:
                for r, k, a, n in zip(rows.tolist(), tokens.signed(keys).tolist(), starts.tolist(), lengths.tolist()):
                    if own[r] == mine and k in wanted[r]:
                        found.add((k, ids[r], mine, texts[r][:a] + texts[r][a + n:]))
        rows = sorted(found)
        yield pa.RecordBatch.from_arrays(
            [pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1] for r in rows], pa.int64()), pa.array([r[2] for r in rows], pa.bool_()),
             pa.array([r[3] for r in rows], pa.string()), pa.array([_signature(r[3]) for r in rows], pa.int64())],
            names=["prefix", "id", "own", "text", "sign"])


WORK = "prefix long, id long, own boolean, text string, sign long"


def _work_keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """WORK -> (key, id, own, prefix, sign): segment keys of own rows, substring keys of the others."""
    for batch in batches:
        prefix, ids, own = (batch.column(i).to_numpy(zero_copy_only=False) for i in range(3))
        points, bounds = _of_texts(batch.column(3).to_pylist())
        s = Segments(points, bounds, prefix.view(np.uint64))
        sign = batch.column(4).to_numpy()
        for mine, source in ((True, s.index()), (False, s.probes())):
            for rows, keys, _, _ in source:
                pick = own[rows] == mine
                rows, keys = rows[pick], keys[pick]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(tokens.signed(keys)), pa.array(ids[rows]), pa.array(np.full(len(rows), mine)), pa.array(prefix[rows]), pa.array(sign[rows])],
                    names=["key", "id", "own", "prefix", "sign"])


def _verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ok = [within(x, y, EDITS) for x, y in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist())]
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], names=["a", "b"]).filter(pa.array(ok, pa.bool_()))


def _verified(pairs: DataFrame, texts: DataFrame, name: str) -> DataFrame:
    """The ``pairs`` (a, b) whose lines are within EDITS edits."""
    ta, tb = (texts.select(F.col("id").alias(c), F.col("text").alias(f"text_{c}")) for c in "ab")
    full = pairs.join(ta, "a").join(tb, "b").select("a", "b", "text_a", "text_b")
    return stored(full.mapInArrow(_verify, "a long, b long"), f"{name}-links")


def _joined(x: DataFrame, y: DataFrame) -> DataFrame:
    """Pairs of rows under one key that lie in two components and whose signatures are near."""
    x, y = x.alias("x"), y.alias("y")
    on = (F.col("x.key") == F.col("y.key")) & (F.col("x.component") != F.col("y.component")) & _agree("x.sign", "y.sign")
    return x.join(y, on).select(F.least("x.id", "y.id").alias("a"), F.greatest("x.id", "y.id").alias("b")).distinct()


def _placed(rows: DataFrame, near: DataFrame | None) -> DataFrame:
    if near is None:
        return rows.withColumn("component", F.col("id"))
    return (rows.join(small(near.withColumnRenamed("node", "id")), "id", "left")
            .withColumn("component", F.coalesce("component", "id")))


def _linked(rows: DataFrame, texts: DataFrame, remainders: DataFrame | None) -> DataFrame:
    """(node, component) of the lines that are linked under any key of ``rows``
    (key, id, own, sign): a key's own lines hold it as a segment, the others as a
    substring; sign is the signature of what is to be compared.

    ``texts`` (id, text, times) has the lines of all rows and how often they occur. In the first round these are whole lines
    and ``remainders`` is None; see the module's text.
    """
    links, near, depth = None, None, 0
    while True:
        name = f"lines-{depth}"

        def settle(pairs: DataFrame, step: str) -> None:
            nonlocal links, near
            more = _verified(stored(pairs, f"{name}-{step}-pairs"), texts, f"{name}-{step}")
            if more.isEmpty() and links is not None:
                return
            # What is linked so far stands for its links.
            links = more if near is None else near.select(F.col("node").alias("a"), F.col("component").alias("b")).unionAll(more)
            near = stored(components(links, f"{name}-{step}"), f"{name}-{step}-near")

        # The line that occurs most often: of the variants of a line, more likely that line than one of them.
        placed = _placed(rows, near)
        owned = placed.filter("own").join(small(texts.select("id", "times")), "id")
        heads = owned.groupBy("key").agg(F.max(F.struct("times", "id", "sign", "component")).alias("h"))
        heads = small(stored(heads.select("key", "h.id", "h.sign", "h.component"), f"{name}-heads"))
        settle(_joined(heads, placed.filter("not own")), "star")
        # Per key the largest component, and how many lines lie outside it.
        placed = stored(_placed(rows, near), f"{name}-placed")
        mine = F.col("own").cast("int")
        per = placed.groupBy("key", "component").agg(F.sum(mine).alias("o"), F.sum(1 - mine).alias("p"))
        keys = (per.groupBy("key").agg(F.max(F.struct(F.col("o") + F.col("p"), "component", "o", "p")).alias("top"),
                                       F.sum("o").alias("o"), F.sum("p").alias("p"))
                .select("key", F.col("top.component").alias("major"), (F.col("o") - F.col("top.o")).alias("o"), (F.col("p") - F.col("top.p")).alias("p"))
                .filter("o > 0 or p > 0").select("key", "major", (F.greatest("o", "p") > HOT).alias("hot")))
        keys = stored(keys, f"{name}-keys")
        if keys.isEmpty():
            return near
        rest = placed.join(small(keys), "key")
        rest = stored(rest, f"{name}-rest")
        cold, outside = rest.filter("not hot"), F.col("component") != F.col("major")
        pairs = (_joined(cold.filter(F.col("own") & outside), cold.filter("not own"))
                 .unionAll(_joined(cold.filter(F.col("own") & ~outside), cold.filter(~F.col("own") & outside))).distinct())
        settle(pairs, "cold")
        hot = rest.filter("hot")
        if hot.isEmpty():
            return near
        depth += 1
        on = ["id", "own"] if remainders is None else ["prefix", "id", "own"]
        held = hot.groupBy(*on).agg(F.collect_set("key").alias("keys"))
        whole = texts.select("id", "text", F.lit(0).cast("long").alias("prefix")) if remainders is None else remainders.drop("sign")
        work = held.join(whole, ["id"] if remainders is None else on).select("prefix", "id", "own", "text", "keys")
        remainders = stored(work.mapInArrow(_refined, WORK), f"lines-work{depth}")
        rows = remainders.mapInArrow(_work_keys, "key long, id long, own boolean, prefix long, sign long").distinct()
        rows = stored(rows, f"lines-keys{depth}")


def _line_texts(docs: DataFrame, distinct: DataFrame, ids: DataFrame, name: str) -> DataFrame:
    """(id, text, sign) of the lines ``ids``, read from the documents that own them."""
    places = distinct.join(small(ids), "id", "left_semi").select("first.doc_id", "first.line")
    places = stored(places.groupBy("doc_id").agg(F.collect_list("line").alias("lines")), f"{name}-places")
    rows = docs.join(small(places, "size(lines)"), "doc_id").select("text", "lines")
    return rows.mapInArrow(_extracted, "id long, text string, sign long").dropDuplicates(["id"])


def line_classes(docs: DataFrame) -> DataFrame:
    """(doc_id, line, chars, first_doc, first_line) of every occurrence of a line that has
    an equal or near-equal line elsewhere; first_doc and first_line are the
    place of the class's first occurrence (by doc_id, then line number).

    ``docs`` has doc_id and text. Lines end at line feeds and carriage returns;
    empty lines aren't numbered. Lines of under MIN_CHARS characters have a part
    where they are equal and hold a word; null and empty texts have none. Rows without a doc_id are left out; rows that
    repeat a doc_id are taken for the same places. Other columns are not read.
    """
    docs = (docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
            .filter("doc_id is not null and text is not null"))
    keys = [f"k{i}" for i in range(EDITS + 1)]
    seen = stored(docs.mapInArrow(_occurrences, OCCURRENCE), "lines-seen")
    distinct = stored(seen.groupBy("id").agg(
        F.min(F.struct("doc_id", "line")).alias("first"), F.count(F.lit(1)).alias("times"),
        *(F.first(k).alias(k) for k in keys)), "lines-distinct")
    # Later occurrences of equal lines are not keyed again.
    repeated = distinct.filter("times > 1").select("id", "first")
    again = stored(seen.select("id", "doc_id", "line").join(repeated, "id")
                   .filter((F.col("doc_id") != F.col("first.doc_id")) | (F.col("line") != F.col("first.line")))
                   .groupBy("doc_id").agg(F.collect_list("line").alias("repeats")), "lines-again")
    others = docs.join(small(again, "size(repeats)"), "doc_id", "left").select("text", "repeats").mapInArrow(_probe_rows, "key long, id long")
    # Most substrings are no segment, or only their own line's.
    own = distinct.filter("k0 is not null").select("id", F.explode(F.array(*keys)).alias("key"))
    held = own.groupBy("key").agg(F.min("id").alias("least"), F.max("id").alias("most"))
    hits = others.join(held, "key").filter("id <> least or id <> most").select("key", "id").distinct()
    hits = stored(hits, "lines-hits")
    shared = stored(hits.select("key").distinct(), "lines-shared")
    rows = hits.withColumn("own", F.lit(False)).unionAll(
        own.join(small(shared), "key", "left_semi").select("key", "id", F.lit(True).alias("own")))
    rows = stored(rows, "lines-keys")
    ids = stored(rows.select("id").distinct(), "lines-ids")
    texts = stored(_line_texts(docs, distinct, ids, "lines").join(distinct.select("id", "times"), "id"), "lines-texts")
    near = _linked(rows.join(small(texts.select("id", "sign")), "id"), texts, None)
    near = near if near is not None else docs.sparkSession.createDataFrame([], "node long, component long")
    # The first occurrence of each class.
    named = (distinct.join(near.withColumnRenamed("node", "id"), "id", "left").select(
        "id", F.coalesce("component", "id").alias("class"), "first", "times", F.col("component").isNotNull().alias("near"))
        .filter("near or times > 1"))
    named = stored(named, "lines-named")
    heads = named.filter("near").groupBy("class").agg(F.min("first").alias("head"))
    named = named.join(heads, "class", "left").select("id", F.coalesce("head", "first").alias("head"))
    return seen.select("id", "doc_id", "line", "chars").join(named, "id").select(
        "doc_id", "line", "chars", F.col("head.doc_id").alias("first_doc"), F.col("head.line").alias("first_line"))


def repeats(docs: DataFrame) -> DataFrame:
    """(doc_id, lines, foreign_chars, sources, source, source_chars): per document that
    has any, the numbers of its lines whose class occurs before, the characters of
    those first seen in another document, the documents they were first seen in,
    and the other document that most of the characters were first seen in."""
    classes = line_classes(docs)
    later = classes.filter((F.col("doc_id") != F.col("first_doc")) | (F.col("line") != F.col("first_line"))).distinct()
    foreign = F.when(F.col("doc_id") != F.col("first_doc"), F.col("chars")).otherwise(0)
    pairs = later.groupBy("doc_id", "first_doc").agg(F.collect_list("line").alias("lines"), F.sum(foreign).alias("chars"))
    most = F.max(F.when(F.col("doc_id") != F.col("first_doc"), F.struct("chars", -F.col("first_doc"))))
    return stored(pairs.groupBy("doc_id").agg(
        F.array_sort(F.flatten(F.collect_list("lines"))).alias("lines"), F.sum("chars").alias("foreign_chars"),
        F.array_sort(F.collect_list("first_doc")).alias("sources"),
        most.alias("most")).select("doc_id", "lines", "foreign_chars", "sources", (-F.col("most.col2")).alias("source"), F.col("most.chars").alias("source_chars")),
        "lines-repeats")


def _without(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The last two columns (text, lines) -> text without those lines and their line ends."""
    for batch in batches:
        n = batch.num_columns - 2
        out = []
        for text, lines in zip(batch.column(n).to_pylist(), batch.column(n + 1).to_pylist()):
            if text is not None and lines:
                drop, number, kept = set(lines), -1, []
                for part in LINE_ENDS.split(text):
                    if part and part[0] not in "\r\n":
                        number += 1
                        if number in drop:
                            if kept and kept[-1][:1] in ("\r", "\n"):
                                kept.pop()
                            continue
                    if part:
                        kept.append(part)
                text = "".join(kept)
            out.append(text)
        yield pa.RecordBatch.from_arrays([*batch.columns[:n], pa.array(out, pa.string())], names=batch.schema.names[:-1])


def near_copies(docs: DataFrame, found: DataFrame, k: int, percent: int) -> DataFrame:
    """(doc_id) of the documents that are near copies of the one most of their
    lines come from: half of their characters or more, confirmed on k-word shingles."""
    rows = docs.select("doc_id", "text").join(small(found.filter("source is not null").select("doc_id", "source", "source_chars")), "doc_id")
    pairs = (rows.filter(2 * F.col("source_chars") >= F.length(F.regexp_replace("text", r"[\r\n]", "")))
             .select(F.col("doc_id").alias("a"), F.col("source").alias("b")).distinct())
    return stored(confirmed(pairs, docs, k, percent, "lines-copies").select(F.col("a").alias("doc_id")).distinct(), "lines-copies")


def without_repeats(docs: DataFrame, key: str = "doc_id", copies: tuple[int, int] | None = None) -> DataFrame:
    """``docs`` without lines whose class occurs before; its columns and their order stay.

    A line stays at its first place (smallest ``key``, then line number). A
    document goes when it had such lines and no line with a word is left. With
    ``copies`` (k, percent), near copies of another document that have something
    of their own left stay whole, for a later step to decide on: without their
    common lines it could no longer see them. n_chars, where there is such a
    column, is counted anew for changed texts. Documents without repeated lines,
    also null and empty ones, stay as they are.
    """
    texts = docs.select(F.col(f"`{key}`").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    found = repeats(texts)
    whole = F.lit(False)
    if copies:
        found = found.join(small(near_copies(texts, found, *copies)).withColumn("copy", F.lit(True)), "doc_id", "left")
        whole = F.coalesce(F.col("copy"), F.lit(False))
    found = stored(found.select(F.col("doc_id").alias("at"), "lines", whole.alias("whole")), "lines-found")
    packed = docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("d"), F.col(f"`{key}`").cast("long").alias("at"))
    both = (packed.join(small(found, "size(lines)"), "at", "left")
            .select("d", F.col("lines").isNotNull().alias("changed"), F.coalesce("whole", F.lit(False)).alias("whole"), F.col("d.text").alias("text"), "lines"))
    out = both.mapInArrow(_without, T.StructType([*both.schema.fields[:3], T.StructField("text", T.StringType())]))
    out = out.filter(~F.col("changed") | F.col("text").rlike(r"\S"))
    out = out.withColumn("text", F.when(F.col("whole"), F.col("d.text")).otherwise(F.col("text")))

    def column(f: T.StructField):
        if f.name == "text":
            return F.col("text")
        if f.name == "n_chars":
            return F.when(F.col("changed"), F.length("text")).otherwise(F.col("d.n_chars")).cast(f.dataType).alias("n_chars")
        return F.col("d")[f.name].alias(f.name)
    return out.select(*map(column, docs.schema.fields))


def report(docs: DataFrame) -> DataFrame:
    """doc_id, n_repeated (lines whose class occurs before), repeated_chars (of
    those first seen in another document), first_seen_in (those documents, as
    an array) and repeated_lines (their numbers) for each row of ``docs``."""
    found = small(repeats(docs), "size(lines) + size(sources)")
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"))
    return rows.join(found, "doc_id", "left").select(
        "doc_id", F.coalesce(F.size("lines"), F.lit(0)).cast("long").alias("n_repeated"),
        F.coalesce("foreign_chars", F.lit(0)).cast("long").alias("repeated_chars"),
        F.coalesce(F.array_join(F.col("lines").cast("array<string>"), ","), F.lit("")).alias("repeated_lines"),
        F.coalesce(F.array_join(F.filter("sources", lambda s: s != F.col("doc_id")).cast("array<string>"), ","), F.lit("")).alias("first_seen_in"))
