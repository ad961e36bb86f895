"""Byte-level BPE encoding by a prefix-sharing trie.

Texts are cut into pieces as the tokenizer's pattern says. The distinct new
pieces of a slice are put in a trie and walked, short ones level by level and
longer ones depth first; each node keeps the last token of its prefix's encoding. The last token of a prefix is the
token t, among those that end the prefix, whose preceding prefix has a last
token that t may follow; so a prefix that many words share is encoded once.
The tokens that end a prefix are read off an automaton, one step a byte.
Whether t may follow s is decided by undoing their merges across the border.

Scale. One pass without a shuffle; the vocabulary is a parameter file that is
read once on the driver (its size is checked) and broadcast; each worker process
keeps one encoder, whose piece cache is bounded.
"""

from __future__ import annotations

import hashlib
import json
import os
import re
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import tokens

# Fixed values of byte-level BPE: the cutting pattern, and the bytes that stand for themselves.
PIECES = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
PLAIN_BYTES = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]

# The same cut for texts of Latin letters: fixed ranges of letters below U+0250, and
# the characters for which these classes don't hold (further letters, numbers and blanks).
_LATIN = "A-Za-z\u00aa\u00b5\u00ba\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u024f"
_BLANK = r" \t-\r"
LATIN_PIECES = re.compile(rf"'s|'t|'re|'ve|'m|'ll|'d| ?[{_LATIN}]+| ?[0-9]+| ?[^{_BLANK}0-9{_LATIN}]+|[{_BLANK}]+(?![^{_BLANK}])|[{_BLANK}]+")
BEYOND_LATIN = re.compile("[\x1c-\x1f\x85\xa0\xb2\xb3\xb9\xbc-\xbe\u0250-\u200a\u2028-\u202f\u205f-\U0010ffff]")

CACHE_PIECES = 150_000
KEPT_STEPS = 300_000
LONGEST, ELSE = -1, -2  # keys of an automaton's node beside the bytes
SHORT_BYTES = 32  # pieces up to here are walked level by level, longer ones depth first
BLOCK_PIECES = 50_000  # of the walk by levels at once, however many a text has
PAIR_SLOTS = 1 << 21
MODEL_BYTES = 64 << 20


def tokenizer_path(name: str = "byte_bpe_50k.json") -> str:
    """Where a file of the public vocabularies lies."""
    import public_tokenizers
    return public_tokenizers.path(name)


def byte_letters() -> dict[str, int]:
    """The letter each byte is written as in the vocabulary; other bytes take letters from 256 on."""
    rest = [b for b in range(256) if b not in set(PLAIN_BYTES)]
    return {chr(b): b for b in PLAIN_BYTES} | {chr(256 + i): b for i, b in enumerate(rest)}


class Vocabulary:
    """Tokens, merges and special tokens of a tokenizer file."""

    def __init__(self, path: str):
        if os.path.getsize(path) > MODEL_BYTES:
            raise ValueError(f"{path} is over {MODEL_BYTES} bytes: not broadcast")
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model, split = spec["model"], spec["pre_tokenizer"]
        if (model["type"], split["type"], split.get("add_prefix_space"), spec["normalizer"]) != ("BPE", "ByteLevel", False, None):
            raise ValueError("only byte-level BPE without a normalizer or prefix space")
        letters = byte_letters()
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        spelled = {t: bytes(letters[c] for c in t) for t in model["vocab"] if t not in self.special}
        self.bytes_of = {model["vocab"][t]: b for t, b in spelled.items()} | {i: t.encode() for t, i in self.special.items()}
        self.id_of = {b: model["vocab"][t] for t, b in spelled.items()}
        #: (left, right) -> (rank, merged); merged -> (rank, left, right), for the first merge that makes it.
        self.merge: dict[tuple[int, int], tuple[int, int]] = {}
        self.parts: dict[int, tuple[int, int, int]] = {}
        for rank, pair in enumerate(model["merges"]):
            a, b = pair if isinstance(pair, list) else pair.split(" ")
            left, right = model["vocab"][a], model["vocab"][b]
            made = model["vocab"][a + b]
            self.merge[left, right] = (rank, made)
            self.parts.setdefault(made, (rank, left, right))
        self.longest = max(map(len, self.id_of))


class Encoder:
    """Encodes pieces and texts; keeps about CACHE_PIECES encodings at most, those met last."""

    def __init__(self, vocabulary: Vocabulary):
        self.v = vocabulary
        self.pieces = regex.compile(PIECES)
        self.special = regex.compile("|".join(map(regex.escape, sorted(vocabulary.special, key=len, reverse=True)))) if vocabulary.special else None
        self.follows: dict[tuple[int, int], bool] = {}
        #: piece -> token ids, joined by commas; piece -> the bytes they spell
        self.cache: dict[str, str] = {}
        self.spelled: dict[str, bytes] = {}
        #: the same of pieces met before those: half of CACHE_PIECES at most, but for one slice's
        self.older: tuple[dict[str, str], dict[str, bytes]] = {}, {}
        self.size = {i: len(b) for i, b in vocabulary.bytes_of.items()}
        self.decimal = {i: str(i) for i in vocabulary.bytes_of}
        #: token -> the next shorter token that ends it
        self.shorter: dict[int, int | None] = {}
        self.kept_steps = 0
        self.start = self._endings()
        self._number()

    def _endings(self) -> dict:
        """The automaton (Aho-Corasick) that knows, after each byte, the longest token that ends there.

        A node is the longest end of what was read that begins a token: its dict
        has the node after each byte that goes on in a token, LONGEST and the
        node of its next shorter end that begins a token (ELSE).
        """
        start: dict = {LONGEST: None, ELSE: None}
        tokens_of: dict[int, int] = {}
        for b, i in self.v.id_of.items():
            if self._whole(i):
                node = start
                for x in b:
                    below = node.get(x)
                    if below is None:
                        below = node[x] = {}
                    node = below
                tokens_of[id(node)] = i
        level = [start]
        while level:  # shorter ends first
            under = []
            for node in level:
                for x, below in node.items():
                    if x < 0:
                        continue
                    other = node[ELSE]
                    while other is not None and x not in other:
                        other = other[ELSE]
                    other = start if other is None else other[x]
                    token = tokens_of.get(id(below))
                    if token is not None:
                        self.shorter[token] = other[LONGEST]
                    under.append((below, other[LONGEST] if token is None else token, other))
            for node, token, other in under:
                node[LONGEST], node[ELSE] = token, other
            level = [node for node, _, _ in under]
        return start

    def _number(self) -> None:
        """The automaton and the tokens as arrays, for the walk by levels; node 0 is the start."""
        nodes = [self.start]
        for node in nodes:
            nodes += [below for x, below in node.items() if x >= 0]
        number = {id(node): i for i, node in enumerate(nodes)}
        edges = sorted((i << 8 | x, number[id(below)]) for i, node in enumerate(nodes) for x, below in node.items() if x >= 0)
        self.edges = np.array([k for k, _ in edges] + [-1], np.int64)  # the last is no edge
        self.target = np.array([t for _, t in edges] + [0], np.int32)
        self.node_longest = np.array([-1 if node[LONGEST] is None else node[LONGEST] for node in nodes], np.int32)
        self.node_else = np.array([-1 if node[ELSE] is None else number[id(node[ELSE])] for node in nodes], np.int32)
        most = max(self.v.bytes_of, default=-1) + 1
        self.shorter_of, self.size_of = np.full(most, -1, np.int32), np.zeros(most, np.int32)
        for t, other in self.shorter.items():
            self.shorter_of[t] = -1 if other is None else other
        for t, size in self.size.items():
            self.size_of[t] = size
        self.decimals = pa.array([str(i) for i in range(most)], pa.string())
        self.spellings = pa.array([self.v.bytes_of.get(i, b"") for i in range(most)], pa.binary())
        #: Pairs met last: (left, token, whether token may follow) in one number, at a place by its hash.
        self.pairs = np.full(PAIR_SLOTS, -1, np.int64)

    def _steps(self, node: np.ndarray, x: np.ndarray) -> np.ndarray:
        """The automaton's node after each ``node`` and byte."""
        after, todo = np.zeros(len(node), np.int32), np.arange(len(node))
        while len(todo):
            key = node.astype(np.int64) << 8 | x[todo]
            at = np.searchsorted(self.edges[:-1], key)
            there = self.edges[at] == key
            after[todo[there]] = self.target[at[there]]
            node, todo = self.node_else[node[~there]], todo[~there]
            node, todo = node[node >= 0], todo[node >= 0]
        return after

    def _may_follow_all(self, left: np.ndarray, token: np.ndarray) -> np.ndarray:
        """``may_follow`` of each pair."""
        pair = left.astype(np.int64) << 31 | token
        slot = (pair.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(40)).astype(np.int64) % PAIR_SLOTS
        found = self.pairs[slot]
        unknown = np.flatnonzero(found >> 1 != pair)
        if len(unknown):
            some, first, which = np.unique(pair[unknown], return_index=True, return_inverse=True)
            made = some << 1 | np.array([self.may_follow(p >> 31, p & 0x7FFFFFFF) for p in some.tolist()], np.int64)
            self.pairs[slot[unknown[first]]] = made
            found[unknown] = made[which]
        return (found & 1).astype(bool)

    def _learn_short(self, words: list[str]) -> None:
        """``learn`` for sorted pieces of SHORT_BYTES at most: the same trie, one level of all pieces at a time.

        A piece has a node of its own on a level unless it shares that prefix with the piece before.
        """
        data, offsets = tokens.raw(pa.array(words, pa.string()))
        size, n = np.diff(offsets), len(words)
        depth = int(size.max())
        places = np.arange(depth)
        inside = places < size[:, None]
        letters = np.full((n, depth), -1, np.int16)
        letters[inside] = data
        differ = np.ones((n, depth), bool)
        differ[1:] = letters[1:] != letters[:-1]
        own = np.logical_or.accumulate(differ, axis=1) & inside
        lasts, nodes = np.zeros((depth, n), np.int32), np.zeros(n, np.int32)
        for end in range(depth):
            rows = np.flatnonzero(own[:, end])
            node = self._steps(nodes[rows], letters[rows, end])
            token, todo = self.node_longest[node], np.arange(len(rows))
            last = np.empty(len(rows), np.int32)
            while len(todo):  # the longest that may stand here
                if token.min() < 0:
                    bad = words[rows[todo[int(token.argmin())]]].encode()[: end + 1]
                    raise ValueError(f"no token ends {bad!r}")
                at = end - self.size_of[token]
                fits = at < 0
                inner = np.flatnonzero(~fits)
                fits[inner] = self._may_follow_all(lasts[at[inner], rows[todo[inner]]], token[inner])
                last[todo[fits]] = token[fits]
                token, todo = self.shorter_of[token[~fits]], todo[~fits]
            lasts[end, rows], nodes[rows] = last, node
            before = np.zeros(n, np.int64)
            before[rows] = rows
            before = np.maximum.accumulate(before)  # pieces that share the prefix take the node of the one before
            lasts[end], nodes = lasts[end, before], nodes[before]
        # From the last byte of each piece back, token by token.
        row, at, steps = np.arange(n), size - 1, []
        while len(row):
            token = lasts[at, row]
            steps.append((row, token))
            at = at - self.size_of[token]
            row, at = row[at >= 0], at[at >= 0]
        rows, ids = (np.concatenate([step[i] for step in reversed(steps)]) for i in (0, 1))
        order = np.argsort(rows, kind="stable")
        ends = pa.array(np.concatenate([[0], np.cumsum(np.bincount(rows, minlength=n))]), pa.int32())
        ids = pa.array(ids[order], pa.int32())
        joined = pc.binary_join(pa.ListArray.from_arrays(ends, self.decimals.take(ids)), ",")
        spelled = pc.binary_join(pa.ListArray.from_arrays(ends, self.spellings.take(ids)), b"")
        self.cache.update(zip(words, joined.to_pylist()))
        self.spelled.update(zip(words, spelled.to_pylist()))

    def _step(self, node: dict, x: int) -> dict:
        """The node after byte ``x`` where no token goes on; kept at the node while there is room."""
        other = node[ELSE]
        while other is not None and x not in other:
            other = other[ELSE]
        after = self.start if other is None else other[x]
        if self.kept_steps < KEPT_STEPS:
            self.kept_steps += 1
            node[x] = after
        return after

    def may_follow(self, left: int, right: int) -> bool:
        """True when BPE leaves (left, right) as two tokens.

        The merges on both sides are undone from the last to the first. A merge
        of the two tokens at the border would have come first if its rank is
        below that of every merge undone so far, and the pair can't stand.
        """
        key = (left, right)
        known = self.follows.get(key)
        if known is None:
            known = True
            merge, parts = self.v.merge, self.v.parts
            limit = len(merge)       # ranks below it come before what was undone last
            strict = True            # on equal rank the left place merges first
            while True:
                joint = merge.get((left, right))
                if joint is not None and (joint[0] < limit or (joint[0] == limit and not strict)):
                    known = False
                    break
                a, b = parts.get(left), parts.get(right)
                if a is None and b is None:
                    break
                # Undo the later merge; of equal ranks the right one is later.
                if b is None or (a is not None and a[0] > b[0]):
                    limit, left, strict = a[0], a[2], True
                else:
                    limit, right, strict = b[0], b[1], False
            if len(self.follows) > 2_000_000:
                self.follows.clear()
            self.follows[key] = known
        return known

    def _last_tokens(self, word: bytes, lasts: list[int], nodes: list[dict]) -> None:
        """Fill lasts[i] (last token of word[:i + 1]) and the automaton's nodes[i] from the first missing place on."""
        shorter, sizes, follows = self.shorter, self.size, self.follows
        node = nodes[-1] if nodes else self.start
        for end in range(len(lasts), len(word)):
            x = word[end]
            node = node.get(x) or self._step(node, x)
            nodes.append(node)
            token = node[LONGEST]
            while token is not None:  # the longest that may stand here
                at = end - sizes[token]
                if at < 0:
                    break
                left = lasts[at]
                fits = follows.get((left, token))
                if fits is None:
                    fits = self.may_follow(left, token)
                if fits:
                    break
                token = shorter[token]
            else:
                raise ValueError(f"no token ends {word[: end + 1]!r}")
            lasts.append(token)

    def _whole(self, token: int) -> bool:
        """True when the token's bytes are encoded as the token itself."""
        key = (token, -1)
        known = self.follows.get(key)
        if known is None:
            p = self.v.parts.get(token)
            known = p is None or (self._whole(p[1]) and self._whole(p[2]) and self._made(token))
            self.follows[key] = known
        return known

    def _made(self, token: int) -> bool:
        _, left, right = self.v.parts[token]
        # The border merge is the last one of the token: without it the halves stand side by side.
        limit = self.v.parts[token][0]
        merge, parts, strict = self.v.merge, self.v.parts, True
        while True:
            a, b = parts.get(left), parts.get(right)
            if a is None and b is None:
                return True
            if b is None or (a is not None and a[0] > b[0]):
                limit, left, strict = a[0], a[2], True
            else:
                limit, right, strict = b[0], b[1], False
            joint = merge.get((left, right))
            if joint is not None and (joint[0] < limit or (joint[0] == limit and not strict)):
                return False

    def learn(self, words: list[str]) -> None:
        """Encode distinct new pieces: depth first through their trie.

        In sorted order the pieces are the trie's leaves from left to right, and
        the prefix shared with the one before is the path that stays.
        """
        before, lasts, nodes = b"", [], []
        sizes, decimal, bytes_of = self.size, self.decimal, self.v.bytes_of
        words = sorted(words)  # by code point, which is the order of their bytes too
        long = [w for w in words if len(w) * 4 > SHORT_BYTES and len(w.encode()) > SHORT_BYTES]
        if long:
            apart = set(long)
            words = [w for w in words if w not in apart]
        for at in range(0, len(words), BLOCK_PIECES):
            self._learn_short(words[at: at + BLOCK_PIECES])
        for word in long:
            raw = word.encode()
            shared, most = 0, min(len(before), len(raw))
            while shared < most and before[shared] == raw[shared]:
                shared += 1
            del lasts[shared:], nodes[shared:]
            self._last_tokens(raw, lasts, nodes)
            ids, at = [], len(raw) - 1
            while at >= 0:
                t = lasts[at]
                ids.append(t)
                at -= sizes[t]
            ids.reverse()
            self.cache[word] = ",".join([decimal[t] for t in ids])
            self.spelled[word] = b"".join([bytes_of[t] for t in ids])
            before = raw

    def _cut(self, text: str) -> list[str]:
        return (self.pieces if BEYOND_LATIN.search(text) else LATIN_PIECES).findall(text)

    def encode_all(self, texts: list[str]) -> list[str]:
        """The token ids of each text, as decimals joined by commas."""
        return [ids for ids, _ in self.encodings(texts)]

    def encodings(self, texts: list[str]) -> list[tuple[str, bytes]]:
        """Of each text the token ids, as decimals joined by commas, and the bytes they spell."""
        cut: list[list] = []
        for text in texts:
            parts = []
            if self.special and (found := list(self.special.finditer(text))):
                at = 0
                for m in found:
                    parts += [*self._cut(text[at: m.start()]), (self.v.special[m[0]],)]
                    at = m.end()
                parts += self._cut(text[at:])
            else:
                parts = self._cut(text)
            cut.append(parts)
        met = set().union(*cut)
        special = {p for p in met if p.__class__ is tuple}
        met -= special
        new = met - self.cache.keys()
        if self.cache and len(new) + len(self.cache) > CACHE_PIECES // 2:  # what wasn't met since the last time goes
            self.older = self.cache, self.spelled
            self.cache, self.spelled = {}, {}
            new = met
        ids, spelled = self.older
        again = new & ids.keys()
        for p in again:
            self.cache[p], self.spelled[p] = ids[p], spelled[p]
        self.learn(list(new - again))
        ids, spelled = self.cache, self.spelled
        if special:
            ids = ids | {p: self.decimal[p[0]] for p in special}
            spelled = spelled | {p: self.v.bytes_of[p[0]] for p in special}
        ids_of, bytes_of = ids.__getitem__, spelled.__getitem__
        return [(",".join(map(ids_of, parts)), b"".join(map(bytes_of, parts))) for parts in cut]

    def decode(self, ids: list[int]) -> str:
        """The text of token ids; bytes that aren't UTF-8 become replacement characters."""
        return b"".join([self.v.bytes_of[i] for i in ids]).decode("utf-8", "replace")


def _digests(encoder: Encoder, encodings: list[tuple[str, bytes]]) -> list[pa.Array]:
    count = [ids.count(",") + 1 if ids else 0 for ids, _ in encodings]
    sha = [hashlib.sha256(ids.encode()).hexdigest() for ids, _ in encodings]
    back = [hashlib.sha256(spelled.decode("utf-8", "replace").encode()).hexdigest() for _, spelled in encodings]
    return [pa.array(count, pa.int64()), pa.array(sha, pa.string()), pa.array(back, pa.string())]


def _full(encoder: Encoder, encodings: list[tuple[str, bytes]]) -> list[pa.Array]:
    own = [[int(p) for p in ids.split(",")] if ids else [] for ids, _ in encodings]
    return [pa.array(own, pa.list_(pa.int32())), pa.array([encoder.decode(x) for x in own], pa.string())]


_encoders: dict[str, Encoder] = {}


def _encoder(name: str, vocabulary: Vocabulary) -> Encoder:
    """This worker process's encoder of a broadcast vocabulary, kept from task to task."""
    if name not in _encoders:
        _encoders.clear()
        _encoders[name] = Encoder(vocabulary)
    return _encoders[name]


def _applied(docs: DataFrame, path: str, keep: list[str], codec, made: str) -> DataFrame:
    shared, name = docs.sparkSession.sparkContext.broadcast(Vocabulary(path)), uuid.uuid4().hex
    rows = docs.select(*keep, F.col("text").cast("string").alias("_text"))
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields[:-1])
    names = [*keep, *(c.strip().split(" ")[0] for c in made.split(","))]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(name, shared.value)
        for batch in batches:
            text = batch.column(len(keep))
            for at, to in tokens.cut(tokens.raw(text)[1]):
                texts = [x or "" for x in text.slice(at, to - at).to_pylist()]
                passed = [batch.column(i).slice(at, to - at) for i in range(len(keep))]
                yield pa.RecordBatch.from_arrays([*passed, *codec(encoder, encoder.encodings(texts))], names=names)

    return rows.mapInArrow(run, f"{schema}, {made}")


def encoded(docs: DataFrame, path: str, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """The ``keep`` columns, ids and decoded for each row of ``docs`` (with text).

    ``path`` is a tokenizers JSON file of a byte-level BPE. A special token's
    string in a text is that token. A null text counts as empty: no ids, empty
    text. Repeated rows and null ids are passed on; an empty table gives an
    empty result. Other columns are not read; ``keep`` may not name ids or
    decoded.
    """
    return _applied(docs, path, list(keep), _full, "ids array<int>, decoded string")


def encoded_digests(docs: DataFrame, path: str, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """Like ``encoded``, with n_tokens, ids_sha256, decoded_sha256 for its large columns."""
    return _applied(docs, path, list(keep), _digests, "n_tokens long, ids_sha256 string, decoded_sha256 string")
