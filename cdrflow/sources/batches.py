"""Which batches are whole.

A batch writes several outputs: records, enriched rows, their text, usage. It is
opened before the first and closed after the last, as commits of one log that
batches and streams share. A commit holds the closed batches so far, as ranges
of ids, so a reader needs the newest one only. What it reads is restricted to
these batches; a batch that was broken off, or is being run again, is not seen
in any output.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import tables
from .commits import CommitLog
from .tables import Warehouse


def _ranges(ids: list[list[int]]) -> list[list[int]]:
    """Ranges of ids, first to last, in order and joined where they meet."""
    out: list[list[int]] = []
    for first, last in sorted(ids):
        if out and first <= out[-1][1] + 1:
            out[-1][1] = max(out[-1][1], last)
        else:
            out.append([first, last])
    return out


def _without(ranges: list[list[int]], batch_id: int) -> list[list[int]]:
    parts = ([[first, batch_id - 1], [batch_id + 1, last]] if first <= batch_id <= last else [[first, last]]
             for first, last in ranges)
    return [r for p in parts for r in p if r[0] <= r[1]]


class Batches:
    """The batches of a warehouse."""

    def __init__(self, spark: SparkSession, wh: Warehouse) -> None:
        self.spark, self.wh, self.log = spark, wh, CommitLog(spark, wh.batches)

    def _state(self) -> tuple[int, dict]:
        n = self.log.last()
        if n:
            return n, self.log.read(n)
        # a warehouse from before there was a log
        old = tables.read_or_empty(self.spark, self.wh.finished, "batch_id bigint").distinct().collect()
        return 0, {"done": _ranges([[r[0], r[0]] for r in old]), "open": []}

    def _change(self, batch_id: int, done: bool) -> None:
        while True:
            n, state = self._state()
            rest = _without(state["done"], batch_id)
            still = [b for b in state["open"] if b != batch_id]
            new = {"done": _ranges([*rest, [batch_id, batch_id]]) if done else rest, "open": still if done else sorted([*still, batch_id])}
            if self.log.put(n + 1, new):
                return

    def open(self, batch_id: int) -> None:
        """From here on ``batch_id`` is not whole."""
        self._change(batch_id, False)

    def close(self, batch_id: int) -> None:
        """All outputs of ``batch_id`` are written."""
        self._change(batch_id, True)

    def unfinished(self) -> list[int]:
        return self._state()[1]["open"]

    def whole(self, batch_id: Column | str = "batch_id") -> Column:
        """Condition: the row's batch is whole. On a partition column it prunes folders."""
        c = F.col(batch_id) if isinstance(batch_id, str) else batch_id
        ranges = self._state()[1]["done"]
        return reduce(lambda a, b: a | b, (c.between(first, last) for first, last in ranges), F.lit(False))

    def read(self, path: str) -> DataFrame | None:
        """An output's rows of whole batches; None when there is no such output yet.

        The commit is read before the files are listed: a batch that is opened in
        between isn't among those it names.
        """
        whole = self.whole()
        df = tables.read_table(self.spark, path)
        return None if df is None else df.where(whole)
