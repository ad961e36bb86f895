"""Subscriber and page dictionaries with several writers and a compact form
(S10, U01, W01, W02, T03).

A dictionary grows by numbered commits. A writer works out the keys that are
unknown as of the commits it has seen, writes their rows with ids that continue
the last commit's highest ones to a staged folder, and claims the next commit
number (:class:`~.commits.CommitLog`). If another writer was first, it reads
that commit, drops the keys it brought, numbers the rest anew, and tries the
next number. So ids stay dense and unique per data centre and no key is given
two. Claim and range are one file: a writer that dies before it leaves rows that
nobody sees, and one that dies after it has committed: whoever reads the
dictionary next puts the rows in their place.

``<root>/commit=<n>/dc=<dc>/`` holds the rows of a commit, also for readers
outside this library. :func:`compact` writes all rows up to a commit once more,
bucketed and sorted by key, so that lookups needn't shuffle the dictionary
(:mod:`..operators.lookup`), and readers needn't list earlier commits.
"""

from __future__ import annotations

import hashlib
import uuid
from dataclasses import dataclass

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators import joins
from ..operators.ids import assign_ids
from ..operators.lookup import KEY, Layers, key_text, unknown
from ..operators.staging import staged
from ..schema import DIM_PAGE_SCHEMA, DIM_USER_SCHEMA, PAGE_KEY, USER_KEY
from ..session import text_partitions
from .commits import CommitLog
from .tables import Warehouse

#: Rows of a bucket (some 100 MB), and commits after which a dictionary is compacted.
BUCKET_ROWS = 2_000_000
RECENT_COMMITS = 64


@dataclass(frozen=True)
class Snapshot:
    """A dictionary as of commit ``number``: highest id per data centre, the
    compact form (path, buckets, schema's commit) if any, and the commits after it."""

    number: int
    highest: dict[str, int]
    rows_total: int
    compact: dict | None
    commits: list[dict]


class Dictionary:
    """One dictionary of a warehouse; see :func:`users` and :func:`pages`."""

    def __init__(self, spark: SparkSession, root: str, schema: T.StructType, key: list[str], id_col: str) -> None:
        self.spark, self.root, self.schema, self.key, self.id_col = spark, root, schema, key, id_col
        self.log = CommitLog(spark, f"{root}_log/commits")
        self.compactions = CommitLog(spark, f"{root}_log/compactions")

    # Reading -------------------------------------------------------------

    def _folder(self, number: int) -> str:
        return f"{self.root}/commit={number}"

    def _published(self, commit: dict) -> str:
        """The folder of a commit's rows; moves them there if their writer didn't."""
        jvm = self.spark.sparkContext._jvm
        at, staged = (jvm.org.apache.hadoop.fs.Path(p) for p in (self._folder(commit["number"]), commit["staged"]))
        fs = at.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())
        if not fs.exists(at):
            fs.mkdirs(at.getParent())
            try:
                fs.rename(staged, at)
            except Py4JJavaError:  # another reader was quicker
                if not fs.exists(at):
                    raise
        return self._folder(commit["number"])

    def _adopt(self) -> None:
        """Make the rows of a dictionary from before there were commits the first one."""
        jvm = self.spark.sparkContext._jvm
        staged = jvm.org.apache.hadoop.fs.Path(f"{self.root}_log/staged-adopted")
        fs = staged.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())
        for found in fs.globStatus(jvm.org.apache.hadoop.fs.Path(f"{self.root}/dc=*")) or []:
            fs.mkdirs(staged)
            fs.rename(found.getPath(), jvm.org.apache.hadoop.fs.Path(staged, found.getPath().getName()))
        if fs.exists(staged):
            self._put(str(staged.toString()), Snapshot(0, {}, 0, None, []))

    def snapshot(self) -> Snapshot:
        """The dictionary as of now; reads only commits after the last compaction."""
        done = self.compactions.last()
        compact = self.compactions.read(done) if done else None
        first = compact["commit"] if compact else 0
        numbers = self.log.numbers(first)
        if not numbers and not first:
            self._adopt()
            numbers = self.log.numbers()
        commits = [self.log.read(n) for n in numbers]
        highest, total = (compact["highest"], compact["rows"]) if compact else ({}, 0)
        if commits:
            highest, total = commits[-1]["highest"], commits[-1]["rows_total"]
        return Snapshot(numbers[-1] if numbers else first, highest, total, compact, commits)

    def _rows_of(self, commits: list[dict]) -> DataFrame:
        """Rows of some commits."""
        paths = [self._published(c) for c in commits if c["rows"]]
        if not paths:
            return self.spark.createDataFrame([], self.schema)
        text_partitions(self.spark)
        return (self.spark.read.schema(self.schema).option("basePath", self.root).parquet(*paths)
                .select(*self.schema.names))

    def _table(self, compact: dict) -> DataFrame:
        """The compact form, as a table that knows its buckets."""
        name = "cdr_dim_" + hashlib.sha256(compact["path"].encode()).hexdigest()[:24]
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in self._compact_schema().fields)
        self.spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({columns}) USING parquet CLUSTERED BY ({KEY}) SORTED BY ({KEY}) "
                       f"INTO {compact['buckets']} BUCKETS LOCATION '{compact['path']}'")
        return self.spark.table(name)

    def _compact_schema(self) -> T.StructType:
        return T.StructType([T.StructField(KEY, T.StringType()), *self.schema.fields])

    def layers(self, at: Snapshot | None = None) -> Layers:
        """All rows, and where there is a compact form its base and the recent rest.

        Recent rows that are too many for a broadcast are compacted first, unless
        the whole dictionary can be broadcast.
        """
        at = at or self.snapshot()
        recent = self._rows_of(at.commits)
        if at.compact is None and at.rows_total <= joins.BROADCAST_MAX_ROWS:
            return Layers(recent)
        many = sum(c["rows"] for c in at.commits) > joins.BROADCAST_MAX_ROWS or len(at.commits) > RECENT_COMMITS
        if many or (at.commits and not joins.fits_broadcast(recent)):
            return self.layers(self.compact())
        base = self._table(at.compact)
        return Layers(base.select(*self.schema.names).unionByName(recent), base, recent)

    def rows(self, at: Snapshot | None = None) -> DataFrame:
        """All rows that are committed, now or as of ``at``."""
        at = at or self.snapshot()
        recent = self._rows_of(at.commits)
        return recent if at.compact is None else self._table(at.compact).select(*self.schema.names).unionByName(recent)

    # Writing -------------------------------------------------------------

    def commit(self, rows: DataFrame, at: Snapshot) -> bool:
        """Append ``rows``, whose keys and ids ``at`` doesn't hold, as the commit after
        ``at``; False, and nothing is seen of them, when another writer has it."""
        path = f"{self.root}_log/staged-{uuid.uuid4().hex}"
        rows.select(*self.schema.names).write.partitionBy("dc").parquet(path)
        return self._put(path, at)

    def _put(self, path: str, at: Snapshot) -> bool:
        text_partitions(self.spark)
        found = self.spark.read.schema(self.schema).parquet(path)
        # one row per data centre
        per_dc = found.groupBy("dc").agg(F.count(F.lit(1)).alias("n"), F.max(self.id_col).alias("m")).collect()
        n = sum(r["n"] for r in per_dc)
        top = dict(at.highest)
        for r in per_dc:
            top[r["dc"]] = max(top.get(r["dc"], 0), r["m"])
        commit = {"number": at.number + 1, "staged": path, "rows": n, "rows_total": at.rows_total + n, "highest": top}
        if not self.log.put(at.number + 1, commit):
            return False
        if n:
            self._published(commit)
        return True

    def extend(self, keys: DataFrame, batch_id: int, at: Snapshot | None = None) -> int:
        """Give the distinct ``keys`` that are unknown the next ids; the number of them.

        ``at`` is the state the caller has seen, by default the current one.
        Keys are compared with the whole dictionary once, and after each lost race
        with the commits that came in between.
        """
        at = at or self.snapshot()
        left = staged(unknown(keys.select(*self.key), self.layers(at), self.key), "dictionary-keys")
        while True:
            n = left.count()
            if not n:
                return 0
            start = self.spark.createDataFrame(sorted(at.highest.items()), "dc string, _start bigint")
            rows = assign_ids(left, self.key, self.id_col, start, rows=n)
            if self.commit(rows.withColumn("batch_id", F.lit(batch_id).cast("bigint")), at):
                return n
            now = self.snapshot()
            between = [self.log.read(i) for i in self.log.numbers(at.number) if i <= now.number]
            left = staged(joins.anti_join(left, self._rows_of(between), self.key), "dictionary-keys")
            at = now

    def compact(self, buckets: int | None = None) -> Snapshot:
        """Write all rows once more, bucketed and sorted by key, and return the new state.

        Costs one shuffle of the dictionary, once in ``RECENT_COMMITS`` commits or
        more. Two that compact at once both finish; the later one is read.
        """
        at = self.snapshot()
        rows = self._rows_of(at.commits)
        if at.compact is not None:
            rows = self._table(at.compact).select(*self.schema.names).unionByName(rows)
        n = max(buckets or 0, int(self.spark.conf.get("spark.sql.shuffle.partitions")), at.rows_total // BUCKET_ROWS + 1)
        path = f"{self.root}_compact/{uuid.uuid4().hex}"
        name = "cdr_dim_" + hashlib.sha256(path.encode()).hexdigest()[:24]
        (rows.withColumn(KEY, key_text(self.key)).select(KEY, *self.schema.names).repartition(n, KEY)
         .write.format("parquet").option("path", path).bucketBy(n, KEY).sortBy(KEY).saveAsTable(name))
        entry = {"commit": at.number, "path": path, "buckets": n, "highest": at.highest, "rows": at.rows_total}
        while not self.compactions.put(self.compactions.last() + 1, entry):
            pass
        return self.snapshot()


def users(spark: SparkSession, wh: Warehouse) -> Dictionary:
    return Dictionary(spark, wh.dim_user, DIM_USER_SCHEMA, USER_KEY, "user_id")


def pages(spark: SparkSession, wh: Warehouse) -> Dictionary:
    return Dictionary(spark, wh.dim_page, DIM_PAGE_SCHEMA, PAGE_KEY, "page_id")
