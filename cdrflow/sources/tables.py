"""Parquet tables of a warehouse folder: catalog, records, dictionaries, outputs
(S05, S06, S08-S11).

All writes happen on executors. Record outputs are partitioned by
``dc``, ``datatype`` and ``batch_id`` and written with dynamic partition
overwrite; folders of the batch that the new result doesn't have are removed,
so re-running a batch replaces exactly that batch. Dictionaries are appended
(:mod:`.dictionary`); re-running a batch adds nothing because known keys are
excluded before ids are given. Partition values are text, but for ``batch_id``.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.utils import AnalysisException

from ..session import text_partitions


@dataclass(frozen=True)
class Warehouse:
    root: str

    @property
    def formats(self) -> str:
        return f"{self.root}/formats"

    @property
    def format_fields(self) -> str:
        return f"{self.root}/format_fields"

    @property
    def format_problems(self) -> str:
        return f"{self.root}/format_problems"

    @property
    def ingested(self) -> str:
        return f"{self.root}/ingested"

    @property
    def finished(self) -> str:
        return f"{self.root}/finished_batches"

    @property
    def batches(self) -> str:
        return f"{self.root}/batch_log"

    @property
    def parsed_with(self) -> str:
        return f"{self.root}/parsed_with"

    @property
    def stuck(self) -> str:
        return f"{self.root}/stuck_batches"

    @property
    def records(self) -> str:
        return f"{self.root}/cdr"

    @property
    def dim_user(self) -> str:
        return f"{self.root}/dim_user"

    @property
    def dim_page(self) -> str:
        return f"{self.root}/dim_page"

    @property
    def enriched(self) -> str:
        return f"{self.root}/enriched_cdr"

    @property
    def usage(self) -> str:
        return f"{self.root}/usage_hourly"

    @property
    def text(self) -> str:
        return f"{self.root}/out"


#: What Spark says of a path without a table, or without a file in it.
_MISSING = ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA")


def read_or_empty(spark: SparkSession, path: str, schema) -> DataFrame:
    """A Parquet table, or an empty frame of ``schema`` when it does not exist yet."""
    text_partitions(spark)
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as e:
        if e.getCondition() not in _MISSING:  # a table that can't be read isn't an empty one
            raise
        return spark.createDataFrame([], schema)


def read_table(spark: SparkSession, path: str) -> DataFrame | None:
    text_partitions(spark)
    try:
        df = spark.read.parquet(path)
    except AnalysisException as e:
        if e.getCondition() not in _MISSING:
            raise
        return None
    return df.withColumn("batch_id", F.col("batch_id").cast("bigint")) if "batch_id" in df.columns else df


def read_batch(spark: SparkSession, path: str, partition_by: list[str], batch_id: int, schema) -> DataFrame:
    """The rows of one batch: only its own folders are listed. Empty when it has none."""
    text_partitions(spark)
    levels = ["*"] * partition_by.index("batch_id")
    try:
        return (spark.read.schema(schema).option("basePath", path)
                .parquet("/".join([path, *levels, f"batch_id={batch_id}"])))
    except AnalysisException as e:
        if e.getCondition() not in _MISSING:
            raise
        return spark.createDataFrame([], schema)


def _batch_folders(spark: SparkSession, path: str, partition_by: list[str], batch_id: int) -> tuple:
    """(file system, {folder: names of its files}) of one batch of a table."""
    jvm = spark.sparkContext._jvm
    levels = ["*"] * partition_by.index("batch_id")
    pattern = jvm.org.apache.hadoop.fs.Path("/".join([path, *levels, f"batch_id={batch_id}"]))
    fs = pattern.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    found = fs.globStatus(pattern) or []
    return fs, {f.getPath(): {x.getPath().getName() for x in fs.listStatus(f.getPath())} for f in found}


def write_batch(df: DataFrame, path: str, partition_by: list[str], batch_id: int, form: str = "parquet") -> None:
    """Replace all that ``path`` holds of ``batch_id`` with ``df``: partitions of
    the batch that ``df`` doesn't have are removed, also when it is empty."""
    fs, before = _batch_folders(df.sparkSession, path, partition_by, batch_id)
    (df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy(*partition_by).format(form).save(path))
    _, after = _batch_folders(df.sparkSession, path, partition_by, batch_id)
    for folder, names in after.items():
        if names & before.get(folder, set()):  # not written anew
            fs.delete(folder, True)


def append(df: DataFrame, path: str, partition_by: list[str] | None = None) -> None:
    w = df.write.mode("append")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)


def dim_user(spark: SparkSession, wh: Warehouse) -> DataFrame:
    """All subscribers with their ids, as committed now."""
    from .dictionary import users  # which builds on this module
    return users(spark, wh).rows()


def dim_page(spark: SparkSession, wh: Warehouse) -> DataFrame:
    """All pages with their ids, as committed now."""
    from .dictionary import pages
    return pages(spark, wh).rows()


def import_text_dim_user(spark: SparkSession, path: str, dc: str | None = None) -> DataFrame:
    """Legacy user dictionary text ``id;dc;op;msisdn;imsi;imei``.

    Fields are split with a limit, so empty trailing fields are kept; the
    data centre is the line's own unless ``dc`` is given.
    """
    parts = F.split(F.col("value"), ";", 6)
    return (spark.read.text(path)
            .where(F.length("value") > 0)
            .select((F.lit(dc) if dc else F.get(parts, 1)).alias("dc"),
                    F.get(parts, 0).try_cast("bigint").alias("user_id"),
                    *[F.coalesce(F.get(parts, i), F.lit("")).alias(n)
                      for i, n in ((2, "op"), (3, "msisdn"), (4, "imsi"), (5, "imei"))],
                    F.lit(-1).cast("bigint").alias("batch_id")))


def import_text_dim_page(spark: SparkSession, path: str, dc: str | None = None) -> DataFrame:
    """Legacy page dictionary text ``id;url`` (S09); a ';' inside a URL survives.

    The data centre is ``dc`` or the folder above ``page/``.
    """
    parts = F.split(F.col("value"), ";", 2)
    dc_col = F.lit(dc) if dc else F.regexp_extract(F.col("_metadata.file_path"), r"/([^/]+)/page/[^/]+$", 1)
    return (spark.read.text(path)
            .where(F.length("value") > 0)
            .select(dc_col.alias("dc"), F.get(parts, 0).try_cast("bigint").alias("page_id"),
                    F.get(parts, 1).alias("url"), F.lit(-1).cast("bigint").alias("batch_id")))
