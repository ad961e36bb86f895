"""Landing files: CDR data lines with their data centre, type and operator
(S01, S02, S03, S07, G01, P01, P04).

Layout: ``<root>/<dc>/<datatype>/CDR_<op>_<yyyyMMdd>_<HHmmss>_<host>_<seq>``.
All folders are read by one splittable line scan. Every file but the
``.properties`` descriptors is data: a file whose name carries no operator,
or that lies at another depth, is read too, and its lines are quarantined.
Landings written by another Spark job can instead use partition folders
``<root>/dc=<dc>/datatype=<datatype>/op=<op>/``, found by partition discovery.
"""

from __future__ import annotations

import re
from urllib.parse import quote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.utils import AnalysisException

from ..operators.partitioning import spread
from ..schema import DATA_FILE_PATTERN, UNPLACED
from ..session import text_partitions

DESCRIPTOR_SUFFIX = ".properties"


def plain_path(path: str) -> str:
    """A path or URI without its scheme, as file paths of a scan show it."""
    return "/" + re.sub(r"^[a-zA-Z][a-zA-Z0-9+.-]*:/*", "", quote(path, safe="/:=+,;@&$!*'()~%")).strip("/")


def place_of(path: Column, root: str | None) -> Column:
    """Folders and name of a file below ``root``, or of its last three steps without one."""
    plain = F.concat(F.lit("/"), F.regexp_replace(path, r"^(?:[a-zA-Z][a-zA-Z0-9+.-]*:)?/*", ""))
    if root is None:
        return F.slice(F.split(plain, "/"), -3, 3)
    base = plain_path(root).rstrip("/") + "/"
    return F.when(plain.startswith(base), F.split(F.substr(plain, F.lit(len(base) + 1)), "/"))


def dc_of(place: Column) -> Column:
    return F.when(F.size(place) > 1, F.get(place, 0)).otherwise(F.lit(UNPLACED))


def datatype_of(place: Column) -> Column:
    return F.when(F.size(place) == 3, F.get(place, 1)).otherwise(F.lit(UNPLACED))


def file_name_of(path: Column) -> Column:
    return F.substring_index(path, "/", -1)


def is_data(path: Column) -> Column:
    return ~path.endswith(DESCRIPTOR_SUFFIX)


def tag_lines(raw: DataFrame, batch_id: int | Column, root: str | None = None, number: bool = True) -> DataFrame:
    """Tag raw lines (``line``, ``source_file``) with dc, datatype, op, batch.

    Blank lines are dropped and a trailing CR is removed. ``row_id`` is
    unique within the batch. ``dc``, ``datatype`` and ``op`` columns already
    present (partition folders) are kept; otherwise they come from the path
    below ``root``. A file at another depth gets the data type ``_unplaced``.
    A stream can't number rows over its batches: without ``number`` all are 0.

    A path's parts are a projection of their own, so each is worked out once a line.
    """
    bid = F.lit(batch_id).cast("bigint") if isinstance(batch_id, int) else batch_id.cast("bigint")
    line = F.regexp_replace(F.col("line"), "\r$", "")
    parts = {"_place": place_of(F.col("source_file"), root),
             "_op": F.regexp_extract(file_name_of(F.col("source_file")), DATA_FILE_PATTERN, 1)}
    from_path = {
        "dc": dc_of(F.col("_place")),
        "datatype": datatype_of(F.col("_place")),
        "op": F.when(F.col("_op") != "", F.col("_op")),
    }
    tags = {k: (F.col(k).cast("string") if k in raw.columns else v) for k, v in from_path.items()}
    return (raw
            .withColumn("line", line)
            .where(F.length("line") > 0)
            .withColumns(parts).withColumns(tags).drop(*parts)
            .withColumn("batch_id", bid)
            .withColumn("row_id", F.monotonically_increasing_id() if number else F.lit(0).cast("bigint")))


def _lines(df: DataFrame, *more: Column) -> DataFrame:
    return (df.select(F.col("value").alias("line"), F.col("_metadata.file_path").alias("source_file"), *more)
            .where(is_data(F.col("source_file"))))


def read_raw_lines(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """Untagged lines with their file path, from folders or files."""
    return _lines(spark.read.option("recursiveFileLookup", "true").text(paths))


def read_partitioned_lines(spark: SparkSession, root: str) -> DataFrame:
    """Untagged lines of a ``dc=/datatype=/op=`` partitioned landing, with
    those three as columns (partition discovery, all text)."""
    text_partitions(spark)
    df = spark.read.text(root)
    return _lines(df, *[F.col(c).cast("string").alias(c) for c in ("dc", "datatype", "op") if c in df.columns])


def literal_path(path: str) -> str:
    """``path`` for a reader that takes patterns: only the file of that name."""
    return re.sub(r"([\\\[\]{}*?])", r"\\\1", path)


def list_files(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """(path, source_file, length, modified) of the data files under ``paths``; contents
    aren't read. ``source_file`` is the path as a line's scan shows it. A
    folder that isn't there has no files."""
    try:
        files = (spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(paths)
                 .select("path", F.col("_metadata.file_path").alias("source_file"), "length",
                         F.unix_millis("modificationTime").alias("modified")))
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], "path string, source_file string, length bigint, modified bigint")
    return files.where(is_data(F.col("path")))


def read_files(spark: SparkSession, files: list[str]) -> DataFrame:
    """Untagged lines of just these files, whatever letters their names have."""
    if not files:
        return spark.createDataFrame([], "line string, source_file string")
    return _lines(spark.read.text([literal_path(f) for f in files]))


def identities(lines: DataFrame, root: str | None) -> DataFrame:
    """(source_file, name, content) per file of untagged lines: its place and name
    below ``root``, and a fingerprint of its lines, whatever their order.

    One pass and one small aggregation, partial per task: a large file is no group.
    """
    line = F.col("line")
    return (lines.groupBy("source_file")
            .agg(F.concat_ws(":", F.count(F.lit(1)).cast("string"), F.sum(F.length(line)).cast("string"),
                             F.sum(F.xxhash64(line).cast("decimal(38,0)")).cast("string"),
                             F.sum(F.xxhash64(line, F.lit(1)).cast("decimal(38,0)")).cast("string")).alias("content"))
            .select("source_file", F.coalesce(F.array_join(place_of(F.col("source_file"), root), "/"), F.col("source_file")).alias("name"), "content"))


def read_landing(spark: SparkSession, root: str | list[str], batch_id: int,
                 partitioned: bool = False, tag_root: str | None = None) -> DataFrame:
    """Tagged data lines of every (dc, datatype) folder under ``root``.

    Text files are split by size; a few large compressed (unsplittable)
    files are spread over the cores before the CPU-heavy parsing.
    """
    raw = read_partitioned_lines(spark, root) if partitioned else read_raw_lines(spark, root)
    return tag_lines(spread(raw), batch_id, tag_root or (root if isinstance(root, str) else None))
