"""Secret scans with corpus-wide ownership, in native column expressions.

Each text is searched for candidate secrets. How many distinct owners and
repositories hold a candidate's hash tells a widely copied example from a
live-looking credential of one owner.

Scale. The scan is one pass; only candidates (row, hash, owner, repository)
are shuffled, and counted per (hash, owner) before per hash, so an example
that a third of all documents copy is one row per task and owner.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .native import let
from .store import stored

# Fixed values: (kind, pattern, group that is the secret, its least length, quick test).
KINDS = [
    ("assign", r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 12,
     r"""(?i)(?:password|passwd|secret|token|api_?key)["']?\x20*[:=]"""),
    ("access", r"AKIA[A-Z0-9]+", 0, 18, r"AKIA[A-Z0-9]{14}"),
    ("hex", r"[0-9a-f]+", 0, 16, r"[0-9a-f]{16}"),
    ("github", r"gh[pousr]_[A-Za-z0-9]{36,}", 0, 40, r"gh[pousr]_[A-Za-z0-9]{36}"),
    ("jwt", r"eyJ[A-Za-z0-9_-]{10,}\.[A-Za-z0-9_-]{10,}\.[A-Za-z0-9_-]{10,}", 0, 35, r"eyJ[A-Za-z0-9_-]{10}"),
    ("slack", r"xox[abprs]-[A-Za-z0-9-]{10,}", 0, 15, r"xox[abprs]-"),
    ("private_key", r"-----BEGIN [A-Z ]*PRIVATE KEY-----", 0, 27, r"PRIVATE KEY-----"),
]
BASE = ("assign", "access", "hex")
EXAMPLE_OWNERS = 3   # a secret of so many owners is a copied example

SPAN = "struct<start:long,place:int,kind:string,end:long,hash:string>"


def _found(text: Column, place: int) -> Column:
    """Spans of one kind: the pieces between matches and the matches' lengths give the places."""
    kind, pattern, group, least, quick = KINDS[place]
    # Runs of one class: a shorter run can't hold a match, so the bound may be in the pattern.
    pattern = {"hex": r"[0-9a-f]{16,}", "access": r"AKIA[A-Z0-9]{14,}"}.get(kind, pattern)
    none = F.array().cast(f"array<{SPAN}>")

    def spans(whole: Column, between: Column, secret: Column) -> Column:
        def step(a: Column, i: Column) -> Column:
            start = a["at"] + F.length(F.get(between, i))
            end = start + F.length(F.get(whole, i))
            value = F.get(secret, i)
            span = F.struct(start.alias("start"), F.lit(place).alias("place"), F.lit(kind).alias("kind"), end.alias("end"),
                            F.sha2(value, 256).alias("hash"))
            more = F.when(F.length(value) >= least, F.concat(a["spans"], F.array(span))).otherwise(a["spans"])
            return F.struct(end.alias("at"), more.alias("spans"))
        zero = F.struct(F.lit(0).cast("long").alias("at"), none.alias("spans"))
        return F.aggregate(F.sequence(F.lit(0), F.size(whole) - 1), zero, step)["spans"]

    def of(whole: Column) -> Column:
        secret = F.regexp_extract_all(text, F.lit(pattern), group) if group else whole
        return F.when(F.size(whole) > 0, let(F.split(text, pattern), lambda b: let(secret, lambda s: spans(whole, b, s)))).otherwise(none)

    return F.when(text.rlike(quick), let(F.regexp_extract_all(text, F.lit(pattern), 0), of)).otherwise(none)


def secrets(docs: DataFrame, repository: str = "doc_id", owner: str = "source") -> DataFrame:
    """doc_id, spans (start, kind, end, hash, owners, repositories, example) per row of ``docs``.

    Places are code points, end exclusive; spans are ordered by start, then by
    kind as listed. owners and repositories count the distinct values of those
    columns (a repository belongs to its owner) that hold the same secret;
    example is true from EXAMPLE_OWNERS owners on. A null owner or repository
    counts as one unknown value. A null text counts as empty and has no spans.
    Repeated rows are returned each; an empty table gives an empty result.
    Other columns are not read.
    """
    t = F.coalesce(F.col("text").cast("string"), F.lit(""))
    scan = docs.select(
        "doc_id", F.coalesce(F.col(repository).cast("string"), F.lit("")).alias("repository"),
        F.coalesce(F.col(owner).cast("string"), F.lit("")).alias("owner"),
        F.array_sort(F.concat(*(_found(t, i) for i in range(len(KINDS))))).alias("spans"))
    scan = stored(scan.withColumn("row", F.monotonically_increasing_id()), "secrets-scan")
    spans = scan.filter(F.size("spans") > 0).select("row", "repository", "owner", F.explode("spans").alias("s"))
    held = spans.select("row", "repository", "owner", F.col("s.hash").alias("hash")).distinct()
    wide = (held.groupBy("hash", "owner").agg(F.count_distinct("repository").alias("n"))
            .groupBy("hash").agg(F.count(F.lit(1)).alias("owners"), F.sum("n").alias("repositories")))
    known = (spans.join(wide, F.col("s.hash") == F.col("hash"))
             .groupBy("row").agg(F.array_sort(F.collect_list(F.struct(
                 "s.start", "s.place", "s.kind", "s.end", "s.hash", "owners", "repositories",
                 (F.col("owners") >= EXAMPLE_OWNERS).alias("example")))).alias("found")))
    none = F.array().cast(known.schema["found"].dataType)
    return scan.join(known, "row", "left").select("doc_id", F.coalesce("found", none).alias("spans"))


def digest(found: DataFrame) -> DataFrame:
    """The contract's columns from ``secrets``'s, and how many spans look live."""
    def count(kind: str) -> Column:
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    def joined(spans: Column) -> Column:
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")

    base = F.filter("spans", lambda s: s["kind"].isin(*BASE))
    return found.select(
        "doc_id", *map(count, BASE), F.sha2(joined(base), 256).alias("base_sha256"), joined(F.col("spans")).alias("spans"),
        F.size(F.filter("spans", lambda s: s["example"])).cast("long").alias("n_example"),
        F.size(F.filter("spans", lambda s: ~s["example"])).cast("long").alias("n_live"))
