"""Quality rules as a short-circuit cascade, in native column expressions.

A rule is a condition under which a text fails. Each rule's cost (time of a
job that evaluates it alone) and selectivity (share of texts that fail) are
measured on a bounded sample; the cascade tries rules in falling order of
rejections per cost, as one CASE whose later branches are only evaluated for
texts that passed the earlier ones. The order changes the work, not the
verdict.

Scale. One pass without a shuffle; nothing is collected but the measures.
"""

from __future__ import annotations

import statistics
import time
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .native import WORD, let, words
from .store import stored

SAMPLE_ROWS = 1_500
RUNS = 3                    # timed jobs per rule
LEAST_COST = 0.001          # seconds; below, the clock tells nothing
SYMBOLS = r"[#*$%&|<>]"
RUN = 5


def repeated_words(w: Column) -> Column:
    """Words of the array ``w`` inside RUN-word windows that occur twice or more."""
    def covered(runs: Column) -> Column:
        def starts(order: Column) -> Column:
            def again(x: Column, i: Column) -> Column:
                return (((i > 0) & (F.get(order, i - 1)["run"] == x["run"]))
                        | ((i < F.size(order) - 1) & (F.get(order, i + 1)["run"] == x["run"])))
            return F.array_sort(F.transform(F.filter(order, again), lambda x: x["at"]))

        def total(at: Column) -> Column:
            first = F.struct(F.lit(0).cast("long").alias("n"), F.lit(-RUN).alias("last"))
            return F.aggregate(at, first, lambda a, p: F.struct(
                (a["n"] + F.least(F.lit(RUN), p - a["last"])).alias("n"), p.alias("last")))["n"]

        order = F.array_sort(F.transform(runs, lambda r, i: F.struct(r.alias("run"), i.alias("at"))))
        return F.when(F.size(F.array_distinct(runs)) < F.size(runs), let(order, lambda o: let(starts(o), total))).otherwise(F.lit(0).cast("long"))

    def runs(h: Column) -> Column:
        return F.transform(F.sequence(F.lit(0), F.size(h) - RUN), lambda i: F.xxhash64(*(F.get(h, i + j) for j in range(RUN))))

    return F.when(F.size(w) > RUN, let(F.transform(w, lambda x: F.xxhash64(x)), lambda h: let(runs(h), covered))).otherwise(F.lit(0).cast("long"))


def repeated_lines(text: Column) -> Column:
    """Lines with a word that equal an earlier line."""
    return let(F.filter(F.split(text, "\n"), lambda x: x.rlike(WORD)),
               lambda v: (F.size(v) - F.size(F.array_distinct(v))).cast("long"))


def symbols(text: Column) -> Column:
    return F.regexp_count(text, F.lit(SYMBOLS)).cast("long")


def measures(text: Column) -> Column:
    """Struct of the word measures of a text: one cut into words serves them all."""
    return let(words(text), lambda w: F.struct(
        F.size(w).cast("long").alias("n_words"), F.length(F.array_join(w, "")).cast("long").alias("word_chars"),
        repeated_words(w).alias("n_repeat_words")))


@dataclass(frozen=True)
class Rule:
    name: str
    fails: Column


def default_rules(text: str = "text") -> list[Rule]:
    """Rules on a text column alone; every one is false for an unusual but readable text."""
    t = F.coalesce(F.col(text).cast("string"), F.lit(""))
    letters = F.regexp_count(t, F.lit(r"[A-Za-z]"))
    return [
        Rule("few_words", F.regexp_count(t, F.lit(WORD)) < 10),
        Rule("repeated_words", let(words(t), lambda w: 100 * repeated_words(w) > 20 * F.size(w))),
        Rule("symbols", 10 * symbols(t) > 3 * F.regexp_count(t, F.lit(WORD))),
        Rule("word_length", let(words(t), lambda w: F.length(F.array_join(w, "")) > 15 * F.size(w))),
        Rule("repeated_lines", 10 * repeated_lines(t) > 3 * F.size(F.split(t, "\n"))),
        Rule("capitals", 10 * F.regexp_count(t, F.lit(r"[A-Z]")) > 4 * letters),
        Rule("exclamations", 10 * F.regexp_count(t, F.lit("!")) > 3 * F.regexp_count(t, F.lit(WORD))),
    ]


@dataclass(frozen=True)
class Estimate:
    rule: Rule
    seconds: float
    rejected: float


def estimate(docs: DataFrame, rules: list[Rule], sample_rows: int = SAMPLE_ROWS) -> list[Estimate]:
    """Rules in falling order of rejections per cost on about ``sample_rows`` rows.

    A rule's cost is the median of RUNS timed jobs less that of jobs that only
    count the sample, LEAST_COST at least: a job's own overhead is as long as a cheap rule.
    The sample is a random share of all rows; without rows the order is that given.
    """
    total = docs.count()
    if not total:
        return [Estimate(r, 0.0, 0.0) for r in rules]
    sample = stored(docs.sample(min(1.0, sample_rows / total), seed=11), "rules-sample")
    shares = sample.agg(*(F.coalesce(F.avg(r.fails.cast("int")), F.lit(0.0)).alias(f"s{i}") for i, r in enumerate(rules))).first()

    def seconds(value: Column) -> float:
        times = []
        for _ in range(RUNS):
            began = time.perf_counter()
            sample.agg(F.sum(value)).collect()
            times.append(time.perf_counter() - began)
        return statistics.median(times)

    # The text is read for this one too.
    empty = seconds(F.col("text").isNull().cast("int"))
    found = [Estimate(r, max(seconds(r.fails.cast("int")) - empty, LEAST_COST), float(shares[i])) for i, r in enumerate(rules)]
    return sorted(found, key=lambda e: -e.rejected / e.seconds)


def cascade(order: list[Estimate]) -> Column:
    """The first rule that fails, in the given order; null when all pass."""
    out = F.lit(None).cast("string")
    for e in reversed(order):
        out = F.when(e.rule.fails, F.lit(e.rule.name)).otherwise(out)
    return out


def judged(docs: DataFrame, rules: list[Rule] | None = None) -> DataFrame:
    """``docs`` with failed_rule: the first rule of the cascade that fails, or null.

    A null text counts as empty; an empty text has no words and fails
    few_words. Repeated rows are judged each by itself; an empty table gives
    an empty result. An existing column failed_rule is replaced.
    """
    rules = default_rules() if rules is None else rules
    order = estimate(docs.select("text"), rules)
    return docs.withColumn("failed_rule", cascade(order))


def report(docs: DataFrame) -> DataFrame:
    """The contract's columns: base measures of each text, and the verdict.

    The two base rules are decided from the measures, which are asked for
    anyway; the other rules follow in the cascade, for texts that pass.
    """
    t = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rules = default_rules()
    order = [e for e in estimate(docs.select("text"), rules) if e.rule.name not in ("few_words", "repeated_words")]
    out = docs.select("doc_id", "text", measures(t).alias("m"), symbols(t).alias("n_symbols"), repeated_lines(t).alias("n_dup_lines"))
    failed = (F.col("m.n_words") < 10) | (100 * F.col("m.n_repeat_words") > 20 * F.col("m.n_words"))
    kept = F.when(failed, F.lit(False)).otherwise(cascade(order).isNull())
    return out.select("doc_id", "m.n_words", "m.word_chars", "n_symbols", "n_dup_lines", "m.n_repeat_words",
                      failed.alias("base_failed"), kept.alias("kept"))
