"""Subscriber and page dictionaries.

Keys not yet in a dictionary get the next dense ids of their data centre.
Both dictionaries are keyed on their natural key (``dc`` first): users on
``dc, op, msisdn, imsi, imei`` (missing parts as ''), pages on ``dc, url``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..schema import PAGE_KEY, USER_KEY
from .ids import assign_ids, highest_ids
from .joins import anti_join
from .staging import staged


def user_keys(std: DataFrame) -> DataFrame:
    """Distinct subscriber keys of standard rows."""
    return std.select(*[F.coalesce(F.col(k), F.lit("")).alias(k) for k in USER_KEY]).distinct()


def page_urls(std: DataFrame) -> DataFrame:
    """Distinct non-empty page URLs per data centre."""
    return (std.select("dc", F.explode("urls").alias("url"))
            .where(F.length("url") > 0)
            .distinct())


def new_users(std: DataFrame, dim_user: DataFrame, batch_id: int) -> DataFrame:
    """Dictionary rows for subscribers not yet known."""
    fresh = staged(anti_join(user_keys(std), dim_user, USER_KEY), "new-users")
    rows = assign_ids(fresh, USER_KEY, "user_id", highest_ids(dim_user, "user_id"), rows=fresh.count())
    return rows.select("dc", "user_id", *USER_KEY[1:], F.lit(batch_id).cast("bigint").alias("batch_id"))


def new_pages(std: DataFrame, dim_page: DataFrame, batch_id: int) -> DataFrame:
    """Dictionary rows for pages not yet known."""
    fresh = staged(anti_join(page_urls(std), dim_page, PAGE_KEY), "new-pages")
    rows = assign_ids(fresh, PAGE_KEY, "page_id", highest_ids(dim_page, "page_id"), rows=fresh.count())
    return rows.select("dc", "page_id", "url", F.lit(batch_id).cast("bigint").alias("batch_id"))


def extend(dim: DataFrame, new_rows: DataFrame) -> DataFrame:
    """Dictionary after appending new rows."""
    return dim.unionByName(new_rows)
