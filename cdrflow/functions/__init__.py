"""Column functions: native Spark expressions only, no Python UDFs."""

from .text import (extract_urls, field_at, join_fields, operator_from_name,
                   parse_int, parse_long, quote_regex, split_line)
from .time import (bucket_label, bucket_start, epoch_from_ntz, epoch_from_text,
                   to_timestamp, utc_wall_time)

__all__ = [
    "bucket_label", "bucket_start", "epoch_from_ntz", "epoch_from_text",
    "extract_urls", "field_at", "join_fields", "operator_from_name",
    "parse_int", "parse_long", "quote_regex", "split_line", "to_timestamp",
    "utc_wall_time",
]
