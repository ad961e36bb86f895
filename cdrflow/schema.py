"""Fixed values and table schemas of the CDR model.

The values under "Fixed values" must stay exactly as they are: the
standard layout, file-name patterns and the page-URL pattern decide
which rows and pages are found, so results only agree with the
original job when these agree.
"""

from __future__ import annotations

from pyspark.sql import types as T

# ---------------------------------------------------------------------------
# Fixed values (must equal the original job's values for equal results)
# ---------------------------------------------------------------------------

# The 16 columns of a standard CDR row, in order.
TARGET_FIELDS = [
    "from", "op", "msisdn", "imsi", "imei",
    "subscription", "language", "session_time", "service_code",
    "bearer", "page_sent", "duration",
    "vlr_number", "session_end", "action_url", "extra",
]

# A page URL inside ``action_url``: stops at a comma, a line end or '?'.
URL_PATTERN = r"(file:[^\,\r\n?]+|https?:[^\,\r\n?]+)"

# Operator from a data file name, e.g. CDR_alphanet_20240305_101500_gw7_0012.
DATA_FILE_PATTERN = r"CDR_(.*)_\d{8}_\d{6}"

# Operator from a format descriptor name, e.g. data_format-x-alphanet-2024.properties.
FORMAT_FILE_PATTERN = r"^data_format-.*-(.*)-.*\.properties$"

# Descriptor keys.
FORMAT_START_KEY = "format_start_date_time"
FORMAT_FIELDS_KEY = "fields"
FORMAT_DELIMITER_KEY = "delimiter"
DEFAULT_DELIMITER = ";"
# Seconds, not fractions: the start "07:08:09" means 9 seconds.
FORMAT_START_PATTERN = "yyyy-MM-dd HH:mm:ss"

# ---------------------------------------------------------------------------
# Our own model
# ---------------------------------------------------------------------------

# Identity of a subscriber; ids are dense per data centre.
USER_KEY = ["dc", "op", "msisdn", "imsi", "imei"]
PAGE_KEY = ["dc", "url"]

# Standard columns that aren't text.
EPOCH_TARGET = "session_time"
URL_TARGET = "action_url"

# Source fields read from the line (``from``/``op`` come from the path).
LINE_FIELDS = TARGET_FIELDS[2:]

# Data type of lines whose file lies at another depth than <root>/<dc>/<datatype>/.
UNPLACED = "_unplaced"

DESCRIPTOR_FIELDS_SCHEMA = T.StructType([
    T.StructField("fields", T.ArrayType(T.StructType([
        T.StructField("name", T.StringType()),
        T.StructField("type", T.StringType()),
        T.StructField("format", T.StringType()),
    ]))),
])

DIM_USER_SCHEMA = T.StructType([
    T.StructField("dc", T.StringType()),
    T.StructField("user_id", T.LongType()),
    T.StructField("op", T.StringType()),
    T.StructField("msisdn", T.StringType()),
    T.StructField("imsi", T.StringType()),
    T.StructField("imei", T.StringType()),
    T.StructField("batch_id", T.LongType()),
])

DIM_PAGE_SCHEMA = T.StructType([
    T.StructField("dc", T.StringType()),
    T.StructField("page_id", T.LongType()),
    T.StructField("url", T.StringType()),
    T.StructField("batch_id", T.LongType()),
])

# Columns of an enriched row (5 identity columns collapse into user_id).
ENRICHED_FIELDS = [
    "user_id", "subscription", "language", "session_time", "service_code",
    "bearer", "page_sent", "duration", "vlr_number", "session_end",
    "page_ids", "extra",
]
