"""cdrflow: session-record (CDR) processing on Spark.

Delimited record files from many data centres and operators are read,
each line is parsed through the format version valid at its session time
into one typed standard table (bad lines are kept aside with a reason),
subscribers and pages get stable dense ids, and usage is counted.
"""

__version__ = "0.1.0"
