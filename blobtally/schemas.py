"""Every table schema in one place (nothing is inferred from data), plus sentinels."""

from pyspark.sql.types import (
    BinaryType,
    BooleanType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
)

# Fixed values of the stored format (they must equal the original job's for the outputs to be
# interchangeable): the column names of both outputs, including the "meatRowKey" spelling, and
# the two sentinels of an all-archived file.
LONG_MAX = 9223372036854775807
ARCHIVED_EMPTY_PERCENT = -1
ARCHIVED_REMAIN_SIZE = LONG_MAX
STATUS_COLUMNS = ["file_id", "emptyPercent", "remainSize", "path", "deleted"]
META_COLUMNS = ["meatRowKey", "objectKey", "start", "length"]

# Our choices where the original depends on values held outside its source code.
DEFAULT_KEY_DELIMITER = "_"

# Raw object table: row key plus the two cells of the basic-info family, all as bytes.
RAW_OBJECTS = StructType([
    StructField("row_key", BinaryType(), False),
    StructField("uri", BinaryType(), True),
    StructField("size", BinaryType(), True),
])

# Blob index, unique on uri.
BLOB_INDEX = StructType([
    StructField("uri", StringType(), False),
    StructField("file_id", LongType(), False),
    StructField("blob_id", StringType(), True),
    StructField("start", LongType(), True),
    StructField("length", LongType(), True),
])

# File index, unique on file_id; path may be null.
FILE_INDEX = StructType([
    StructField("file_id", LongType(), False),
    StructField("path", StringType(), True),
])

# Byte length of every blob file, unique on path.
FILE_LENGTHS = StructType([
    StructField("path", StringType(), False),
    StructField("length", LongType(), True),
])

FILE_STATUS = StructType([
    StructField("file_id", LongType(), False),
    StructField("emptyPercent", IntegerType(), False),
    StructField("remainSize", LongType(), False),
    StructField("path", StringType(), True),
    StructField("deleted", BooleanType(), False),
])

FILE_META = StructType([
    StructField("meatRowKey", StringType(), False),
    StructField("objectKey", StringType(), False),
    StructField("start", LongType(), True),
    StructField("length", LongType(), True),
])

# Key-value cell: (row, family, qualifier) -> value, all bytes.
CELLS = StructType([
    StructField("row_key", BinaryType(), False),
    StructField("family", BinaryType(), False),
    StructField("qualifier", BinaryType(), False),
    StructField("value", BinaryType(), True),
])

# Output of split packing: one row per file.
SPLIT_ASSIGNMENT = StructType([
    StructField("file_id", LongType(), False),
    StructField("pack_group", LongType(), False),
    StructField("split_id", IntegerType(), False),
    StructField("remainSize", LongType(), False),
])
