"""The fact table: column names, types and natural key."""

from __future__ import annotations

from pyspark.sql import types as T

# Names and types of the columns, and which of them make the key.
NATURAL_KEY = ("date", "platform", "account", "campaign", "country", "device")
MEASURES = ("spend", "clicks", "impressions", "conversions")
COUNTERS = ("clicks", "impressions", "conversions")
PROVENANCE = ("load_date", "source_file_name")

# Columns every input file must carry, by header name.
FILE_COLUMNS = NATURAL_KEY + MEASURES

ADS_SPEND_SCHEMA = T.StructType(
    [
        T.StructField("date", T.DateType()),
        T.StructField("platform", T.StringType()),
        T.StructField("account", T.StringType()),
        T.StructField("campaign", T.StringType()),
        T.StructField("country", T.StringType()),
        T.StructField("device", T.StringType()),
        T.StructField("spend", T.DoubleType()),
        T.StructField("clicks", T.IntegerType()),
        T.StructField("impressions", T.IntegerType()),
        T.StructField("conversions", T.IntegerType()),
        T.StructField("load_date", T.TimestampNTZType()),
        T.StructField("source_file_name", T.StringType()),
    ]
)

FACT_COLUMNS = tuple(ADS_SPEND_SCHEMA.names)

# Position of a row in its input. Internal: orders rows that are otherwise tied and is
# dropped from everything handed to the user.
SEQ = "_seq"

DEFAULT_SOURCE_NAME = "ads_spend.csv"
