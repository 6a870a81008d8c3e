"""Fixed schemas of the data model (nothing is inferred from data)."""

from pyspark.sql import types as T

# One raw line of a log file: "[level]\tposition\tDate:yyyyMMddHHmmss".
LOG_LINE = T.StructType([T.StructField("value", T.StringType(), True)])

# A parsed log line. event_ts is ours: the time written in the content field.
LOG_RECORD = T.StructType(
    [
        T.StructField("log_level", T.StringType(), True),
        T.StructField("method", T.StringType(), True),
        T.StructField("content", T.StringType(), True),
        T.StructField("event_ts", T.TimestampType(), True),
    ]
)

# A comment message as it comes off a topic; only `value` is used.
COMMENT = T.StructType(
    [
        T.StructField("key", T.StringType(), True),
        T.StructField("value", T.StringType(), True),
        T.StructField("partition", T.IntegerType(), True),
        T.StructField("offset", T.LongType(), True),
        T.StructField("timestamp", T.TimestampType(), True),
    ]
)

# User dictionary rows.
USER_WORD = T.StructType(
    [
        T.StructField("id", T.IntegerType(), True),
        T.StructField("word", T.StringType(), False),
        T.StructField("add_time", T.TimestampType(), True),
    ]
)

# Body of a segmentation service response.
SERVICE_RESPONSE = "ret INT, msg STRING, terms STRING"

# One contribution of a micro-batch to the monthly word counts.
CONTRIBUTION = T.StructType(
    [
        T.StructField("word", T.StringType(), False),
        T.StructField("date", T.DateType(), False),
        T.StructField("count", T.LongType(), False),
        T.StructField("month", T.StringType(), False),
        T.StructField("batch_id", T.LongType(), False),
    ]
)

# Driver-generated tables used as inputs.
EVENTS = T.StructType(
    [
        T.StructField("event_id", T.LongType(), True),
        T.StructField("ts", T.TimestampNTZType(), True),
        T.StructField("user_id", T.LongType(), True),
        T.StructField("event_type", T.StringType(), True),
        T.StructField("value", T.DoubleType(), True),
        T.StructField("props", T.StringType(), True),
    ]
)

DOCUMENTS = T.StructType(
    [
        T.StructField("doc_id", T.LongType(), True),
        T.StructField("text", T.StringType(), True),
        T.StructField("lang", T.StringType(), True),
        T.StructField("source", T.StringType(), True),
        T.StructField("n_chars", T.LongType(), True),
    ]
)
