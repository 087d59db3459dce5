"""Fixed schemas of the tables and streams; nothing on a stream is ever inferred."""

from pyspark.sql.types import (
    BinaryType,
    BooleanType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampType,
)

# A message as the Kafka source delivers it.
MESSAGE = StructType([
    StructField("key", BinaryType()),
    StructField("value", BinaryType()),
    StructField("topic", StringType()),
    StructField("partition", IntegerType()),
    StructField("offset", LongType()),
    StructField("timestamp", TimestampType()),
])

# A device message as it was landed from the MQTT broker.
LANDED = StructType([
    StructField("topic", StringType()),
    StructField("payload", BinaryType()),
    StructField("qos", IntegerType()),
    StructField("retained", BooleanType()),
    StructField("ts", TimestampType()),
])

# The JSON envelope around a payload; the timestamp is epoch milliseconds as text.
ENVELOPE = StructType([
    StructField("payload", StringType()),
    StructField("timestamp", StringType()),
])

# One counter increment, and the running total it adds to.
INCREMENT = StructType([
    StructField("row_key", StringType()),
    StructField("qualifier", StringType()),
    StructField("delta", LongType()),
])
TOTAL = StructType([
    StructField("row_key", StringType()),
    StructField("qualifier", StringType()),
    StructField("value", LongType()),
])

# The message that a broker keeps for a topic; an empty payload stands for a topic that was cleared.
KEPT = StructType([
    StructField("topic", StringType()),
    StructField("payload", BinaryType()),
    StructField("qos", IntegerType()),
    StructField("ts", TimestampType()),
    StructField("seq", LongType()),
])

# One version of a cell; seq breaks ties between versions of the same time.
CELL = StructType([
    StructField("row_key", StringType()),
    StructField("family", StringType()),
    StructField("qualifier", StringType()),
    StructField("value", BinaryType()),
    StructField("ts", TimestampType()),
    StructField("seq", LongType()),
])

# The document table read by position.
DOCUMENT = StructType([
    StructField("id", LongType()),
    StructField("type", StringType()),
    StructField("authors", StringType()),
    StructField("title", StringType()),
    StructField("year", IntegerType()),
])
