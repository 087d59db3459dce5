"""Messages on their way: topics, envelopes, keys, copies, vehicles."""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from relaybook.functions import (
    decode_text,
    envelope,
    open_envelope,
    routing,
    split_topics,
    text_bytes,
    topic_matches,
)
from relaybook.operators.messages import retained, with_header, with_kafka_topic
from relaybook.operators.placement import place, split_rejects
from relaybook.operators.subscriptions import subscribed
from relaybook.operators.vehicles import TURNS, VINS, vehicle_messages
from relaybook.plans import (
    bridge,
    count_words,
    enveloped_bridge,
    feed_vehicles,
    keep_retained,
    kept_messages,
    kept_table,
    replay_bridge,
)
from relaybook.plans.fleet import SENT
from relaybook.queries.fixtures import (
    chat_messages,
    device_topics,
    event_messages,
    landed_events,
    table,
    table_stream,
)
from relaybook.queries.registry import query, sql_words
from relaybook.session import work_dir
from relaybook.sources import read_landed, read_messages
from relaybook.sources.messages import read_files
from relaybook.schemas import MESSAGE
from relaybook.streaming.batchlog import BatchLog
from relaybook.streaming.counters import Counters
from relaybook.streaming.ledger import Ledger
from relaybook.streaming.resend import message_ids, once
from relaybook.streaming.runs import finish
from relaybook.streaming.sinks import start_messages

_TOPIC = "concat('devices/', event_type, '/', user_id)"
_KEY = "concat(event_type, '.', user_id)"
# A subscription with a subtree, a single-level wildcard and a plain topic.
_FILTERS = ["devices/click/#", "devices/+/7", "devices/purchase/12"]
_MATCH = """(event_type = 'click' OR user_id = 7 OR (event_type = 'purchase' AND user_id = 12))"""
_PARTITIONS = 12


def _envelope_sql(text: str, ts: str) -> str:
    return f"""concat('{{"payload":', to_json({text}), ',"timestamp":"', epoch_us({ts}) // 1000, '"}}')"""


@query("""
    SELECT topic, "offset", value FROM (
        SELECT 'devices' AS topic, event_id AS "offset", props AS value FROM events
        UNION ALL SELECT 'chat', turn, text FROM conversations)""")
def consume_earliest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All values of two topics from the first offset on, decoded."""
    landing = work_dir(spark, "consume_earliest")
    for messages in (
        event_messages(table(spark, sf_dir, "events")),
        chat_messages(table(spark, sf_dir, "conversations")),
    ):
        messages.write.mode("append").parquet(landing)
    found = read_messages(spark, split_topics("devices,chat"), path=landing)
    return found.select("topic", "offset", decode_text(F.col("value")).alias("value"))


@query(f"SELECT event_id, {_TOPIC} AS topic, replace({_TOPIC}, '/', '.') AS kafka_topic FROM events")
def topic_normalize(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = device_topics(table(spark, sf_dir, "events"))
    return events.transform(with_kafka_topic).select("event_id", "topic", "kafka_topic")


@query(f"SELECT event_id, replace({_TOPIC}, '/', '.') AS kafka_topic FROM events")
def header_expression(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same header, given as an expression in a string."""
    events = device_topics(table(spark, sf_dir, "events"))
    return with_header(events, "kafka_topic", "replace(topic, '/', '.')").select("event_id", "kafka_topic")


@query(f"SELECT event_id, {_envelope_sql('props', 'ts')} AS value FROM events")
def json_envelope(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events")
    return events.select("event_id", envelope(F.col("props"), F.col("ts")).alias("value"))


@query(f"SELECT doc_id, {_envelope_sql('text', 'make_timestamp(doc_id * 1000000)')} AS value FROM documents")
def json_envelope_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Long texts with line ends, quotes and letters of four languages."""
    documents = table(spark, sf_dir, "documents")
    stamp = F.timestamp_seconds("doc_id")
    return documents.select("doc_id", envelope(F.col("text"), stamp).alias("value"))


@query("""SELECT event_id, props AS payload, CAST(epoch_us(ts) // 1000 AS VARCHAR) AS "timestamp" FROM events""")
def envelope_decode(spark: SparkSession, sf_dir: str) -> DataFrame:
    wrapped = json_envelope(spark, sf_dir)
    return wrapped.select("event_id", open_envelope(F.col("value")).alias("message")).select(
        "event_id", "message.payload", "message.timestamp"
    )


@query(f"""
    SELECT event_id, {_KEY} AS "key",
           CAST(CAST(regexp_extract({_KEY}, '([^.]*)$', 1) AS INTEGER) % {_PARTITIONS} AS INTEGER) AS "partition"
    FROM events""")
def key_partition(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = device_topics(table(spark, sf_dir, "events"))
    return events.select(
        "event_id", "key", routing.key_partition(F.col("key"), _PARTITIONS).alias("partition")
    )


@query(f"""
    SELECT CAST(user_id % {_PARTITIONS} AS INTEGER) AS "partition", count(*) AS n, count(*) AS placed
    FROM events GROUP BY ALL""")
def key_partition_placed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows per number, and how many of them the move put into a partition of that number."""
    numbered = key_partition(spark, sf_dir)
    kept, _ = split_rejects(numbered)
    splits = 4
    there = (F.spark_partition_id() / splits).cast("int")
    moved = place(kept, _PARTITIONS, splits=splits, salt="event_id").select("partition", there.alias("there"))
    return moved.groupBy("partition").agg(
        F.count("*").alias("n"), F.count_if(F.col("there") == F.col("partition")).alias("placed")
    )


@query("""
    SELECT "key", count(*) AS n FROM (
        SELECT concat(lang, '.', source) AS "key" FROM documents
        UNION ALL SELECT concat(role, '.', conv_id) FROM conversations)
    WHERE NOT regexp_matches("key", '^[^.]*$|^[.][^.]*$|[.][+-]?[0-9]+$') GROUP BY "key"
    """)
def key_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Keys that end in no number, of documents, next to those of conversations, which do."""
    documents = table(spark, sf_dir, "documents").select(F.concat("lang", F.lit("."), "source").alias("key"))
    chats = chat_messages(table(spark, sf_dir, "conversations"))
    keys = documents.unionByName(chats.select(decode_text(F.col("key")).alias("key")))
    numbered = keys.withColumn("partition", routing.key_partition(F.col("key"), _PARTITIONS))
    _, rejects = split_rejects(numbered)
    return rejects.groupBy("key").agg(F.count("*").alias("n"))


@query(f"SELECT event_id, {_TOPIC} AS topic FROM events WHERE {_MATCH}")
def topic_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = device_topics(table(spark, sf_dir, "events"))
    return events.where(topic_matches(F.col("topic"), _FILTERS)).select("event_id", "topic")


@query(f"SELECT {_TOPIC} AS topic, props AS payload, 0 AS qos FROM events WHERE {_MATCH}")
def subscribe_landed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Landed device messages read back through the subscription."""
    folder = work_dir(spark, "subscribe_landed")
    landed_events(table(spark, sf_dir, "events")).write.parquet(f"{folder}/landing")
    found = read_landed(spark, f"{folder}/landing", _FILTERS)
    return found.select("topic", decode_text(F.col("payload")).alias("payload"), "qos")


@query(f"SELECT {_TOPIC} AS topic, CAST(NULL AS VARCHAR) AS \"key\", props AS value FROM events")
def bridge_plain(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A stream over landed messages of all topics, sent on as they are."""
    folder = work_dir(spark, "bridge_plain")
    landed_events(table(spark, sf_dir, "events")).write.parquet(f"{folder}/landing")
    messages = bridge(read_landed(spark, f"{folder}/landing", stream=True))
    finish(start_messages(messages, f"{folder}/checkpoint", path=f"{folder}/out"))
    return spark.read.schema(messages.schema).parquet(f"{folder}/out")


@query(f"""
    SELECT replace({_TOPIC}, '/', '.') AS topic, CAST(NULL AS VARCHAR) AS "key",
           {_envelope_sql('props', 'ts')} AS value
    FROM events""")
def bridge_publish(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A stream of device messages, renamed, wrapped and written to the message sink."""
    folder = work_dir(spark, "bridge_publish")
    landed = landed_events(table_stream(spark, sf_dir, "events"))
    messages = enveloped_bridge(landed, F.col("ts"))
    finish(start_messages(messages, f"{folder}/checkpoint", path=f"{folder}/out"))
    return spark.read.schema(messages.schema).parquet(f"{folder}/out")


@query("SELECT 'replay' AS topic, CAST(k AS VARCHAR) AS \"key\", props AS value FROM events, range(10) AS r(k)")
def replay_fanout(spark: SparkSession, sf_dir: str) -> DataFrame:
    return replay_bridge(landed_events(table(spark, sf_dir, "events")), "replay", copies=10)


@query(f"""
    SELECT 'replay' AS topic, CAST(k AS VARCHAR) AS "key", n, chars
    FROM (SELECT count(*) AS n, CAST(sum(length(payload)) AS BIGINT) AS chars
          FROM (SELECT arg_max(props, (ts, event_id)) AS payload FROM events GROUP BY event_type, user_id)),
         range(1000) AS r(k)""")
def replay_fanout_full(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The retained message of every topic, sent on in all of 1000 copies, summed up per key."""
    kept = topic_latest(spark, sf_dir).withColumn("payload", text_bytes(F.col("payload")))
    copies = replay_bridge(kept, "replay")
    return copies.groupBy("topic", "key").agg(
        F.count("*").alias("n"), F.sum(F.length("value")).alias("chars")
    )


@query("""
    SELECT 'replay' AS topic, CAST(k AS VARCHAR) AS "key", n, chars
    FROM (SELECT count(*) AS n, CAST(sum(strlen(props)) AS BIGINT) AS chars FROM events),
         range(1000) AS r(k)""")
def replay_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every message, sent on in all of 1000 copies, summed up per key."""
    copies = replay_bridge(landed_events(table(spark, sf_dir, "events")), "replay")
    return copies.groupBy("topic", "key").agg(
        F.count("*").alias("n"), F.sum(F.octet_length("value")).alias("chars")
    )


@query("""
    WITH picked AS (
        SELECT event_id, props, ts, list_extract([{vins}], CAST(event_id % 3 AS INTEGER) + 1) AS vin FROM events)
    SELECT event_id, vin, substr(vin, 15) AS topic,
           concat(vin, ' ', props, strftime(ts, '%H:%M:%S')) AS message
    FROM picked""".replace("{vins}", ", ".join(f"'{v}'" for v in VINS)))
def vehicle_message(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events")
    made = vehicle_messages(events, F.col("ts"), F.col("event_id"), line="props")
    return made.select("event_id", "vin", "topic", "message")


@query("SELECT 'test-topic' AS topic, props AS line, count(*) AS n FROM events GROUP BY props")
def vehicle_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The streamed feed; the vehicle and the clock time are cut off again, as they vary."""
    folder = work_dir(spark, "vehicle_feed")
    log = BatchLog(spark, f"{folder}/sent", SENT)
    lines = table_stream(spark, sf_dir, "events").select(F.col("props").alias("value"))
    finish(feed_vehicles(lines, f"{folder}/checkpoint", "test-topic", log=log, every=None))
    vehicle, time = "|".join(VINS[:TURNS]), "[0-9]{2}:[0-9]{2}:[0-9]{2}"
    line = F.regexp_extract("value", f"^(?:{vehicle}) (.*){time}$", 1)
    return log.read().groupBy("topic", line.alias("line")).agg(F.count("*").alias("n"))


@query(f"""
    SELECT {_TOPIC} AS topic, arg_max(props, (ts, event_id)) AS payload, 0 AS qos
    FROM events GROUP BY ALL""")
def topic_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The retained message of every topic."""
    events = table(spark, sf_dir, "events")
    kept = retained(
        device_topics(events).select(
            "topic", F.col("props").alias("payload"), F.lit(0).alias("qos"),
            F.lit(True).alias("retained"), "ts", "event_id",
        ),
        "ts", "event_id",
    )
    return kept


@query("""
    WITH asked(client, filter) AS (
        SELECT c_custkey, 'devices/+/' || c_custkey FROM customer
        UNION ALL SELECT s_suppkey, 'devices/click/' || s_suppkey FROM supplier
        UNION ALL SELECT n_nationkey, CASE n_nationkey % 5 WHEN 0 THEN '#' WHEN 1 THEN 'devices/purchase/#'
            WHEN 2 THEN '+/view/+' WHEN 3 THEN 'devices/+' ELSE 'devices/+/' || n_nationkey || '/#' END FROM nation),
    patterns AS (
        SELECT *, '^' || CASE WHEN filter = '#' THEN '.*'
            ELSE replace(replace(filter, '/#', '(/.*)?'), '+', '[^/]*') END || '$' AS pattern FROM asked),
    topics AS (SELECT DISTINCT concat('devices/', event_type, '/', user_id) AS topic FROM events),
    pairs AS (SELECT topic, client, filter FROM topics, patterns WHERE regexp_matches(topic, pattern))
    SELECT client::BIGINT AS client, filter, count(*) AS n
    FROM events JOIN pairs ON concat('devices/', event_type, '/', user_id) = pairs.topic GROUP BY ALL""")
def subscription_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Messages per subscription, with one subscription or more for every customer, supplier and nation."""
    devices, nation = F.lit("devices/"), F.col("n_nationkey")
    customers = table(spark, sf_dir, "customer").select(
        F.col("c_custkey").cast("bigint").alias("client"),
        F.concat(devices, F.lit("+/"), F.col("c_custkey").cast("string")).alias("filter"),
    )
    suppliers = table(spark, sf_dir, "supplier").select(
        F.col("s_suppkey").cast("bigint"), F.concat(devices, F.lit("click/"), F.col("s_suppkey").cast("string"))
    )
    broad = F.when(nation % 5 == 0, "#").when(nation % 5 == 1, "devices/purchase/#").when(
        nation % 5 == 2, "+/view/+"
    ).when(nation % 5 == 3, "devices/+").otherwise(F.concat(devices, F.lit("+/"), nation.cast("string"), F.lit("/#")))
    nations = table(spark, sf_dir, "nation").select(nation.cast("bigint"), broad)
    events = device_topics(table(spark, sf_dir, "events")).select("topic", "event_id")
    found = subscribed(events, customers.unionAll(suppliers).unionAll(nations))
    return found.groupBy("client", "filter").agg(F.count("*").alias("n"))


@query("""
    WITH numbered AS (
        SELECT event_id, props, CAST(user_id % 4 AS INTEGER) AS "partition",
            row_number() OVER (PARTITION BY user_id % 4 ORDER BY event_id) - 1 AS "offset",
            count(*) OVER (PARTITION BY user_id % 4) AS n
        FROM events)
    SELECT CASE WHEN "offset" < n // 2 THEN 1 ELSE 2 END AS commit_no, 'devices' AS topic, "partition", "offset",
        props AS value
    FROM numbered""")
def committed_reads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two batch reads of a growing topic, each repeated; every message is read by one of them."""
    folder = work_dir(spark, "committed_reads")
    partition = (F.col("user_id") % 4).cast("int")
    order = Window.partitionBy("partition").orderBy("event_id")
    messages = table(spark, sf_dir, "events").withColumn("partition", partition).select(
        F.lit(None).cast("binary").alias("key"), text_bytes(F.col("props")).alias("value"),
        F.lit("devices").alias("topic"), "partition",
        (F.row_number().over(order) - 1).cast("bigint").alias("offset"),
        F.col("ts").cast("timestamp").alias("timestamp"),
        F.count("*").over(Window.partitionBy("partition")).alias("n"),
    )
    ledger = Ledger(spark, f"{folder}/ledger", "reader")
    for number, part in enumerate((F.expr("offset < n div 2"), F.expr("offset >= n div 2")), 1):
        messages.where(part).select(MESSAGE.fieldNames()).write.mode("append").parquet(f"{folder}/topic")
        for _ in range(2):
            offered = read_messages(spark, ["devices"], path=f"{folder}/topic")
            ledger.consume(offered, lambda read, number=number: read.select(
                F.lit(number).alias("commit_no"), "topic", "partition", "offset",
                decode_text(F.col("value")).alias("value"),
            ).write.mode("append").parquet(f"{folder}/read"))
    return spark.read.parquet(f"{folder}/read")


@query("SELECT 'Counter' AS row_key, word AS qualifier, count(*) AS value FROM ("
       + sql_words("props", "events") + ") GROUP BY word")
def resend_counters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of messages that a bridge sent twice, some in the same batch and all again in the next."""
    folder = work_dir(spark, "resend_counters")
    events = table(spark, sf_dir, "events")
    sent = event_messages(events)
    for again in (sent.where("offset % 3 = 0"), sent):
        sent.unionByName(again).write.mode("append").parquet(f"{folder}/topic")
        messages = read_messages(spark, ["devices"], path=f"{folder}/topic", stream=True)
        told = message_ids(messages, "value", "offset")
        counters = Counters(spark, f"{folder}/counters")
        finish(count_words(once(told, timedelta(days=60)), counters, f"{folder}/checkpoint"))
    return counters.totals()


@query(f"""
    WITH sent AS (
        SELECT {_TOPIC} AS topic, ts, event_id,
            CASE WHEN event_id % 7 = 0 THEN '' ELSE props END AS payload FROM events)
    SELECT topic, payload, 0 AS qos
    FROM (SELECT topic, arg_max(payload, (ts, event_id)) AS payload FROM sent GROUP BY topic)
    WHERE payload <> ''""")
def topic_retained_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The messages kept for topics by a stream over landings that are not in the order of time.

    Every seventh message has no payload and clears its topic.
    """
    folder = work_dir(spark, "topic_retained_store")
    events = table(spark, sf_dir, "events")
    cleared = F.when(F.col("event_id") % 7 == 0, "").otherwise(F.col("props"))
    landed = device_topics(events).select(
        "topic", text_bytes(cleared).alias("payload"), F.lit(0).alias("qos"), F.lit(True).alias("retained"),
        F.col("ts").cast("timestamp").alias("ts"), F.col("event_id").alias("seq"),
    )
    kept = kept_table(spark, f"{folder}/kept", buckets=8)
    for part in (1, 2, 0):
        landed.where(F.col("seq") % 3 == part).write.mode("append").parquet(f"{folder}/landing")
        stream = read_files(spark, f"{folder}/landing", landed.schema, stream=True)
        finish(keep_retained(stream, kept, f"{folder}/checkpoint"))
    return kept_messages(kept).withColumn("payload", decode_text(F.col("payload")))
