"""The message that a broker keeps for each topic, as a table that a stream keeps up."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from relaybook.schemas import KEPT
from relaybook.streaming.folded import FoldedTable
from relaybook.streaming.runs import each_batch


def kept_table(spark: SparkSession, root: str, **options) -> FoldedTable:
    """Topics with their last retained message; one that was cleared keeps its empty payload as a mark.

    Without the mark, an older message that comes late would bring a cleared topic back.
    """
    return FoldedTable(spark, root, KEPT, ["topic"], ["ts", "seq"], **options)


def keep_retained(
    landed: DataFrame, table: FoldedTable, checkpoint: str, *, every: str | None = None
) -> StreamingQuery:
    """Merge the retained messages of a stream into the table, by time and then by sequence.

    ``landed`` has the columns of the landed messages and ``seq``.
    """
    retained = landed.where("retained").select(KEPT.fieldNames())
    return each_batch(retained, table.upsert, checkpoint, every=every)


def kept_messages(table: FoldedTable) -> DataFrame:
    """The topics that hold a message now, and the message."""
    return table.read().where(F.length("payload") > 0).select("topic", "payload", "qos")
