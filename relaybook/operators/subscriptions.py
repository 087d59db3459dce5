"""Many subscriptions at once: which messages match which topic filters, as a join.

The filters form a trie of levels. A topic walks down it from level to level, along its own level and
along ``+``, as long as some filter begins so; each step is a join by hash. The plan grows with the
levels of the longest filter and not with the number of filters.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from relaybook.session import stored

#: Steps of the walk between two tables in the shared folder, which keep plans short.
STEPS = 6


def valid_filter(name: Column) -> Column:
    """True for a filter that is not empty and whose wildcards fill a level, ``#`` the last one."""
    levels = F.split(name, "/")
    bad = F.exists(levels, lambda l: (F.length(l) > 1) & (F.contains(l, F.lit("#")) | F.contains(l, F.lit("+"))))
    early = F.exists(F.slice(levels, 1, F.greatest(F.size(levels) - 1, F.lit(0))), lambda l: l == "#")
    return F.coalesce((name != "") & ~bad & ~early, F.lit(False))


def invalid_filters(subscriptions: DataFrame, name: str = "filter") -> DataFrame:
    """The subscriptions that can match nothing, null among them."""
    return subscriptions.where(~valid_filter(F.col(name)))


def matching_filters(topics: DataFrame, filters: DataFrame) -> DataFrame:
    """All pairs of a ``topic`` and a ``filter`` that matches it, from a column of each, without repeats.

    ``+`` stands for one level, also an empty one, and ``#`` for any number of further ones, none
    included; a wildcard at the beginning does not match topics that begin with ``$``. Filters that are
    not valid, and nulls on either side, match nothing.
    """
    spark = topics.sparkSession
    named = filters.select("filter").where(valid_filter(F.col("filter"))).distinct().withColumn(
        "levels", F.split("filter", "/")
    )
    rest = F.element_at("levels", -1) == "#"
    named = stored(named.select(
        "filter", rest.alias("rest"),
        F.when(rest, F.slice("levels", 1, F.size("levels") - 1)).otherwise(F.col("levels")).alias("levels"),
    ), "subscription-filters")
    deepest = named.agg(F.max(F.size("levels"))).first()[0]
    # Every beginning of a filter is a node; forms are joined by a slash behind each level.
    nodes = stored(named.select(F.posexplode("levels").alias("at", "level"), "levels").select(
        (F.col("at") + 1).alias("depth"),
        F.concat(F.array_join(F.slice("levels", 1, F.col("at") + 1), "/"), F.lit("/")).alias("form"),
    ).distinct(), "subscription-nodes")
    ends = named.select(
        F.size("levels").alias("depth"), "rest", "filter",
        F.when(F.size("levels") > 0, F.concat(F.array_join("levels", "/"), F.lit("/"))).otherwise("").alias("form"),
    )
    walked = topics.select("topic").where(F.col("topic").isNotNull()).distinct().withColumn(
        "levels", F.split("topic", "/")
    )
    front = walked.select("topic", "levels", F.lit(0).alias("depth"), F.lit("").alias("form"))
    reached = front
    for depth in range(1, (deepest or 0) + 1):
        level = F.get("levels", F.lit(depth - 1))
        plus = F.lit(True) if depth > 1 else ~F.col("topic").startswith("$")
        steps = F.explode(F.array_distinct(F.when(plus, F.array(level, F.lit("+"))).otherwise(F.array(level))))
        wider = front.where(F.size("levels") >= depth).select("topic", "levels", "form", steps.alias("level"))
        wider = wider.select(
            "topic", "levels", F.lit(depth).alias("depth"), F.concat("form", "level", F.lit("/")).alias("form")
        )
        at_depth = nodes.where(F.col("depth") == depth).select("form")
        front = wider.join(at_depth, "form", "left_semi").select("topic", "levels", "depth", "form")
        # A topic may have a level that is a plus sign; its walk must not count twice.
        front = front.distinct()
        if depth % STEPS == 0 or depth == deepest:
            front = stored(front, "subscription-walk")
        reached = reached.unionAll(front)
    whole = F.size("levels") == F.col("reached.depth")
    system = (F.col("ends.depth") == 0) & F.col("topic").startswith("$")
    found = reached.alias("reached").join(
        ends.alias("ends"), (F.col("reached.form") == F.col("ends.form")) & (F.col("reached.depth") == F.col("ends.depth"))
    ).where((F.col("rest") | whole) & ~system)
    return found.select("topic", "filter").distinct() if deepest is not None else spark.createDataFrame(
        [], "topic string, filter string"
    )


def subscribed(messages: DataFrame, subscriptions: DataFrame) -> DataFrame:
    """Every message with every subscription whose ``filter`` matches its ``topic``.

    Topics are matched once each and not once a message. Columns of both sides are kept; those of the
    subscriptions may not have names that messages have. Subscriptions that repeat count each.
    """
    clash = {c.lower() for c in messages.columns} & {c.lower() for c in subscriptions.columns}
    if clash:
        raise ValueError(f"messages and subscriptions share columns: {sorted(clash)}")
    pairs = matching_filters(messages.select("topic"), subscriptions.select("filter"))
    return messages.join(pairs, "topic").join(subscriptions, "filter").select(
        *messages.columns, *subscriptions.columns
    )
