"""Relational tables, by catalog name or over JDBC."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def read_table(spark: SparkSession, name: str) -> DataFrame:
    return spark.read.table(name)


def read_jdbc(
    spark: SparkSession,
    url: str,
    table: str,
    properties: dict[str, str] | None = None,
    *,
    split_on: str | None = None,
    bounds: tuple[int, int] | None = None,
    partitions: int = 1,
    predicates: list[str] | None = None,
) -> DataFrame:
    """A table, or a query in parentheses with an alias, read over JDBC.

    One connection reads it all unless ``split_on`` names a number column and ``bounds`` its
    range; then ``partitions`` tasks each read a slice of equal width. ``predicates``, from
    :func:`slice_predicates`, give slices of about equal numbers of rows instead.
    """
    if predicates is not None:
        if split_on is not None:
            raise ValueError("give either predicates or split_on")
        return spark.read.jdbc(url, table, predicates=predicates, properties=properties or {})
    if split_on is None:
        if partitions != 1:
            raise ValueError("more than one partition needs split_on and bounds")
        return spark.read.jdbc(url, table, properties=properties or {})
    if bounds is None:
        raise ValueError("split_on needs bounds")
    return spark.read.jdbc(
        url, table, column=split_on, lowerBound=bounds[0], upperBound=bounds[1],
        numPartitions=partitions, properties=properties or {},
    )


def slice_predicates(keys: DataFrame, key: str, slices: int, accuracy: int = 10_000) -> list[str]:
    """Conditions on a number or date column that cut a table into slices of about equal numbers of rows.

    ``keys`` holds the column, for example a sample or an index of the table. Every value, null and ones
    outside of what ``keys`` holds among them, meets exactly one condition, so nothing is read twice or
    left out. A value that holds more than a slice's share of rows is a slice alone: no condition on the
    key can cut it.
    """
    if slices < 1:
        raise ValueError("there must be at least one slice")
    kind = dict(keys.dtypes)[key]
    shares = [n / slices for n in range(1, slices)]
    name = f'"{key}"' if not key.isidentifier() else key
    cuts = []
    if shares:
        found = keys.agg(F.percentile_approx(key, shares, accuracy).alias("cuts"))
        cuts = found.select(F.array_distinct("cuts").cast("array<string>")).first()[0] or []
    quote = "'" if kind.startswith(("date", "timestamp")) else ""
    marks = [f"{quote}{cut}{quote}" for cut in cuts]
    if not marks:
        return ["1 = 1"]
    inner = [f"{name} > {low} AND {name} <= {high}" for low, high in zip(marks, marks[1:], strict=False)]
    return [f"{name} <= {marks[0]} OR {name} IS NULL", *inner, f"{name} > {marks[-1]}"]


def split_misfits(rows: DataFrame, schema: StructType) -> tuple[DataFrame, DataFrame]:
    """Rows whose values all fit the schema, typed, and the others as they are with ``misfits``.

    Columns are taken by position. ``misfits`` names the fields whose value is there and does not fit its
    type; null fits every type.
    """
    typed = _checked(rows, schema)
    fits = F.size("misfits") == 0
    return (
        typed.where(fits).select(*[F.col(f"t{i}").alias(f.name) for i, f in enumerate(schema)]),
        typed.where(~fits).select(*[F.col(f"c{i}").alias(f.name) for i, f in enumerate(schema)], "misfits"),
    )


def _checked(rows: DataFrame, schema: StructType) -> DataFrame:
    if len(rows.columns) < len(schema):
        raise ValueError(f"{len(rows.columns)} columns cannot fill {len(schema)} fields")
    numbered = rows.toDF(*[f"c{i}" for i in range(len(rows.columns))])
    typed = numbered.select("*", *[F.col(f"c{i}").try_cast(f.dataType).alias(f"t{i}") for i, f in enumerate(schema)])
    bad = [F.when(F.col(f"c{i}").isNotNull() & F.col(f"t{i}").isNull(), f.name) for i, f in enumerate(schema)]
    return typed.withColumn("misfits", F.array_compact(F.array(*bad)))


def typed_columns(rows: DataFrame, schema: StructType) -> DataFrame:
    """Take columns by position and give them the schema's names and types.

    A value that does not fit its type becomes null; :func:`split_misfits` tells such rows apart.
    """
    if len(rows.columns) < len(schema):
        raise ValueError(f"{len(rows.columns)} columns cannot fill {len(schema)} fields")
    # Positions survive duplicate column names only through toDF.
    numbered = rows.toDF(*[f"c{i}" for i in range(len(rows.columns))])
    return numbered.select(
        *[F.col(f"c{i}").try_cast(f.dataType).alias(f.name) for i, f in enumerate(schema)]
    )
