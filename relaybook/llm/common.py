"""Column pieces and the scratch tables that several operators share."""

from __future__ import annotations

from collections.abc import Callable
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from relaybook.session import work_dir

#: The white space that parts words: blank and the characters 9 to 13.
SPACES = " \t\n\x0b\f\r"
SPACE_RUN = r"[\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with the value computed once, also where ``body`` uses it in a lambda."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def words(text: Column) -> Column:
    """The runs of ``[^\\x20\\x09-\\x0D]``, in order; null has none."""
    trimmed = F.btrim(F.coalesce(text, F.lit("")), F.lit(SPACES))
    return F.when(trimmed == "", F.array().cast("array<string>")).otherwise(
        F.split(trimmed, SPACE_RUN)
    )


def stash(rows: DataFrame, purpose: str) -> DataFrame:
    """Write rows to the shared folder and read them back, so that lost executors cost no rerun."""
    path = work_dir(rows.sparkSession, purpose)
    rows.write.parquet(path)
    return rows.sparkSession.read.schema(rows.schema).parquet(path)


def without(rows: DataFrame, *names: str) -> DataFrame:
    """Drop columns that an operator is about to add; names count as Spark compares them."""
    taken = {name.lower() for name in names}
    return rows.select(*[quoted(name) for name in rows.columns if name.lower() not in taken])


def quoted(name: str) -> Column:
    return F.col("`" + name.replace("`", "``") + "`")


def columns(rows: DataFrame) -> list[Column]:
    return [quoted(name) for name in rows.columns]


def carried(rows: DataFrame, carry: list[str] | None, *added: str) -> Column:
    """The columns that go through an operator, as one struct: those named, or all but ``added``."""
    names = carry if carry is not None else without(rows, *added).columns
    return F.struct(*[quoted(name) for name in names])


def map_arrow(rows: DataFrame, run: Callable, schema: StructType | str) -> DataFrame:
    """``mapInArrow`` for columns of any name.

    Tasks import this package: from where executors have it (installed, or sent with ``--py-files``), or
    from the driver's folder if they share it. That folder is named to the tasks of this call alone.
    """
    made = schema if isinstance(schema, StructType) else StructType.fromDDL(schema)
    names, numbered = rows.columns, rows.toDF(*[f"c{n}" for n in range(len(rows.columns))])
    places = [f"c{n}" for n in range(len(made))]
    unnamed = StructType([StructField(n, f.dataType) for n, f in zip(places, made, strict=True)])

    def renamed(batches):
        for batch in run(batch.rename_columns(names) for batch in batches):
            yield batch.rename_columns(places)

    environment = rows.sparkSession.sparkContext.environment
    before = environment.get("PYTHONPATH")
    root = str(Path(__file__).resolve().parents[2])
    try:
        environment["PYTHONPATH"] = ":".join([*filter(None, (before or "").split(":")), root])
        # The function and its environment are packed here, not when the job runs.
        mapped = numbered.mapInArrow(renamed, unnamed)
    finally:
        if before is None:
            environment.pop("PYTHONPATH", None)
        else:
            environment["PYTHONPATH"] = before
    return mapped.toDF(*made.names)
