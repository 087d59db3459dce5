"""Text files as lines."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from relaybook.sources.messages import BATCH_BYTES


def read_lines(
    spark: SparkSession,
    path: str,
    *,
    name_glob: str | None = None,
    recursive: bool = False,
    stream: bool = False,
    batch_bytes: int | None = BATCH_BYTES,
    archive: str | None = None,
) -> DataFrame:
    """One row ``value`` per line of a UTF-8 file, or of the files of a whole folder tree.

    ``name_glob`` keeps files by name: ``"*.txt"`` by extension, ``"*transaction*"`` by a part.
    Files are split at line ends, so one large file is read by many tasks. A stream moves files
    it is done with to the ``archive`` folder, which must lie outside ``path``.
    """
    if archive is not None and not stream:
        raise ValueError("only a stream archives its files")
    reader = spark.readStream if stream else spark.read
    if stream and batch_bytes is not None:
        reader = reader.option("maxBytesPerTrigger", batch_bytes)
    if name_glob is not None:
        reader = reader.option("pathGlobFilter", name_glob)
    if recursive:
        reader = reader.option("recursiveFileLookup", "true")
    if archive is not None:
        reader = reader.option("cleanSource", "archive").option("sourceArchiveDir", archive)
    return reader.text(path).select("value")
