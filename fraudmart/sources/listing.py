"""Listing of the daily drop folder as a DataFrame (input of S7, S8).

The ``binaryFile`` source lists files in parallel and, because ``content`` is not
selected, never reads them.  A drop is a file, or a folder of part files as Spark and other
parallel writers leave it: its length is that of all parts, its time the newest part's.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fraudmart.operators.files import FILE_KEY
from fraudmart.session import file_system


def list_drop_files(spark: SparkSession, folder: str) -> DataFrame:
    """``path, name, modified, length`` of the drops in ``folder`` (``modified`` in microseconds)."""
    _fs, home = file_system(spark, folder)
    listed = (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", "true")
        .load(folder)
        .select(F.split("path", "/").alias("steps"), "modificationTime", "length")
    )
    depth = len(home.toString().split("/"))
    return (
        listed.groupBy(F.element_at("steps", depth + 1).alias("name"))
        .agg(F.max(F.unix_micros("modificationTime")).alias("modified"), F.sum("length").alias("length"))
        .select(F.concat(F.lit(home.toString() + "/"), "name").alias("path"), "name", "modified", "length")
    )


def archive_drops(spark: SparkSession, folder: str, archive: str, ledger: DataFrame) -> list[str]:
    """Move the drops of ``folder`` that the ledger has into ``archive``; returns their names.

    The ledger alone says what was consumed: a crash before or during the move leaves files
    that no run takes again, and the next call moves them.  A name that is in the archive
    already gets its modification time added.
    """
    done = list_drop_files(spark, folder).join(ledger, list(FILE_KEY), "left_semi")
    moved = []
    for row in done.select("path", "name", "modified").collect():  # the drops of a day or two
        fs, source = file_system(spark, row.path)
        _, target = file_system(spark, f"{archive}/{row.name}")
        fs.mkdirs(target.getParent())
        if fs.exists(target):
            _, target = file_system(spark, f"{archive}/{row.name}.{row.modified}")
        if not fs.rename(source, target):
            raise OSError(f"{row.path} could not be moved to {archive}")
        moved.append(row.name)
    return sorted(moved)
