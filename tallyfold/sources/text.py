"""Delimited text in and out."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

BROKEN = "_broken"


def read_delimited(spark: SparkSession, path: str | list[str], header: list[str] | None = None,
                   keep_position: bool = False, fewest: int = 4) -> DataFrame:
    """CSV with a header line, every field as text.

    Files of one call share a header; ``read_generations`` parts a folder whose files do not.

    Undecodable bytes become the replacement character and short lines get
    nulls. Lines with fewer than ``fewest`` fields are dropped, whichever columns are asked
    for (0 keeps all, as side tables do). The header is read
    from the first line only, so no pass over the data infers types.

    With ``keep_position`` the columns ``_file``, ``_block`` and ``_line`` give
    each row's place in its file, which first-row-wins deduplication orders by.
    """
    paths = [path] if isinstance(path, str) else list(path)
    reader = spark.read.option("header", True).option("encoding", "UTF-8")
    names = header or reader.csv(paths[0]).columns
    fields = [T.StructField(n, T.StringType()) for n in names]
    df = (
        reader.schema(T.StructType(fields + [T.StructField(BROKEN, T.StringType())]))
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", BROKEN)
        .option("enforceSchema", True)
        # Else a line's fields are counted only when all columns are asked for.
        .option("columnPruning", fewest == 0)
        .csv(paths)
    )
    if keep_position:
        df = df.select(
            "*",
            F.col("_metadata.file_path").alias("_file"),
            F.col("_metadata.file_block_start").alias("_block"),
            F.monotonically_increasing_id().alias("_line"),
        )
    if fewest == 0:
        return df.drop(BROKEN)
    # Commas within quotes part no fields. A value in the last needed field shows there are enough.
    unquoted = F.regexp_replace(BROKEN, '"([^"]|"")*"', "")
    last = F.col("`" + names[min(fewest, len(names)) - 1].replace("`", "``") + "`")
    enough = F.col(BROKEN).isNull() | last.isNotNull() | (F.size(F.split(unquoted, ",")) >= fewest)
    return df.filter(enough).drop(BROKEN)


def read_generations(spark: SparkSession, path: str | list[str], keep_position: bool = False,
                     fewest: int = 4) -> list[DataFrame]:
    """One frame per header line that occurs among the files, by their first file.

    The header lines are found by one scan of the text that keeps a line per file. Empty
    files have none and are left out.
    """
    lines = spark.read.text(path).select(
        "value", F.col("_metadata.file_path").alias("_file"),
        F.struct(F.col("_metadata.file_block_start"), F.monotonically_increasing_id()).alias("_at"))
    headers = lines.groupBy("_file").agg(F.min_by("value", "_at").alias("_header"))
    groups = headers.groupBy("_header").agg(F.sort_array(F.collect_list("_file")).alias("_files"))
    return [read_delimited(spark, g["_files"], keep_position=keep_position, fewest=fewest)
            for g in sorted(groups.collect(), key=lambda g: g["_files"])]


def write_delimited(df: DataFrame, path: str) -> None:
    """CSV with header, one file per partition."""
    df.write.mode("overwrite").option("header", True).csv(path)
