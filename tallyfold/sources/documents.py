"""Report documents as JSON."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Names of the sections that a document keeps beside itself.
BESIDE = "sections_beside"


def json_lines(df: DataFrame) -> DataFrame:
    """Each row as one JSON text in ``value``."""
    return df.select(F.to_json(F.struct("*")).alias("value"))


def write_json_lines(df: DataFrame, path: str) -> None:
    json_lines(df).write.mode("overwrite").text(path)


def write_document(sections: dict[str, DataFrame], path: str,
                   order: dict[str, list] | None = None, growing: tuple[str, ...] = ()) -> None:
    """One JSON object with an array per section, in the order asked for.

    Nesting needs a whole section in one row, so only sections bounded by their meaning (a top
    list, a row per year or region) are nested. Those named in ``growing`` have a row per place or
    the like: at every size they are JSON lines in a folder of their own, ``<path>_<section>``,
    sorted across its files, and the object names them in ``sections_beside``.
    """
    order = order or {}
    for name in growing:
        rows = sections[name].orderBy(*order[name]) if name in order else sections[name]
        write_json_lines(rows, f"{path}_{name}")
    spark = next(iter(sections.values())).sparkSession
    paired = spark.range(1).select(F.lit(1).alias("_one"), F.array(
        *[F.lit(name) for name in growing]).cast("array<string>").alias(BESIDE))
    for name, df in sections.items():
        if name in growing:
            continue
        ranked = order.get(name, [])
        rows = df.select(F.struct(*[c.alias(f"_s{i}") for i, c in enumerate(ranked)],
                                  F.struct("*").alias("row")).alias("item"))
        nested = rows.agg(F.sort_array(F.collect_list("item")).alias("items"))
        # Every part is exactly one row, so pairing them multiplies nothing.
        paired = paired.join(nested.select(F.lit(1).alias("_one"), F.transform(
            "items", lambda i: i["row"]).alias(name)), "_one")
    json_lines(paired.drop("_one")).coalesce(1).write.mode("overwrite").text(path)


def read_section(spark: SparkSession, path: str, name: str, row_type: str) -> DataFrame:
    """Rows of one section, nested in the document or kept beside it."""
    doc = spark.read.schema(f"{BESIDE} array<string>, `{name}` array<{row_type}>").json(path)
    if name in (doc.select(BESIDE).first()[0] or ()):
        lines = spark.read.text(f"{path}_{name}")
        return lines.select(F.from_json("value", row_type).alias("_row")).select("_row.*")
    return doc.select(F.inline(name))
