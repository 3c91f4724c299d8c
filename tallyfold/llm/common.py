"""Helpers that several text operators share."""

from __future__ import annotations

import os
import tempfile
import zipfile

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

import tallyfold
from tallyfold.session import scratch_path

#: Spark's setting that removes a query's shuffle files at its end.
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Hands the package's code to the workers once per application, through Spark's own file service."""
    app = spark.sparkContext.applicationId
    if app in _shipped:
        return
    top = os.path.dirname(tallyfold.__file__)
    archive = os.path.join(tempfile.mkdtemp(), "tallyfold-code.zip")
    with zipfile.ZipFile(archive, "w", zipfile.ZIP_DEFLATED) as z:
        for folder, _, names in os.walk(top):
            for name in sorted(names):
                if name.endswith(".py"):
                    full = os.path.join(folder, name)
                    z.write(full, os.path.join("tallyfold", os.path.relpath(full, top)))
    spark.sparkContext.addPyFile(archive)
    _shipped.add(app)


def map_arrow(df: DataFrame, run, schema) -> DataFrame:
    """``mapInArrow`` with the package's code on the workers."""
    ship(df.sparkSession)
    return df.mapInArrow(run, schema)


def map_pandas(df: DataFrame, run, schema) -> DataFrame:
    """``mapInPandas`` with the package's code on the workers."""
    ship(df.sparkSession)
    return df.mapInPandas(run, schema)


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")


def stored(df: DataFrame, label: str) -> DataFrame:
    """``df`` written to the shared scratch folder and read back.

    Cuts the lineage with files that every executor can reach, so a lost executor
    costs a re-read of them and nothing before. The shuffle files behind it are not
    needed any more and are removed.
    """
    spark = df.sparkSession
    path = scratch_path(spark, label)
    before = spark.conf.get(_CLEANUP, "false")
    spark.conf.set(_CLEANUP, "true")
    try:
        df.write.parquet(path)
    finally:
        spark.conf.set(_CLEANUP, before)
    return spark.read.schema(df.schema).parquet(path)


#: Rows of one key that meet in a task; keys with more are dealt out.
TOGETHER = 2048


def dealt_join(rows: DataFrame, few: DataFrame, key: str, spread: Column, counts: DataFrame | None = None,
               together: int | None = None) -> DataFrame:
    """Inner join by ``key``; ``few`` has a row per key with ``rows_of_key``, what ``rows`` holds of it.

    ``counts`` may name a narrower table with the same keys and ``rows_of_key``.

    A key with more than ``together`` rows (``TOGETHER``, if none are given) is dealt to several tasks: its row in ``few`` is repeated for
    each, rows go to one of them by ``spread``. Keys that are dealt out are a small part of all
    rows, so finding them is a small join.
    """
    together = together or TOGETHER
    hot = (few if counts is None else counts).where(F.col("rows_of_key") > together).select(
        F.col(key).alias("_hot"), F.ceil(F.col("rows_of_key") / together).cast("int").alias("_shares"))
    hot = stored(hot, "hot-keys")
    if hot.isEmpty():
        return rows.join(few, key)
    rows = rows.join(hot, F.col(key) == F.col("_hot"), "left").withColumn(
        "_share", F.coalesce(F.pmod(F.xxhash64(spread), F.col("_shares")).cast("int"), F.lit(0))).drop("_hot", "_shares")
    shares = F.greatest(F.lit(1), F.ceil(F.col("rows_of_key") / together).cast("int"))
    few = few.withColumn("_share", F.explode(F.sequence(F.lit(0), shares - 1)))
    return rows.join(few, [key, "_share"]).drop("_share")


def set_aside(df: DataFrame) -> tuple[DataFrame, list[str]]:
    """``df`` with its columns named by their place, so that none is named like a result of an operator; and the names."""
    names = [f"_c{i}" for i in range(len(df.columns))]
    return df.toDF(*names), names


def put_back(df: DataFrame, columns: list[str]) -> DataFrame:
    """The columns that ``set_aside`` renamed, under their own names."""
    return df.select([F.col(f"_c{i}").alias(c) for i, c in enumerate(columns)])


def refuse_clash(passing, results) -> None:
    """Raises where a column to be passed on is named like a result."""
    both = sorted(set(passing) & set(results))
    if both:
        raise ValueError(f"columns passed on are named like results: {', '.join(both)}")


class Memory:
    """What was last asked for, in two generations: a full young one becomes the old one, and what is used again moves up."""

    def __init__(self, size: int):
        self.size, self.young, self.old = size, {}, {}

    def missing(self, keys: set) -> list:
        """Those of ``keys`` that are not remembered; the others are in ``young`` afterwards."""
        young, old = self.young, self.old
        new = keys.difference(young)
        if not old:
            return list(new)
        out = []
        for k in new:
            got = old.get(k)
            if got is None:
                out.append(k)
            else:
                young[k] = got
        return out

    def turn(self) -> None:
        """To be called when nothing of ``young`` is needed any more."""
        if len(self.young) > self.size:
            self.young, self.old = {}, self.young


def ascii_lower(text: Column) -> Column:
    """A-Z in lower case, everything else as it is."""
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def components(links: DataFrame, label: str = "components") -> DataFrame:
    """(node, component): the smallest node that can be reached over ``links`` (a, b).

    Each round hooks every node's root to the smallest root beside it and then
    halves all paths. Trees shrink geometrically, so rounds grow with the logarithm
    of the longest path. Every round is stored; rows are edges between different
    roots, which a round at least thins out, and a hub's edges are reduced to
    one row per neighbour root before they are shuffled by hub.
    """
    edges = links.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
    edges = stored(edges, f"{label}-edges")
    nodes = stored(edges.select("b").union(edges.select("a")).distinct().select(
        F.col("b").alias("node"), F.col("b").alias("root")), f"{label}-roots")
    while not edges.isEmpty():
        both = edges.union(edges.select(F.col("b"), F.col("a")))
        hook = both.groupBy("a").agg(F.min("b").alias("low")).select(
            F.col("a").alias("node"), F.least("a", "low").alias("up"))
        hook = stored(hook, f"{label}-hook")
        up = _flatten(hook, label)
        moved = up.where("node <> up")
        nodes = stored(nodes.join(moved.select(F.col("node").alias("root"), "up"), "root", "left").select(
            "node", F.coalesce("up", "root").alias("root")), f"{label}-roots")
        edges = stored(
            edges.join(up.select(F.col("node").alias("a"), F.col("up").alias("ra")), "a")
            .join(up.select(F.col("node").alias("b"), F.col("up").alias("rb")), "b")
            .where("ra <> rb").select(F.least("ra", "rb").alias("a"), F.greatest("ra", "rb").alias("b")).distinct(),
            f"{label}-edges")
    return nodes.select("node", F.col("root").alias("component"))


def _flatten(hook: DataFrame, label: str) -> DataFrame:
    """Every node's pointer led to the end of its path, by doubling."""
    while True:
        twice = stored(hook.join(
            hook.select(F.col("node").alias("up"), F.col("up").alias("upper")), "up", "left").select(
            "node", "up", F.coalesce("upper", "up").alias("upper")), f"{label}-jump")
        hook = twice.select("node", F.col("upper").alias("up"))
        if twice.where("up <> upper").isEmpty():
            return hook
