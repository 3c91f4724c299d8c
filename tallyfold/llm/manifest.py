"""Merkle manifest of a dataset: digests of rows, of sources and of the whole, with proofs.

Leaves stand in the order of their ids within a source. A block holds ``ARITY ** HEIGHT``
neighbouring leaves, aligned, and keeps every level of its part of the tree as one string of
hex digests, 64 characters each. Digests of parents are digests of fixed-width substrings, the
digests around a node's in its run are the node's siblings, and block roots are the leaves of
the same work one round up, until one node is left. Everything is built-in SQL functions;
texts are hashed where they are read and never shuffled.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyfold.llm.common import stored

ARITY = 3
#: Levels of the tree within a block: 3 ** 5 leaves, 15.6 KB of digests.
HEIGHT = 5
#: Characters of a digest.
HEX = 64

#: Steps from a node to its root: the digests before and after it in each run.
PATH = "array<struct<before: string, after: string>>"


def _digest(text: Column) -> Column:
    return F.sha2(text.cast("binary"), 256)


def field(value: Column) -> Column:
    """``-`` for null, else the value's length in UTF-8 bytes, a colon and the value."""
    text = value.cast("string")
    return F.when(text.isNull(), "-").otherwise(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text))


def row_digest(*values: Column) -> Column:
    """Digest of a row's fields, one after the other."""
    return _digest(F.concat(*[field(v) for v in values]))


def _same(one: list[str], other: list[str]) -> Column:
    """Whether all columns of two lists are equal, nulls included."""
    same = F.lit(True)
    for a, b in zip(one, other):
        same = same & F.col(a).eqNullSafe(F.col(b))
    return same


def positions(rows: DataFrame, group: list[str], order: list[str], label: str) -> DataFrame:
    """``rows`` with ``_pos`` (0, 1, ... within ``group`` by ``order``, nulls first) and ``_n``, the group's size.

    Rows are sorted by ranges over all tasks, equal ones too; only one count per range and group
    is ever added up in order, so a group of any size has no task of its own.
    """
    keys = [*group, *order]
    spread = rows.withColumn("_tie", F.monotonically_increasing_id())
    sort = [F.col(c).asc_nulls_first() for c in [*keys, "_tie"]]
    dealt = spread.repartitionByRange(*sort).sortWithinPartitions(*sort)
    dealt = stored(dealt.withColumn("_range", F.spark_partition_id()).withColumn("_at", F.monotonically_increasing_id())
                   .drop("_tie"), label)
    counts = dealt.groupBy("_range", *group).agg(F.min("_at").alias("_first"), F.count(F.lit(1)).alias("_count"))
    before = Window.partitionBy(*group).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy(*group)
    counts = counts.select(
        F.col("_range").alias("_r"), *[F.col(c).alias(f"_g{i}") for i, c in enumerate(group)], "_first",
        F.coalesce(F.sum("_count").over(before), F.lit(0)).alias("_before"), F.sum("_count").over(whole).alias("_n"))
    same = _same(group, [f"_g{i}" for i in range(len(group))])
    return dealt.join(counts, same & (F.col("_range") == F.col("_r"))).select(
        *rows.columns, (F.col("_at") - F.col("_first") + F.col("_before")).alias("_pos"), "_n")


def _joined(parts: Column) -> Column:
    return F.array_join(parts, "")


def _parents(level: Column) -> Column:
    """The level above a level string: a digest per run of digests, the last run as long as it is."""
    run = ARITY * HEX
    runs = F.ceil(F.length(level) / run).cast("int")
    return _joined(F.transform(F.sequence(F.lit(0), runs - 1), lambda i: _digest(F.substring(level, i * run + 1, F.lit(run)))))


def _levels(blocks: DataFrame, height: int) -> DataFrame:
    """Blocks with ``_l0`` .. ``_l{height}``: level strings; a level above the tree's top repeats it."""
    for k in range(height):
        below = F.col(f"_l{k}")
        blocks = blocks.withColumn(f"_l{k + 1}", F.when(F.col("_n") > ARITY ** k, _parents(below)).otherwise(below))
    return blocks


def _path(place: Column, height: int) -> Column:
    """A block member's path by its place in the block: substrings around its ancestors' digests."""
    steps = []
    for k in range(height):
        own = F.floor(place / ARITY ** k).cast("int")
        first = F.floor(place / ARITY ** (k + 1)).cast("int") * ARITY
        level = F.col(f"_l{k}")
        steps.append(F.when(F.col("_n") > ARITY ** k, F.struct(
            F.substring(level, first * HEX + 1, (own - first) * HEX).alias("before"),
            F.substring(level, (own + 1) * HEX + 1, (first + ARITY - 1 - own) * HEX).alias("after"))))
    return F.filter(F.array(*steps), lambda s: s.isNotNull())


def trees(nodes: DataFrame, group: list[str], label: str, height: int = HEIGHT) -> DataFrame:
    """Blocks of one tree per ``group`` with ``_root`` and ``_up``, the path from the block's root to that.

    ``nodes`` has ``_digest``, ``_pos`` and ``_n``; a block is one row that holds them as ``_members``.
    """
    width = ARITY ** height
    member = F.struct((F.col("_pos") % width).cast("int").alias("_place"),
                      *[c for c in nodes.columns if c not in (*group, "_n")])
    blocks = nodes.groupBy(*group, "_n", F.floor(F.col("_pos") / width).cast("long").alias("_block")).agg(
        F.array_sort(F.collect_list(member)).alias("_members"))
    blocks = blocks.withColumn("_l0", _joined(F.transform("_members", lambda m: m["_digest"])))
    blocks = stored(_levels(blocks, height), label)
    top = F.col(f"_l{height}")
    if blocks.where(F.col("_n") > width).isEmpty():
        return blocks.withColumn("_root", top).withColumn("_up", F.array().cast(PATH))
    names = [f"_above{c}" for c in group]
    roots = blocks.select(
        *[F.col(c).alias(n) for c, n in zip(group, names)], F.col("_block").alias("_pos"),
        F.ceil(F.col("_n") / width).cast("long").alias("_n"), top.alias("_digest"))
    above = members(trees(roots, names, label, height), names, height).select(
        *names, F.col("_pos").alias("_b"), "_root", F.col("_path").alias("_up"))
    return blocks.join(above, _same(group, names) & (F.col("_block") == F.col("_b"))).drop(*names, "_b")


def members(blocks: DataFrame, group: list[str], height: int = HEIGHT) -> DataFrame:
    """The nodes that went into ``trees``, each with ``_root`` and ``_path``."""
    carried = [f.name for f in blocks.schema["_members"].dataType.elementType.fields if f.name != "_place"]
    nodes = F.transform("_members", lambda m: F.struct(
        *[m[c].alias(c) for c in carried], F.concat(_path(m["_place"], height), F.col("_up")).alias("_path")))
    return blocks.select(*group, "_root", *[c for c in blocks.columns if c == "_top"], F.inline(nodes))


def fold(node: Column, path: Column) -> Column:
    """The root that a node's digest leads to over its path."""
    return F.aggregate(path, node, lambda acc, s: _digest(F.concat(s["before"], acc, s["after"])))


def manifest(rows: DataFrame, fields: list[str], doc_id: str = "doc_id", source: str = "source",
             claimed: Column | None = None, height: int = HEIGHT) -> DataFrame:
    """(doc_id, source, leaf, subroot, root, proof, folded_root, verified) of every row.

    ``leaf`` is the digest of ``fields`` in their order, ``proof`` the siblings' digests from the
    leaf over the source's subroot to the root, left to right, as one string. ``claimed`` is
    the digest to be checked against the manifest (the row's own, if none is given), ``folded_root``
    what it leads to. Leaves of a source stand by ``doc_id``, nulls first, rows with one id by leaf (and claim),
    so repeated rows keep a defined order; a null source is a source of its own and the
    first one. Nulls and empty values in any field have digests of their own; other columns are left out, whatever
    their names, and an empty table gives no rows.
    """
    leaf = row_digest(*[F.col(c) for c in fields])
    leaves = rows.select(
        F.col(source).alias("source"), F.col(doc_id).alias("doc_id"), leaf.alias("_digest"),
        (leaf if claimed is None else claimed).alias("_claim"))
    placed = positions(stored(leaves, "leaves"), ["source"], ["doc_id", "_digest", "_claim"], "ordered-leaves")
    blocks = trees(placed, ["source"], "leaf-blocks", height)
    subroots = blocks.where("_block = 0").select(
        F.lit(0).alias("_all"), F.col("source").alias("_source"), F.col("_root").alias("_digest"))
    ordered = positions(subroots, ["_all"], ["_source"], "ordered-subroots")
    tops = members(trees(ordered, ["_all"], "subroot-blocks", height), ["_all"], height).select(
        "_source", F.col("_root").alias("_top"), F.col("_path").alias("_over"))
    blocks = blocks.join(tops, _same(["source"], ["_source"])).withColumn("_up", F.concat("_up", "_over"))
    whole = members(blocks, ["source"], height)
    proof = _joined(F.transform("_path", lambda s: F.concat(s["before"], s["after"])))
    folded = fold(F.col("_claim"), F.col("_path"))
    return whole.select(
        "doc_id", "source", F.col("_digest").alias("leaf"), F.col("_root").alias("subroot"), F.col("_top").alias("root"),
        proof.alias("proof"), folded.alias("folded_root"), (folded == F.col("_top")).alias("verified"))


def tampered(text: Column, doc_id: Column) -> Column:
    """A text without its line ends where 2 divides the id's checksum; others as they are."""
    return F.when(F.crc32(doc_id.cast("string").cast("binary")) % 2 == 0, F.replace(text, F.lit("\n"), F.lit(""))).otherwise(text)
