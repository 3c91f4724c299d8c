"""Ranked lexical search with integer scores, in pipelined stages of term owners.

Documents are inverted where they are read, a slice of some thousand at a time. The terms of the
queries are dealt to owners by how many documents hold them, rarest first. One bundle per
query and slice visits the owners in turn: each stage cogroups the bundles of a slice with
the owner's postings there and adds their contributions to the bundle's sparse accumulators. A
document leaves a bundle when what the later owners can add at most does not bring it up to
the k-th best of the slice; the ranks are those of a full evaluation.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyfold.llm.common import map_arrow, ship, stored

#: Owners, and so stages, that a bundle passes.
OWNERS = 4
#: Documents of a slice, and queries whose bundles meet a slice's postings at once.
SLICE = 4096
QUERIES = 512

#: Digits, letters and every byte of a character beyond ASCII; A-Z in lower case, all else a space.
_FOLD = bytes(c + 32 if 65 <= c <= 90 else c if c >= 128 or chr(c).isalnum() else 32 for c in range(256))


def terms_of(text: bytes) -> list[bytes]:
    """The terms of a UTF-8 text, in order."""
    return text.translate(_FOLD).split()


def _inverted(batches: Iterator[pa.RecordBatch], size: int):
    """Postings of every slice: a row a term, and a row without term that holds the slice's documents."""
    part, count = TaskContext.get().partitionId(), 0
    names = ["slice", "term", "docs", "tf", "n", "ids"]
    for batch in batches:
        for at in range(0, batch.num_rows, size):
            some = batch.slice(at, size)
            postings: dict[bytes, tuple[list, list, list]] = {}
            lengths = []
            for k, data in enumerate(some.column(1)):
                found = terms_of(data.as_py()) if data.is_valid else ()
                n = len(found)
                lengths.append(n)
                for term, tf in Counter(found).items():
                    got = postings.get(term)
                    if got is None:
                        got = postings[term] = ([], [], [])
                    got[0].append(k)
                    got[1].append(tf)
                    got[2].append(n)
            rows = list(postings.values())
            number = (part << 32) | count
            count += 1
            yield pa.RecordBatch.from_arrays([
                pa.array([number] * (len(rows) + 1), pa.int64()),
                pa.array([t.decode("utf-8") for t in postings] + [None], pa.string()),
                pa.array([r[0] for r in rows] + [None], pa.list_(pa.int32())),
                pa.array([r[1] for r in rows] + [None], pa.list_(pa.int64())),
                pa.array([r[2] for r in rows] + [lengths], pa.list_(pa.int64())),
                pa.array([None] * len(rows) + [some.column(0).to_pylist()], pa.list_(pa.int64()))], names=names)


def weight(n: Column, df: Column) -> Column:
    """floor(1000 * ln((2 N + 2) / (2 df + 1))): what a term counts."""
    return F.floor(1000 * F.log((2 * n + 2).cast("double") / (2 * df + 1).cast("double"))).cast("long")


def contributions(w, tf, n, documents: int, total: int):
    """What a term adds to each document's score, in 64-bit integers."""
    m = 100 - 90 + (90 * n * documents) // total
    return w * ((1000000000 * tf) // (1000 * tf + 8 * m))


def _advance(stage: int, last: bool, k: int, size: int, documents: int, total: int):
    """One stage: bundles of a slice and the owner's postings there to bundles with more in them."""

    def run(bundles: pa.Table, postings: pa.Table) -> pa.Table:
        rows = postings.filter(pc.is_valid(postings["term"])).combine_chunks()
        docs, tf, n = (pc.list_flatten(rows[c]).to_numpy() for c in ("docs", "tf", "n"))
        lengths = pc.list_value_length(rows["docs"]).to_numpy()
        ends = np.cumsum(lengths)
        adds = contributions(np.repeat(rows["w"].to_numpy(), lengths), tf, n, documents, total)
        where = {t: (e - x, e) for t, x, e in zip(rows["term"].to_pylist(), lengths.tolist(), ends.tolist())}
        ids = known = None
        if last:
            held = postings.filter(pc.is_null(postings["term"]))["ids"].to_pylist()
            ids = np.array([0 if i is None else i for i in held[0]] if held else [], np.int64)
            known = np.array([i is not None for i in held[0]] if held else [], bool)
        out_docs, out_scores = [], []
        acc = np.zeros(size, np.int64)
        for terms, owners, caps, old, scores in zip(*(bundles[c].to_pylist() for c in ("terms", "owners", "caps", "docs", "scores"))):
            acc[:] = 0
            acc[old] = scores
            rest = 0
            for term, owner, cap in zip(terms, owners, caps):
                if owner == stage and term in where:
                    at, end = where[term]
                    acc[docs[at:end]] += adds[at:end]
                elif owner > stage:
                    rest += cap
            found = np.flatnonzero(acc)
            got = acc[found]
            if len(found) > k:
                keep = got + rest >= np.partition(got, -k)[-k]
                found, got = found[keep], got[keep]
            if last:
                best = np.lexsort((ids[found], known[found], -got))[:k]
                found, got = [int(ids[j]) if known[j] else None for j in found[best]], got[best]
            out_docs.append(found)
            out_scores.append(got)
        kept = bundles.select(["slice", "block", "item_id", "terms", "owners", "caps"])
        return kept.append_column("docs", pa.array(out_docs, pa.list_(pa.int64()))).append_column(
            "scores", pa.array(out_scores, pa.list_(pa.int64())))

    return run


def search(texts: DataFrame, queries: DataFrame, k: int = 10, doc_id: str = "doc_id", text: str = "text",
           item_id: str = "item_id", item_text: str = "text", owners: int = OWNERS, size: int = SLICE,
           block: int = QUERIES) -> DataFrame:
    """(item_id, rank, doc_id, score): each query's ``k`` best documents with a score above 0.

    Terms, weights and scores are those of ``terms_of``, ``weight`` and ``contributions``; a query
    counts a term once. Equal scores stand by document id, nulls first. Every row of ``texts`` is a
    document of its own, repeated or null ids included; rows of ``queries`` with the same (or a null)
    id are one query. Texts that are null, empty or without terms match nothing, and queries without a term
    in any document have no rows; nor has an empty table. Other columns are left out, whatever their names.
    """
    spark = texts.sparkSession
    ship(spark)
    asked = map_arrow(queries.select(F.col(item_id).cast("long").alias("item_id"), F.col(item_text).cast("binary").alias("data")),
                      _spelled, "item_id long, term string").distinct()
    asked = stored(asked, "query-terms")
    narrow = texts.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("binary").alias("data"))
    inverted = map_arrow(narrow, lambda b: _inverted(b, size),
                         "slice long, term string, docs array<int>, tf array<long>, n array<long>, ids array<long>")
    wanted = asked.select(F.col("term").alias("_t")).distinct()
    inverted = stored(inverted.join(wanted, F.col("term") == F.col("_t"), "left").where("term is null or _t is not null").drop("_t"),
                      "postings")
    per_slice = inverted.where("term is null").select(
        F.size(F.filter("n", lambda x: x > 0)).alias("filled"), F.aggregate("n", F.lit(0).cast("long"), lambda a, x: a + x).alias("words"))
    documents, total = (x or 0 for x in per_slice.agg(F.sum("filled"), F.sum("words")).first())
    total = max(total, 1)

    terms = inverted.where("term is not null").groupBy("term").agg(
        F.sum(F.size("docs")).cast("long").alias("df"), F.max(F.array_max("tf")).alias("tf_high"), F.min(F.array_min("n")).alias("n_low"))
    terms = stored(terms.withColumn("w", weight(F.lit(documents), F.col("df"))), "term-weights")
    # no posting of a term adds more than its highest tf in its shortest document would
    cap = F.expr(f"w * ((1000000000L * tf_high) div (1000L * tf_high + 8L * (10L + (90L * n_low * {documents}L) div {total}L)))")
    cuts = terms.agg(F.percentile("df", F.array(*[F.lit((j + 1) / owners) for j in range(owners - 1)]), F.col("df"))).first()[0] if owners > 1 else None
    owner = sum((F.when(F.col("df") > c, 1).otherwise(0) for c in cuts or []), F.lit(0)).cast("int")
    terms = terms.select("term", "w", owner.alias("owner"), cap.alias("cap"))

    items = stored(asked.join(terms, "term").groupBy("item_id").agg(
        F.sort_array(F.collect_list(F.struct("owner", "term", "cap"))).alias("t")).select(
        "item_id", F.col("t.term").alias("terms"), F.col("t.owner").alias("owners"), F.col("t.cap").alias("caps")), "queries")
    blocks = max(1, -(-items.count() // block))
    every = F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)))
    postings = inverted.join(terms.drop("cap"), "term", "left").withColumn("block", every)
    shape = "slice long, block int, item_id long, terms array<string>, owners array<int>, caps array<long>, docs array<long>, scores array<long>"
    bundles = inverted.where("term is null").select("slice", every.alias("block")).join(
        items.withColumn("block", F.pmod(F.xxhash64("item_id"), F.lit(blocks)).cast("int")), "block").select(
        "slice", "block", "item_id", "terms", "owners", "caps",
        F.array().cast("array<long>").alias("docs"), F.array().cast("array<long>").alias("scores"))
    bundles = stored(bundles, "bundles")
    for stage in range(owners):
        last = stage == owners - 1
        mine = postings.where(F.col("owner") == stage)
        if last:
            mine = postings.where((F.col("owner") == stage) | F.col("term").isNull())
        mine = mine.select("slice", "block", "term", "docs", "tf", "n", "w", "ids")
        bundles = bundles.groupBy("slice", "block").cogroup(mine.groupBy("slice", "block")).applyInArrow(
            _advance(stage, last, k, size, documents, total), shape)
        bundles = stored(bundles, "bundles")
    best = bundles.select("item_id", F.inline(F.arrays_zip("docs", "scores"))).select(
        "item_id", F.col("docs").alias("doc_id"), F.col("scores").alias("score"))
    order = Window.partitionBy("item_id").orderBy(F.desc("score"), F.asc_nulls_first("doc_id"))
    return best.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("item_id", "rank", "doc_id", "score")


def _spelled(batches: Iterator[pa.RecordBatch]):
    """(id, term) of every query, a term once a row."""
    for batch in batches:
        pairs = [(i, t.decode("utf-8")) for i, x in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist())
                 for t in dict.fromkeys(terms_of(x or b""))]
        yield pa.RecordBatch.from_arrays([pa.array([p[0] for p in pairs], pa.int64()), pa.array([p[1] for p in pairs], pa.string())],
                                         names=["item_id", "term"])
