"""Nearest neighbours by largest inner product, with cross-polytope hashing.

Vectors are brought onto one sphere (an extra coordinate makes up for the length), turned
by fast pseudo-rotations (random signs and a Hadamard transform, three times) and
assigned to the nearest signed axis. Several turned tables are kept; a query looks into
the buckets of its nearest axes in each (multiprobe), and what it finds is ranked
by exact inner products of the vectors as given.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallyfold.llm.common import map_arrow, stored

TABLES = 16
#: Buckets a query looks into in each table, at least.
PROBES = 10
#: Candidates that a query's buckets of one table must hold together; it looks further until they do.
LEAST = 400
#: Vectors of a bucket that one task compares; a larger bucket is dealt out in chunks.
CHUNK = 8192
_QUERY_BLOCK = 512


def hadamard(x: np.ndarray) -> np.ndarray:
    """Orthogonal Hadamard transform of every row; the width is a power of two."""
    n, width, half = len(x), x.shape[1], 1
    while half < width:
        x = x.reshape(n, -1, 2, half)
        x = np.stack((x[:, :, 0] + x[:, :, 1], x[:, :, 0] - x[:, :, 1]), axis=2).reshape(n, width)
        half *= 2
    return x / np.sqrt(width)


class Rotations:
    """The pseudo-rotations of all tables, the same wherever they are made."""

    def __init__(self, size: int, tables: int, seed: int = 17):
        self.width = 1 << int(size).bit_length()  # room for the extra coordinate
        self.signs = np.random.default_rng(seed).choice([-1.0, 1.0], (tables, 3, self.width))

    def turned(self, x: np.ndarray, table: int) -> np.ndarray:
        for signs in self.signs[table]:
            x = hadamard(x * signs)
        return x

    def padded(self, x: np.ndarray, extra: np.ndarray) -> np.ndarray:
        out = np.zeros((len(x), self.width))
        out[:, :x.shape[1]] = x
        out[:, x.shape[1]] = extra
        return out


def nearest_axes(turned: np.ndarray, count: int) -> np.ndarray:
    """The ``count`` nearest signed axes of every row, nearest first; axis a is 2a, its opposite 2a + 1."""
    both = np.empty((len(turned), 2 * turned.shape[1]))
    both[:, ::2], both[:, 1::2] = turned, -turned
    if count >= both.shape[1]:
        return np.argsort(-both, axis=1, kind="stable")
    near = np.argpartition(-both, count - 1, axis=1)[:, :count]
    order = np.argsort(-np.take_along_axis(both, near, 1), axis=1, kind="stable")
    return np.take_along_axis(near, order, 1)


def usable(vectors: DataFrame, vec_id: str, vector: str) -> DataFrame:
    """(vec_id, v) of rows that take part: a non-null id and a finite vector that is not zero, as doubles."""
    v = F.col("v")
    rows = vectors.select(F.col(vec_id).cast("long").alias("vec_id"), F.col(vector).cast("array<double>").alias("v"))
    fine = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return rows.where(F.col("vec_id").isNotNull() & v.isNotNull() & fine & F.exists(v, lambda x: x != 0))


def _matrix(column: pa.Array, size: int) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(-1, size) if size else np.zeros((len(column), 0))


def _nearest(pairs: tuple[np.ndarray, np.ndarray, np.ndarray], keep: int):
    """Of (query, vector, score) the ``keep`` best of each query, each vector once."""
    query, vector, score = pairs
    order = np.lexsort((vector, -score, query))
    query, vector, score = query[order], vector[order], score[order]
    new = np.ones(len(query), bool)
    new[1:] = (query[1:] != query[:-1]) | (vector[1:] != vector[:-1])  # equal vectors have equal scores
    query, vector, score = query[new], vector[new], score[new]
    first = np.flatnonzero(np.concatenate(([True], query[1:] != query[:-1]))) if len(query) else np.zeros(0, int)
    rank = np.arange(len(query)) - np.repeat(first, np.diff(np.append(first, len(query))))
    return query[rank < keep], vector[rank < keep], score[rank < keep]


def search(vectors: DataFrame, queries: DataFrame, k: int = 20, tables: int = TABLES, probes: int = PROBES,
           least: int = LEAST, vec_id: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """(query_id, rank, vec_id, score): each query's k nearest of all other rows that were found.

    ``queries`` has the columns of ``vectors``; a candidate with the query's own id is
    left out. Vectors that are null, zero or hold null or non-finite components take no part,
    nor do rows without an id. Repeated rows count as one. Vectors whose length is not the usual
    one (the most frequent) take no part. An empty table gives no rows. Equal vectors are hashed
    and compared once and stand for their k + 1 smallest ids, which is all that any
    answer can hold.
    """
    keep = k + 1
    rows = usable(vectors, vec_id, vector)
    asked = usable(queries, vec_id, vector)
    sizes = rows.groupBy(F.size("v").alias("size")).agg(
        F.count(F.lit(1)).alias("n"), F.max(F.aggregate("v", F.lit(0.0), lambda a, x: a + x * x)).alias("long"))
    usual = sizes.orderBy(F.desc("n"), "size").first()
    schema = "query_id long, rank int, vec_id long, score double"
    if usual is None:
        return vectors.sparkSession.createDataFrame([], schema)
    size, longest = usual["size"], float(np.sqrt(usual["long"]))
    ranked = rows.where(F.size("v") == size).distinct().withColumn(
        "nth", F.row_number().over(Window.partitionBy("v").orderBy("vec_id"))).where(F.col("nth") <= keep)
    distinct = stored(ranked.groupBy("v").agg(
        F.min("vec_id").alias("rep"), F.sort_array(F.collect_list("vec_id")).alias("ids")), "distinct-vectors")
    asked = stored(asked.where(F.size("v") == size).distinct().withColumn("key", F.xxhash64("v")), "queries")
    asked_once = asked.groupBy("v").agg(F.min("key").alias("key"))
    turns = Rotations(size, tables)

    def index(batches: Iterator[pa.RecordBatch]):
        for batch in batches:
            x = _matrix(batch.column(0), size) / longest
            x = turns.padded(x, np.sqrt(np.maximum(0.0, 1 - (x * x).sum(axis=1))))
            for t in range(tables):
                axes = nearest_axes(turns.turned(x, t), 1)[:, 0].astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(x), t, np.int32)), pa.array(axes), batch.column(1), batch.column(0)],
                    names=["place", "axis", "id", "v"])

    hashed = map_arrow(distinct.select("v", "rep"), index, "place int, axis int, id long, v array<double>")
    counts = stored(hashed.groupBy("place", "axis").agg(F.count(F.lit(1)).alias("n")), "bucket-sizes")
    held = np.zeros((tables, 2 * turns.width), np.int64)
    for r in counts.collect():  # tables x axes rows at most, whatever the input
        held[r["place"], r["axis"]] = r["n"]
    chunks = -(-held // CHUNK)

    def probe(batches: Iterator[pa.RecordBatch]):
        for batch in batches:
            x = _matrix(batch.column(0), size)
            x = turns.padded(x / np.sqrt((x * x).sum(axis=1))[:, None], np.zeros(len(x)))
            for t in range(tables):
                axes = nearest_axes(turns.turned(x, t), held.shape[1])
                sums = np.cumsum(held[t][axes], axis=1)
                looked = np.maximum(probes, (sums < least).sum(axis=1) + 1)
                row, nth = np.nonzero(np.arange(axes.shape[1]) < looked[:, None])
                axis = axes[row, nth]
                times = chunks[t][axis]
                row, axis = np.repeat(row, times), np.repeat(axis, times)
                chunk = np.arange(len(row)) - np.repeat(np.cumsum(times) - times, times)
                for at in range(0, len(row), 20_000):
                    s = slice(at, at + 20_000)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(len(row[s]), t, np.int32)), pa.array(axis[s].astype(np.int32)),
                         pa.array(chunk[s].astype(np.int32)), batch.column(1).take(pa.array(row[s])),
                         batch.column(0).take(pa.array(row[s]))], names=["place", "axis", "chunk", "id", "v"])

    probed = map_arrow(asked_once.select("v", "key"), probe, "place int, axis int, chunk int, id long, v array<double>")
    many = F.lit(0)
    hot = [(t, a, int(chunks[t, a])) for t, a in zip(*np.nonzero(chunks > 1))]
    if hot:
        dealt = vectors.sparkSession.createDataFrame([(int(t), int(a), n) for t, a, n in hot], "place int, axis int, parts int")
        hashed = hashed.join(F.broadcast(dealt), ["place", "axis"], "left")
        many = F.pmod(F.xxhash64("id"), F.coalesce(F.col("parts"), F.lit(1))).cast("int")
    both = hashed.select("place", "axis", many.alias("chunk"), F.lit(0).alias("side"), "id", "v").unionByName(
        probed.withColumn("side", F.lit(1)))

    def compare(batches: Iterator[pa.RecordBatch]):
        now, ids, candidates = None, [], []
        found: list[tuple] = []
        total = 0

        def asked_block(query_ids: np.ndarray, queries: np.ndarray):
            c_ids, c = np.concatenate(ids), np.concatenate(candidates)
            for at in range(0, len(queries), _QUERY_BLOCK):
                q = queries[at:at + _QUERY_BLOCK]
                scores = q @ c.T
                n = min(keep, len(c))
                edge = np.partition(scores, len(c) - n, axis=1)[:, len(c) - n]
                # both ways to sum err by less than size roundings of the lengths' product; equal scores all stay
                margin = 4 * (size + 2) * np.finfo(float).eps * np.sqrt((q * q).sum(axis=1) * (c * c).sum(axis=1).max())
                with np.errstate(invalid="ignore"):
                    floor = edge - margin
                row, near = np.nonzero(scores >= np.where(np.isfinite(floor), floor, -np.inf)[:, None])
                # the score that counts: one product after the other, in double precision
                exact = np.zeros(len(near))
                for d in range(size):
                    exact += q[row, d] * c[near, d]
                yield _nearest((query_ids[at:at + _QUERY_BLOCK][row], c_ids[near], exact), keep)

        for batch in batches:
            place, axis, chunk, side, row_ids = (batch.column(k).to_numpy() for k in range(5))
            x = _matrix(batch.column(5), size)
            new = np.ones(len(place), bool)
            for c in (place, axis, chunk, side):
                new[1:] &= c[1:] == c[:-1]
            edges = np.append(np.flatnonzero(np.concatenate(([True], ~new[1:]))), len(place)) if len(place) else [0]
            for a, b in zip(edges[:-1], edges[1:]):
                key = int(place[a]), int(axis[a]), int(chunk[a])
                if side[a] == 0:
                    if key != now:
                        now, ids, candidates = key, [], []
                    ids.append(row_ids[a:b])
                    candidates.append(x[a:b])
                elif key == now:
                    for part in asked_block(row_ids[a:b], x[a:b]):
                        found.append(part)
                        total += len(part[0])
                        if total > 2_000_000:
                            found = [_nearest(tuple(np.concatenate(p) for p in zip(*found)), keep)]
                            if len(found[0][0]) > 1_000_000:
                                yield from _out(found[0])
                                found = []
                            total = sum(len(p[0]) for p in found)
        if found:
            yield from _out(_nearest(tuple(np.concatenate(p) for p in zip(*found)), keep))

    grouped = both.select("place", "axis", "chunk", "side", "id", "v").repartition("place", "axis", "chunk").sortWithinPartitions(
        "place", "axis", "chunk", "side", "id")
    pairs = map_arrow(grouped, compare, "key long, rep long, score double")
    order = Window.partitionBy("key").orderBy(F.desc("score"), "rep")
    best = pairs.groupBy("key", "rep").agg(F.max("score").alias("score")).withColumn(
        "nth", F.row_number().over(order)).where(F.col("nth") <= keep)
    named = best.join(distinct.select("rep", "ids"), "rep").groupBy("key").agg(
        F.collect_list(F.struct("score", "ids")).alias("near"))
    # k + 1 structs of k + 1 ids at most stand behind a query
    answers = asked.select(F.col("vec_id").alias("query_id"), "key").join(named, "key").select(
        "query_id", F.inline(F.flatten(F.transform("near", lambda s: F.transform(
            s["ids"], lambda i: F.struct(s["score"].alias("score"), i.alias("vec_id"))))))).where("query_id <> vec_id")
    last = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return answers.withColumn("rank", F.row_number().over(last)).where(F.col("rank") <= k).select(
        "query_id", "rank", "vec_id", "score")


def _out(pairs: tuple):
    for at in range(0, len(pairs[0]), 50_000):
        yield pa.RecordBatch.from_arrays([pa.array(p[at:at + 50_000]) for p in pairs], names=["key", "rep", "score"])
