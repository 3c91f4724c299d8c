"""SimHash near-duplicates with a pigeonring filter.

Fingerprints are cut into ``max_distance + 1`` segments on a ring. If two differ in at
most ``max_distance`` bits, then from some segment on every chain of l consecutive
segments differs in at most l - 1 bits (each prefix of the chain stays within its
share of the whole budget). So the first segment of that chain is equal and the second
differs in one bit at most, which leaves one of its halves equal: those two values are the
key on which candidates meet. The longer chains and then the full distance are
checked on the candidates of a key.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyfold.llm.common import components, map_arrow, put_back, set_aside, stored

BITS = 64
#: Fingerprints of one key that are compared in one task; more are dealt out in pairs of chunks.
CHUNK = 4096
#: Groups up to this size are compared neighbour by neighbour over a whole batch.
SMALL = 16
_LOWER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")


def fingerprint(data: bytes, shingle: int, seed: int = 42) -> int:
    """Unsigned fingerprint of UTF-8 bytes: a bit is set where over half the shingles' hashes have it."""
    words = data.translate(_LOWER).split()
    if not words:
        return 0
    line = b" ".join(words)
    if len(words) <= shingle:
        return xxhash.xxh64_intdigest(line, seed)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1)
    starts = np.concatenate(([0], ends[:-shingle]))
    digest = xxhash.xxh64_intdigest
    hashes = np.fromiter(
        (digest(line[s:e], seed) for s, e in zip(starts.tolist(), (ends[shingle - 1:] - 1).tolist())),
        np.uint64, len(words) - shingle + 1)
    ones = np.unpackbits(hashes.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(
        axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(hashes), bitorder="little").view("<u8")[0])


def fingerprints(texts: DataFrame, shingle: int = 4, text: str = "text", passing: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``passing`` columns and fp, the fingerprint as a signed long, of every row. Null text: no words, 0."""
    names = [f"_p{i}" for i in range(len(passing))]
    # a text that is passed on anyway reaches the task once
    own = passing.index(text) if text in passing and isinstance(texts.schema[text].dataType, T.StringType) else None
    extra = 0 if own is not None else 1

    def run(batches: Iterator[pa.RecordBatch]):
        for batch in batches:
            data = batch.column(0 if own is None else own)
            if own is not None:
                data = data.cast(pa.large_binary() if pa.types.is_large_string(data.type) else pa.binary())
            prints = np.fromiter((fingerprint(x.as_py(), shingle) if x.is_valid else 0 for x in data),
                                 np.uint64, batch.num_rows)
            yield pa.RecordBatch.from_arrays([*batch.columns[extra:], pa.array(prints.view(np.int64))], names=[*names, "fp"])

    narrow = texts.select(*[F.col(text).cast("binary").alias("data")][:extra], *[F.col(c).alias(n) for c, n in zip(passing, names)])
    kinds = "".join(f"{n} {texts.schema[c].dataType.simpleString()}, " for c, n in zip(passing, names))
    out = map_arrow(narrow, run, kinds + "fp long")
    return out.select(*[F.col(n).alias(c) for c, n in zip(passing, names)], F.col("fp").alias("_fp"))


def segment_masks(max_distance: int) -> list[int]:
    """The ring's segments, as masks over 64 bits, lowest first."""
    count = max_distance + 1
    edges = [round(BITS * k / count) for k in range(count + 1)]
    return [(1 << high) - (1 << low) for low, high in zip(edges, edges[1:])]


def _halves(mask: int) -> list[int]:
    bits = [b for b in range(BITS) if mask >> b & 1]
    cut = bits[len(bits) // 2]
    low = mask & ((1 << cut) - 1)
    return [low, mask ^ low]


def _signed(value: int) -> int:
    return value - (1 << 64) if value >> 63 else value


def link_keys(prints: DataFrame, max_distance: int) -> DataFrame:
    """(start, key, fp): for each chain start, the first segment with each half of the second."""
    masks = segment_masks(max_distance)
    keys = []
    for i, mask in enumerate(masks):
        following = masks[(i + 1) % len(masks)]
        for half in (_halves(following) if len(masks) > 1 else [0]):
            keys.append(F.struct(F.lit(len(keys)).cast("int").alias("place"), F.lit(i).cast("int").alias("start"),
                                 F.col("fp").bitwiseAND(F.lit(_signed(mask | half))).alias("value")))
    return prints.select("fp", F.explode(F.array(*keys)).alias("k")).select(
        F.col("k.place").alias("place"), F.col("k.start").alias("start"), F.col("k.value").alias("value"), "fp")


class Chains:
    """Tests pairs of fingerprints that share the key of a chain start."""

    def __init__(self, max_distance: int):
        masks = segment_masks(max_distance)
        self.budget = max_distance
        # prefix[i][l]: the segments of the chain of l + 2 from start i on
        self.prefix = np.zeros((len(masks), max(0, len(masks) - 2)), np.uint64)
        for i in range(len(masks)):
            grown = masks[i]
            for step in range(self.prefix.shape[1]):
                grown |= masks[(i + step + 1) % len(masks)]
                self.prefix[i, step] = grown

    def linked(self, a: np.ndarray, b: np.ndarray, start: np.ndarray) -> np.ndarray:
        differ = a ^ b
        alive = np.flatnonzero(np.ones(len(differ), bool))
        for step in range(self.prefix.shape[1]):
            part = differ[alive] & self.prefix[start[alive] if np.ndim(start) else start, step]
            alive = alive[np.bitwise_count(part) <= step + 1]
        out = np.zeros(len(differ), bool)
        out[alive[np.bitwise_count(differ[alive]) <= self.budget]] = True
        return out


def spanning_links(prints: np.ndarray, start: int, chains: Chains) -> list[tuple[int, int]]:
    """Links that join what is linked within one key, at most one less than there are prints.

    Each print asks all that are not joined yet, so a tight group costs little more
    than one pass over it.
    """
    out, waiting = [], prints
    while len(waiting) > 1:
        front, waiting = [waiting[0]], waiting[1:]
        while front and len(waiting):
            one = front.pop()
            hit = chains.linked(waiting, np.full(len(waiting), one), start)
            found = waiting[hit]
            out += [(int(one), int(x)) for x in found]
            front += list(found)
            waiting = waiting[~hit]
    return out


def forest(links: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Only those of ``links`` that join something new."""
    up: dict[int, int] = {}

    def root(x):
        while up.setdefault(x, x) != x:
            up[x] = up[up[x]]
            x = up[x]
        return x

    out = []
    for a, b in links:
        ra, rb = root(a), root(b)
        if ra != rb:
            up[ra] = rb
            out.append((a, b))
    return out


def links(prints: DataFrame, max_distance: int = 4) -> DataFrame:
    """(a, b) between distinct prints (column fp): enough of the links to join all that are linked.

    A key that more than ``CHUNK`` prints share is dealt out in pairs of chunks, each
    pair to a task of its own, so no group is gathered and no link is lost. Pairs
    are never written out; a task hands on the links that join something new.
    """
    keys = link_keys(prints, max_distance)
    sizes = keys.groupBy("place", "value").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > CHUNK)
    sizes = stored(sizes.select("place", "value", F.ceil(F.col("n") / CHUNK).cast("int").alias("chunks")), "hot-keys")
    if sizes.isEmpty():
        dealt = keys.withColumn("one", F.lit(0)).withColumn("two", F.lit(0))
    else:
        mine = F.pmod(F.xxhash64("fp"), F.col("chunks")).cast("int")
        dealt = keys.join(sizes, ["place", "value"], "left").withColumn(
            "mine", F.coalesce(mine, F.lit(0))).withColumn(
            "other", F.explode(F.sequence(F.lit(0), F.coalesce(F.col("chunks"), F.lit(1)) - 1))).select(
            "place", "start", "value", "fp", F.least("mine", "other").alias("one"),
            F.greatest("mine", "other").alias("two"))

    def run(batches: Iterator[pa.RecordBatch]):
        chains = Chains(max_distance)
        held: list[np.ndarray] = []

        def compare(rows: np.ndarray, groups: np.ndarray, start: np.ndarray) -> pa.RecordBatch:
            edges = np.flatnonzero(np.concatenate(([True], groups[1:] != groups[:-1], [True])))
            sizes = np.diff(edges)
            found: list[tuple[int, int]] = []
            small = np.repeat(sizes <= SMALL, sizes)
            for step in range(1, min(SMALL, int(sizes.max(initial=1)))):
                at = np.flatnonzero(small[:-step] & (groups[step:] == groups[:-step]))
                hit = at[chains.linked(rows[at], rows[at + step], start[at])]
                found += list(zip(rows[hit].tolist(), rows[hit + step].tolist()))
            for k in np.flatnonzero(sizes > SMALL):
                s = slice(edges[k], edges[k + 1])
                found += spanning_links(rows[s], int(start[edges[k]]), chains)
            pairs = forest(found)
            columns = [np.array([p[k] for p in pairs], np.uint64).view(np.int64) for k in (0, 1)]
            return pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["a", "b"])

        for batch in batches:
            columns = [batch.column(k).to_numpy() for k in range(6)]
            held = [np.concatenate(x) for x in zip(held, columns)] if held else columns
            if not len(held[0]):
                continue
            new = np.zeros(len(held[0]), bool)
            for c in (held[0], held[2], held[4], held[5]):
                new[1:] |= c[1:] != c[:-1]
            groups = np.cumsum(new)
            last = int(np.searchsorted(groups, groups[-1]))  # the last group may go on
            if last:
                yield compare(held[3][:last].view(np.uint64), groups[:last], held[1][:last])
                held = [c[last:] for c in held]
        if held and len(held[0]):
            yield compare(held[3].view(np.uint64), np.zeros(len(held[0]), np.int64), held[1])

    columns = ["place", "start", "value", "fp", "one", "two"]
    dealt = dealt.select(columns).repartition("place", "value", "one", "two").sortWithinPartitions(
        "place", "value", "one", "two", "fp")
    return map_arrow(dealt, run, "a long, b long")


def linked_prints(prints: DataFrame, max_distance: int) -> DataFrame:
    """(fp, root): of distinct prints, the smallest print that links reach."""
    groups = components(links(prints, max_distance), "simhash")
    return prints.join(groups.withColumnRenamed("node", "fp"), "fp", "left").select(
        "fp", F.coalesce("component", "fp").alias("root"))


def near_duplicates(texts: DataFrame, shingle: int = 4, max_distance: int = 4, doc_id: str = "doc_id",
                    text: str = "text") -> DataFrame:
    """(doc_id, fingerprint, component_id) of every row.

    ``component_id`` is the smallest doc_id that links reach. Rows without words share
    the fingerprint zero. Repeated rows and null ids count like any other; a component of
    null ids only has a null id. Other columns are left out, an empty table
    gives no rows. Copies meet once per fingerprint before anything is compared.
    """
    ids = texts.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    prints = stored(fingerprints(ids, shingle).select("doc_id", F.col("_fp").alias("fp")), "prints")
    firsts = stored(prints.groupBy("fp").agg(F.min("doc_id").alias("first")), "distinct-prints")
    rooted = firsts.join(linked_prints(firsts.select("fp"), max_distance), "fp")
    lowest = rooted.groupBy("root").agg(F.min("first").alias("component_id"))
    named = rooted.join(lowest, "root").select("fp", "component_id")
    return prints.join(named, "fp").select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def keep_one(texts: DataFrame, shingle: int = 4, max_distance: int = 4, doc_id: str = "doc_id",
             text: str = "text") -> DataFrame:
    """One whole row of each component: that with the smallest doc_id (nulls last), of those the first text.

    A task hands on one row of a component at most, so a large component does not gather.
    """
    held, names = set_aside(texts)
    own = names[texts.columns.index(text)]
    prints = fingerprints(held, shingle, own, tuple(names))
    distinct = stored(fingerprints(held, shingle, own, ()).select(F.col("_fp").alias("fp")).distinct(), "distinct-prints")
    roots = stored(linked_prints(distinct, max_distance), "print-roots")
    first = [names[texts.columns.index(doc_id)], own]
    # rows that are equal in these two are told apart by all other columns that have an order
    others = [c for c in names if c not in first and _has_order(held.schema[c].dataType)]
    order = Window.partitionBy("_root").orderBy(F.asc_nulls_last(first[0]), F.asc_nulls_first(own), *[F.asc_nulls_first(c) for c in others])
    met = prints.join(roots.select(F.col("fp").alias("_fp"), F.col("root").alias("_root")), "_fp")
    return put_back(met.withColumn("_nth", F.row_number().over(order)).where("_nth = 1"), texts.columns)


def _has_order(kind) -> bool:
    if isinstance(kind, T.ArrayType):
        return _has_order(kind.elementType)
    if isinstance(kind, T.StructType):
        return all(_has_order(f.dataType) for f in kind.fields)
    return not isinstance(kind, (T.MapType, T.VariantType))
