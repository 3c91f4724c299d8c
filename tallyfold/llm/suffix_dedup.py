"""Removal of long byte strings that occur more than once, found with suffix arrays.

A string of ``length`` bytes that starts at two places is cut at both. The corpus is
never sorted as a whole. Every window of ``length`` bytes selects one anchor, the
smallest of its ``gram``-byte hashes (winnowing), so equal windows select equal anchors
and lie in the piece of text around theirs. Pieces meet by anchor:

* an anchor seen once has no repeated window;
* an anchor whose pieces are all equal has only repeated ones;
* the others' distinct pieces are put end to end, their suffixes sorted in two stages
  (``suffix_array``), and runs of adjacent suffixes with a common prefix of ``length``
  bytes are the repeated windows. Where very many pieces share an anchor, they are first
  parted into stretches that share more than it.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyfold.llm.common import dealt_join, map_arrow, refuse_clash, stored

LENGTH = 200
GRAM = 64
#: Stretches that a piece's windows are parted into by where in them the anchor lies.
CLASSES = 4
#: Distinct pieces of one anchor that are sorted together (with ``LENGTH`` about 1.4 MB); more
#: are parted into stretches, and stretches beyond it go by their windows' digests.
TOGETHER = 4096
#: Occurrences of an anchor that one task joins with what is known of it.
DEALT = 20_000
#: Bytes of pieces sorted at once.
SORTED_BYTES = 3 << 19
#: Bytes hashed at once; a longer text is hashed in overlapping blocks.
BLOCK = 1 << 18

_BASE = np.uint64(0x9E3779B97F4A7C15 | 1)
_MIX = (np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB))


def _mixed(x: np.ndarray) -> np.ndarray:
    """Every output bit depends on every input bit."""
    x = x ^ (x >> np.uint64(30))
    x *= _MIX[0]
    x ^= x >> np.uint64(27)
    x *= _MIX[1]
    x ^= x >> np.uint64(31)
    return x


_CODES = _mixed(np.arange(1, 257, dtype=np.uint64) * _BASE)
_powers: list[np.ndarray] = []


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse, modulo 2**64."""
    if not _powers or len(_powers[0]) < n:
        inverse = np.uint64(pow(int(_BASE), -1, 1 << 64))
        _powers[:] = [np.concatenate(([np.uint64(1)], np.cumprod(np.full(n, b)))) for b in (_BASE, inverse)]
    return _powers[0], _powers[1]


class Hasher:
    """Hashes of any ranges of one byte block, from sums that are taken once."""

    def __init__(self, data: np.ndarray):
        powers, self.inverse = _power_tables(BLOCK + 2 * LENGTH + 2)
        if len(data) >= len(powers):
            powers, self.inverse = _power_tables(len(data) + 1)
        self.sums = np.empty(len(data) + 1, np.uint64)
        self.sums[0] = 0
        np.cumsum(_CODES[data] * powers[:len(data)], out=self.sums[1:])

    def grams(self, n: int) -> np.ndarray:
        """Hash of the n bytes from every position that has them."""
        count = len(self.sums) - n
        return _mixed((self.sums[n:] - self.sums[:count]) * self.inverse[:count])

    def ranges(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        return _mixed((self.sums[ends] - self.sums[starts]) * self.inverse[starts])


def _window_minimum(x: np.ndarray, width: int) -> np.ndarray:
    """Smallest of the ``width`` values from every position that has them."""
    have, out = 1, x
    while have * 2 <= width:
        out = np.minimum(out[:-have], out[have:])
        have *= 2
    if have < width:
        out = np.minimum(out[:len(x) - width + 1], out[width - have:width - have + len(x) - width + 1])
    return out


def anchors(data: bytes, length: int = LENGTH, gram: int = GRAM) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(position, gram hash, piece hash) of the anchors that the windows of a text select.

    The piece of the anchor at p runs from p - (length - gram) to p + length, clipped to
    the text; the piece hash also covers where in it the anchor lies.
    """
    none = np.zeros(0, np.int64), np.zeros(0, np.uint64), np.zeros(0, np.uint64)
    total = len(data)
    if total < length:
        return none
    whole = np.frombuffer(data, np.uint8)
    before = length - gram
    out = []
    for at in range(0, total - length + 1, BLOCK):
        windows = min(BLOCK, total - length + 1 - at)
        low, high = max(0, at - before), min(total, at + windows - 1 + before + length)
        hasher = Hasher(whole[low:high])
        hashes = hasher.grams(gram)
        inside = hashes[at - low:at - low + windows - 1 + before + 1]
        # the low bits give way to the position, so ties go to the leftmost
        ranked = (inside & ~np.uint64((1 << 20) - 1)) | np.arange(len(inside), dtype=np.uint64)
        chosen = np.unique(_window_minimum(ranked, before + 1) & np.uint64((1 << 20) - 1)).astype(np.int64)
        chosen += at - low
        starts, ends = np.maximum(chosen - before, -low if low == 0 else 0), np.minimum(chosen + length, high - low)
        starts = np.maximum(starts, 0)
        pieces = hasher.ranges(starts, ends) + (chosen - starts).astype(np.uint64) * _MIX[1]
        out.append((chosen + low, hashes[chosen], pieces))
    position, hashes, pieces = (np.concatenate(x) for x in zip(*out))
    position, first = np.unique(position, return_index=True)
    return position, hashes[first], pieces[first]


def suffix_array(text: np.ndarray, depth: int, wanted: np.ndarray | None = None) -> np.ndarray:
    """Start positions of all suffixes in the order of their first ``depth`` bytes.

    ``wanted`` marks those that are asked for; others are placed only where they lead to one.

    Two stages. Only suffixes smaller than their successors are sorted directly. One
    scan over the buckets, smallest first byte first, then places the others: where a
    suffix is met whose predecessor starts with a larger byte (or an equal one and is
    larger than it), the predecessor goes to the front of its own bucket.
    """
    n = len(text)
    if not n:
        return np.zeros(0, np.int64)
    following = np.append(text[1:], 0).astype(np.int16)
    rises = following > text
    same = following == text
    if n:
        rises[-1], same[-1] = False, False  # nothing follows: larger than the empty suffix
    # a run of equal bytes takes the direction of its end
    decided = np.flatnonzero(~same)
    smaller = rises[decided[np.searchsorted(decided, np.arange(n))]]
    needed = np.ones(n, bool)
    if wanted is not None:
        # a suffix that is not sorted directly needs its successors up to one that is
        later = np.flatnonzero(smaller)
        at = np.searchsorted(later, np.flatnonzero(wanted))
        until = np.append(later, n - 1)[at]
        marks = np.zeros(n + 1, np.int64)
        np.add.at(marks, np.flatnonzero(wanted), 1)
        np.add.at(marks, until + 1, -1)
        needed = np.cumsum(marks[:-1]) > 0
    direct = np.flatnonzero(smaller & needed)
    if len(direct):
        width = min(depth, n)
        padded = np.concatenate((text, np.zeros(width, np.uint8)))
        starts = np.lib.stride_tricks.sliding_window_view(padded, width)[direct]
        direct = direct[np.argsort(starts.view(f"S{width}").ravel(), kind="stable")]
    edges = np.searchsorted(text[direct], np.arange(257)) if len(direct) else np.zeros(257, np.int64)
    fronts: list[list[np.ndarray]] = [[] for _ in range(256)]
    if not smaller[-1] and needed[-1]:
        fronts[text[-1]].append(np.array([n - 1]))  # its successor is the empty suffix, before all others
    out = []

    def induce(met: np.ndarray, byte: int) -> np.ndarray:
        """Predecessors of ``met`` to their buckets; those of this bucket are returned."""
        before = met[met > 0] - 1
        before = before[~smaller[before] & needed[before]]
        heads = text[before]
        stay = heads == byte
        later, heads = before[~stay], heads[~stay]
        order = np.argsort(heads, kind="stable")
        later, heads = later[order], heads[order]
        cuts = np.flatnonzero(np.diff(heads)) + 1
        for group in np.split(later, cuts):
            if len(group):
                fronts[text[group[0]]].append(group)
        return before[stay]

    for byte in range(256):
        queue = fronts[byte]
        k = 0
        while k < len(queue):
            out.append(queue[k])
            again = induce(queue[k], byte)
            if len(again):
                queue.insert(k + 1, again) if k + 1 == len(queue) else queue.append(again)
            k += 1
        back = direct[edges[byte]:edges[byte + 1]]
        if len(back):
            out.append(back)
            induce(back, byte)
    order = np.concatenate(out) if out else np.zeros(0, np.int64)
    return order if wanted is None else order[wanted[order]]


def adjacent_prefixes(text: np.ndarray, order: np.ndarray, depth: int) -> np.ndarray:
    """Bytes that each suffix of ``order`` shares with the one before it, ``depth`` at most."""
    n = len(text)
    out = np.zeros(len(order), np.int64)
    if len(order) < 2:
        return out
    padded = np.concatenate((text, np.zeros(depth + 16, np.uint8)))
    # the eight bytes from every position as one number, first byte lowest
    words = np.zeros(n + depth + 8, np.uint64)
    for k in range(8):
        words |= padded[k:k + len(words)].astype(np.uint64) << np.uint64(8 * k)
    alive = np.arange(1, len(order))
    one, two = order[1:], order[:-1]
    for at in range(0, depth, 8):
        differ = words[one + at] ^ words[two + at]
        full = differ == 0
        ended = ~full
        low = differ[ended]
        low &= ~low + np.uint64(1)  # the lowest bit in which they differ
        out[alive[ended]] = at + (np.bitwise_count(low - np.uint64(1)) >> 3)
        alive, one, two = alive[full], one[full], two[full]
        if not len(alive):
            break
    out[alive] = depth
    limit = np.minimum(n - order[1:], n - order[:-1])
    out[1:] = np.minimum(np.minimum(out[1:], limit), depth)
    return out


def repeated_windows(pieces: list[bytes], owners: np.ndarray, starts: np.ndarray, many: np.ndarray,
                     length: int) -> tuple[np.ndarray, np.ndarray]:
    """(piece, start in it) of the windows that occur elsewhere, in this order.

    ``owners`` and ``starts`` say which text a piece is from and where, so the same place
    of a text met in two pieces does not count twice; ``many`` marks pieces that occur
    at several places.
    """
    sizes = np.array([len(p) + 1 for p in pieces])
    text = np.frombuffer(b"\0".join(pieces) + b"\0", np.uint8)
    first = np.concatenate(([0], np.cumsum(sizes)[:-1]))
    fits = np.arange(len(text)) + length < np.repeat(first + sizes, sizes)
    order = suffix_array(text, length, fits)
    if not len(order):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    shared = adjacent_prefixes(text, order, length)
    piece = np.repeat(np.arange(len(pieces)), sizes)[order]
    within = order - first[piece]
    runs = np.cumsum(shared < length)
    place = _mixed(owners[piece]) + (starts[piece] + within).astype(np.uint64)
    edges = np.flatnonzero(np.concatenate(([True], runs[1:] != runs[:-1])))
    twice = np.maximum.reduceat(place, edges) != np.minimum.reduceat(place, edges)
    twice |= np.logical_or.reduceat(many[piece], edges)
    hit = np.zeros(len(text), bool)
    hit[order[np.repeat(twice, np.diff(np.append(edges, len(runs))))]] = True
    at = np.flatnonzero(hit)  # pieces stand one after the other, so this is the order asked for
    piece = np.repeat(np.arange(len(pieces)), sizes)[at]
    return piece, at - first[piece]


def spans_of(piece: np.ndarray, starts: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(piece, low, high): maximal runs of bytes that windows at these starts cover, per piece; both sorted."""
    if not len(starts):
        return piece, starts, starts
    new = np.flatnonzero((np.diff(starts) > length) | (np.diff(piece) != 0))
    first, last = np.append(0, new + 1), np.append(new, len(starts) - 1)
    return piece[first], starts[first], starts[last] + length


def _keyed(texts: DataFrame, text: str) -> DataFrame:
    """The text as bytes with two hashes that stand for its content."""
    data = F.coalesce(F.col(text).cast("binary"), F.lit(b""))
    return texts.select(data.alias("data")).withColumn("k1", F.xxhash64("data")).withColumn(
        "k2", F.xxhash64(F.lit(1), "data"))


def _arrow(columns: list, names: list[str]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c) if isinstance(c, np.ndarray) else c for c in columns], names=names)


def anchor_rows(texts: DataFrame, text: str, length: int, gram: int) -> DataFrame:
    """(h, piece, k1, k2, pos) of every text's anchors.

    A task gives a content twice at most, however many copies it has of it: two are enough
    to see a repeat, and copies of one content never gather on a key.
    """

    def run(batches: Iterator[pa.RecordBatch]):
        times: dict[tuple[int, int], int] = {}
        for batch in batches:
            parts: list[tuple] = []
            held = 0
            for value, k1, k2 in zip(batch.column(0), batch.column(1).to_pylist(), batch.column(2).to_pylist()):
                data = value.as_py()
                if len(data) < length or times.get((k1, k2), 0) == 2:
                    continue
                times[k1, k2] = times.get((k1, k2), 0) + 1
                position, hashes, pieces = anchors(data, length, gram)
                n = len(position)
                parts.append((hashes.view(np.int64), pieces.view(np.int64), np.full(n, k1), np.full(n, k2),
                              position.astype(np.int32)))
                held += n
                if held > 100_000:
                    yield _arrow([np.concatenate(x) for x in zip(*parts)], ["h", "piece", "k1", "k2", "pos"])
                    parts, held = [], 0
            if parts:
                yield _arrow([np.concatenate(x) for x in zip(*parts)], ["h", "piece", "k1", "k2", "pos"])

    return map_arrow(_keyed(texts, text), run, "h long, piece long, k1 long, k2 long, pos int")


def _sorted_groups(stretches: DataFrame, length: int) -> DataFrame:
    """(h, piece, low, high): repeated spans within each stretch, by suffix sorting.

    Stretches with one middle part stay together and are bounded; several such groups share
    one array.
    """

    def run(batches: Iterator[pa.RecordBatch]):
        held: list[tuple[list[np.ndarray], list[bytes]]] = []
        size, last = 0, None

        def flush():
            h, piece, owner, start, low_end, n = (np.concatenate(x) for x in zip(*(c for c, _ in held)))
            data = [x for _, some in held for x in some]
            at, low, high = spans_of(*repeated_windows(data, owner.view(np.uint64), start + low_end, n > 1, length), length)
            return _arrow([h[at], piece[at], (low_end[at] + low).astype(np.int32), (low_end[at] + high).astype(np.int32)],
                          ["h", "piece", "low", "high"])

        for batch in batches:
            if not batch.num_rows:
                continue
            core, h, piece, _, owner, start, low_end, n = (
                None if k == 3 else batch.column(k).to_numpy().astype(np.int64) for k in range(8))
            data = batch.column(3).to_pylist()
            ends = np.cumsum([len(x) for x in data])
            new = np.concatenate(([core[0] != last], core[1:] != core[:-1]))
            cuts, pos, last = np.flatnonzero(new), 0, core[-1]
            while pos < len(data):
                # a group may end where the next one begins once there is enough
                before = ends[pos - 1] if pos else 0
                enough = int(np.searchsorted(ends, before + SORTED_BYTES - size, side="right")) + 1 if size <= SORTED_BYTES else pos
                k = int(np.searchsorted(cuts, enough))
                to = int(cuts[k]) if k < len(cuts) else len(data)
                if to > pos:
                    held.append(([x[pos:to] for x in (h, piece, owner, start, low_end, n)], data[pos:to]))
                    size += int(ends[to - 1] - before)
                if k < len(cuts) and held:
                    yield flush()
                    held, size = [], 0
                pos = to
        if held:
            yield flush()

    dealt = stretches.select("core", "h", "piece", F.substring("bytes", F.col("from") + 1, F.col("to") - F.col("from")).alias(
        "bytes"), "k1", "start", "from", "n").repartition("core").sortWithinPartitions("core", "h", "piece")
    return map_arrow(dealt, run, "h long, piece long, low int, high int")


def _digested_groups(stretches: DataFrame, length: int) -> DataFrame:
    """The same where very many stretches have one middle part: windows meet by their digests.

    Equal windows add up before they are shuffled, so no group is ever gathered. As in
    ``repeated_windows``, the same place of a text met in two overlapping pieces does not count twice.
    """
    windows = stretches.select("core", "h", "piece", "n", "k1", "start", "bytes", F.explode(
        F.sequence("from", F.col("to") - length)).alias("low"))
    window = F.substring("bytes", F.col("low") + 1, F.lit(length))
    windows = windows.select("core", "h", "piece", "n", "k1", (F.col("start") + F.col("low")).alias("place"), "low",
                             F.xxhash64(window).alias("d1"), F.xxhash64(F.lit(1), window).alias("d2"))
    # a place is an owner and a position; numbers of their own keep this a hash aggregate
    repeated = windows.groupBy("core", "d1", "d2").agg(
        F.min("k1").alias("k_low"), F.max("k1").alias("k_high"), F.min("place").alias("p_low"),
        F.max("place").alias("p_high"), F.max("n").alias("most")).where(
        "k_low <> k_high or p_low <> p_high or most > 1")
    return windows.join(repeated.select("core", "d1", "d2"), ["core", "d1", "d2"]).select(
        "h", "piece", "low", (F.col("low") + length).cast("int").alias("high"))


def _parted(pieces: DataFrame, before: int, length: int) -> DataFrame:
    """Stretches of ``pieces``: (.., from, to, core, whole), windows parted by the place of the anchor in them.

    All windows of a class contain its middle part; ``core`` is its hash with the anchor's and
    the class, ``whole`` that of the stretch itself.
    """
    width = -(-(before + 1) // CLASSES)
    at, size = F.col("at"), F.octet_length("bytes")
    made = []
    for c in range(CLASSES):
        least, most = c * width, min((c + 1) * width - 1, before)
        low = F.greatest(F.lit(0), at - most)
        high = F.least(at - least, size - length)
        made.append(F.when(low <= high, F.struct(
            low.cast("int").alias("from"), (high + length).cast("int").alias("to"),
            F.xxhash64(F.lit(c), "h", F.substring("bytes", at - least + 1, F.lit(length - (most - least)))).alias("core"),
            F.xxhash64(at - low, F.substring("bytes", low + 1, high + length - low)).alias("whole"))))
    parted = pieces.withColumn("part", F.explode(F.array(*made))).where("part is not null")
    return parted.select("h", "piece", "bytes", "k1", "start", "n", "part.*")


def _verdicts(pieces: DataFrame, before: int, length: int) -> DataFrame:
    """(h, piece, low, high): the repeated spans of anchors with several distinct pieces."""
    narrow = _parted(pieces, before, length).select("h", "piece", "n", "from", "to", "core", "whole")
    shared = narrow.groupBy("core").agg(
        F.count(F.lit(1)).alias("m"), F.max("n").alias("most"), (F.min("whole") == F.max("whole")).alias("equal")).where(
        "m > 1 or most > 1")
    met = stored(narrow.join(shared, "core").select(
        "h", "piece", "core", "from", "to", "n", "m", (F.col("equal") | (F.col("n") > 1)).alias("whole"), "equal"),
        "stretches")
    whole = met.where("whole").select("h", "piece", F.col("from").alias("low"), F.col("to").alias("high"))
    # stretches that occur several times stay in the arrays as partners of the others
    mixed = met.where("not equal").join(pieces.select("h", "piece", "bytes", "k1", "start"), ["h", "piece"])
    return whole.unionByName(_sorted_groups(mixed.where(F.col("m") <= TOGETHER), length)).unionByName(
        _digested_groups(mixed.where(F.col("m") > TOGETHER), length))


def _runs(spans: Column) -> Column:
    """Overlapping and adjacent spans of an array put together."""
    def add(done: Column, one: Column) -> Column:
        last = F.try_element_at(done, F.lit(-1))
        longer = F.struct(last["low"].alias("low"), F.greatest(last["high"], one["high"]).alias("high"))
        return F.when(last["high"] >= one["low"], F.concat(F.slice(done, F.lit(1), F.size(done) - 1), F.array(longer))).otherwise(
            F.concat(done, F.array(one)))

    return F.aggregate(F.array_sort(spans), F.array().cast("array<struct<low:int,high:int>>"), add)


def repeated_spans(texts: DataFrame, text: str = "text", length: int = LENGTH, gram: int = GRAM) -> DataFrame:
    """(k1, k2, spans): per content with repeats, the covered byte ranges, some of them overlapping."""
    before = length - gram
    found = stored(anchor_rows(texts, text, length, gram), "all-anchors")
    shared = found.groupBy("h").agg(
        F.count(F.lit(1)).alias("rows_of_key"), (F.min("piece") == F.max("piece")).alias("equal")).where("rows_of_key > 1")
    repeats = stored(dealt_join(found, stored(shared, "shared-anchors"), "h", F.col("k1"), together=DEALT).drop("rows_of_key"), "anchors")
    mixed = repeats.where("not equal")
    distinct = mixed.groupBy("h", "piece").agg(
        F.count(F.lit(1)).alias("n"), F.min(F.struct("k1", "k2", "pos")).alias("at"))
    asked = distinct.select("h", "piece", "n", "at.*").groupBy("k1", "k2").agg(
        F.collect_list(F.struct("h", "piece", "n", "pos")).alias("asked"))

    def cut(batches: Iterator[pa.RecordBatch]):
        unpack = zstandard.ZstdDecompressor()
        done: set[tuple[int, int]] = set()
        for batch in batches:
            rows = []
            for k1, k2, data, asked in zip(*(c.to_pylist() for c in batch.columns)):
                if (k1, k2) in done:
                    continue  # a copy of what this task has cut already
                done.add((k1, k2))
                data = unpack.decompress(data)
                for x in asked:
                    start = max(0, x["pos"] - before)
                    rows.append((x["h"], x["piece"], data[start:x["pos"] + length], k1, start, x["n"], x["pos"] - start))
            columns = list(zip(*rows)) if rows else [()] * 7
            kinds = [pa.int64(), pa.int64(), pa.binary(), pa.int64(), pa.int32(), pa.int64(), pa.int32()]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds)],
                                             names=["h", "piece", "bytes", "k1", "start", "n", "at"])

    one_each = packed_texts(texts, text, length).join(asked, ["k1", "k2"])
    pieces = stored(map_arrow(
        one_each.select("k1", "k2", "packed", "asked"), cut,
        "h long, piece long, bytes binary, k1 long, start int, n long, at int").dropDuplicates(["h", "piece"]),
        "pieces")
    crowded = stored(pieces.groupBy("h").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > TOGETHER).select("h"),
                     "crowded-anchors")
    usual = pieces.join(crowded, "h", "left_anti").withColumn("core", F.col("h")).withColumn(
        "from", F.lit(0)).withColumn("to", F.octet_length("bytes"))
    inner = stored(_sorted_groups(usual, length).unionByName(
        _verdicts(pieces.join(crowded, "h", "left_semi"), before, length)), "inner-spans")
    # a piece has a bounded number of windows; their runs are what its occurrences are given
    per_piece = stored(inner.groupBy("h", "piece").agg(_runs(F.collect_list(F.struct("low", "high"))).alias("inner")),
                       "piece-spans")
    start = F.greatest(F.lit(0), F.col("pos") - before)
    whole = repeats.where("equal").select("k1", "k2", F.array(F.struct(
        start.alias("low"), (F.col("pos") + length).alias("high"))).alias("spans"))
    partly = mixed.join(per_piece, ["h", "piece"]).select("k1", "k2", F.transform("inner", lambda s: F.struct(
        (start + s["low"]).alias("low"), (start + s["high"]).alias("high"))).alias("spans"))
    return whole.unionByName(partly).groupBy("k1", "k2").agg(F.flatten(F.collect_set("spans")).alias("spans"))


def packed_texts(texts: DataFrame, text: str, least: int = 0, passing: tuple[str, ...] = ()) -> DataFrame:
    """``passing`` columns with the text compressed, as it travels to meet its spans."""
    names = [f"_p{i}" for i in range(len(passing))]

    def run(batches: Iterator[pa.RecordBatch]):
        pack = zstandard.ZstdCompressor(level=1)
        for batch in batches:
            packed = pa.array([pack.compress(x.as_py()) for x in batch.column(0)], pa.binary())
            yield pa.RecordBatch.from_arrays([packed, *batch.columns[1:]], names=["packed", "k1", "k2", *names])

    data = F.coalesce(F.col(text).cast("binary"), F.lit(b""))
    keyed = texts.select(data.alias("data"), F.xxhash64(data).alias("k1"), F.xxhash64(F.lit(1), data).alias("k2"),
                         *[F.col(c).alias(n) for c, n in zip(passing, names)])
    if least:
        keyed = keyed.where(F.octet_length("data") >= least)
    kinds = "".join(f", {n} {texts.schema[c].dataType.simpleString()}" for c, n in zip(passing, names))
    return map_arrow(keyed, run, "packed binary, k1 long, k2 long" + kinds)


def merged_spans(spans: pa.ListArray) -> list[list[tuple[int, int]]]:
    """For every row its sorted, disjoint, non-adjacent ranges; a null has none."""
    sizes = spans.value_lengths().fill_null(0).to_numpy()
    flat = spans.flatten()
    row = np.repeat(np.arange(len(sizes), dtype=np.int64), sizes)
    low = flat.field("low").to_numpy(zero_copy_only=False).astype(np.int64) + (row << 32)
    high = flat.field("high").to_numpy(zero_copy_only=False).astype(np.int64) + (row << 32)
    order = np.argsort(low, kind="stable")
    low, high = low[order], np.maximum.accumulate(high[order])
    out: list[list[tuple[int, int]]] = [[] for _ in sizes]
    if len(low):
        first = np.flatnonzero(np.concatenate(([True], low[1:] > high[:-1])))
        last = np.append(first[1:], len(low)) - 1
        mask = (1 << 32) - 1
        for k, a, b in zip((low[first] >> 32).tolist(), (low[first] & mask).tolist(), (high[last] & mask).tolist()):
            out[k].append((a, b))
    return out


_RESULTS = ("n_bytes", "n_removed", "n_spans", "kept_sha256", "kept")


def remove_repeats(texts: DataFrame, text: str = "text", length: int = LENGTH, gram: int = GRAM,
                   passing: tuple[str, ...] = ("doc_id",), as_text: bool = False) -> DataFrame:
    """``passing`` columns of every row, what was removed from its text, and the bytes kept.

    Adds n_bytes, n_removed, n_spans, kept_sha256 and kept (the remaining bytes; with
    ``as_text`` a string, without the rests of characters that were cut in part). Null
    counts as empty; a text shorter than ``length`` keeps all. Rows with equal text,
    repeated rows among them, are repeats of each other. Other columns are left
    out; an empty table gives no rows. A column in ``passing`` that is named like a result raises a ``ValueError``.
    """
    refuse_clash(passing, _RESULTS)
    names = [f"_p{i}" for i in range(len(passing))]
    spans = repeated_spans(texts, text, length, gram)

    def run(batches: Iterator[pa.RecordBatch]):
        unpack = zstandard.ZstdDecompressor()
        for batch in batches:
            rows = []
            for packed, gone in zip(batch.column(0), merged_spans(batch.column(1))):
                data = unpack.decompress(packed.as_py())
                at, parts = 0, []
                for low, high in gone:
                    high = min(high, len(data))
                    parts.append(data[at:low])
                    at = high
                kept = b"".join(parts) + data[at:] if gone else data
                rows.append((len(data), len(data) - len(kept), len(gone), hashlib.sha256(kept).hexdigest(),
                             kept.decode("utf-8", "ignore") if as_text else kept))
            columns = list(zip(*rows)) if rows else [()] * 5
            kinds = [pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string() if as_text else pa.binary()]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[2:], *(pa.array(c, t) for c, t in zip(columns, kinds))],
                names=[*names, "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"])

    met = packed_texts(texts, text, 0, passing).join(spans, ["k1", "k2"], "left").select("packed", "spans", *names)
    kinds = "".join(f"{n} {texts.schema[c].dataType.simpleString()}, " for c, n in zip(passing, names))
    out = map_arrow(met, run, kinds + "n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept "
                    + ("string" if as_text else "binary"))
    return out.select(*[F.col(n).alias(c) for c, n in zip(passing, names)],
                      "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept")
