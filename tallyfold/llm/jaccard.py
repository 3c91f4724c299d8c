"""Similarity join of documents by the Jaccard measure of their word n-grams.

Prefix filter with token combinations. Equal sets are put together first. Every set's tokens stand in
one order for all, rarest first; sets that are similar enough share tokens among their first ones. Tokens are
counted in the first range of hashes, where prefixes lie. One that a single set holds needs no key, rare ones are keys
by themselves, and frequent ones only in combination: pairs, or triples of very frequent ones, each
within one of some parts that tokens are dealt to. The prefix is as much longer as sharing tokens without
sharing a combination can hide, so no link is lost. Sets that share a key are compared with one set of
the key's group, and what this leaves apart is compared within the group. Parity bits of the sets bound
their difference from below and drop most pairs; what is left is decided by the exact measure.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyfold.llm.common import components, dealt_join, map_arrow, stored

#: Hashes below this share of their range come first in the order; only these are counted.
RANGE = 0.25
#: A token in at least so many sets counts in pairs, from the second figure on in triples.
FREQUENT = (32, 1024)
#: Tokens a prefix needs for each part that frequent tokens are dealt to.
PER_PART = 4
#: Bits of a set's parities.
PARITY = 512
#: Rows of a block of a large group; a task compares two blocks.
TOGETHER = 2048
#: Words a worker remembers the hashes of; beyond it the memory starts anew.
REMEMBERED = 400_000

_MULTIPLY = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93)]


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * _MULTIPLY[3]
    x = (x ^ (x >> np.uint64(29))) * _MULTIPLY[0]
    return x ^ (x >> np.uint64(32))


class Shingler:
    """Sets of 64-bit hashes of word n-grams; ASCII letters in lower case, words between ASCII white space."""

    def __init__(self, words: int):
        self.words = words
        self.known: dict[bytes, int] = {}

    def hashes(self, words: list[bytes]) -> np.ndarray:
        known = self.known
        new = [w for w in set(words) if w not in known]
        if len(known) + len(new) > REMEMBERED:
            known.clear()
            new = list(set(words))
        for w in new:
            known[w] = xxhash.xxh64_intdigest(w, 11)
        return np.array([known[w] for w in words], np.uint64)

    def __call__(self, text: bytes) -> np.ndarray:
        """The sorted set; fewer words than an n-gram has are one shingle of their own, no word is none."""
        h = self.hashes(text.lower().split())
        size = min(self.words, len(h))
        if not size:
            return h
        n = len(h) - size + 1
        out = np.full(n, size, np.uint64)
        for j in range(size):
            out = _mixed(out * _MULTIPLY[1] + h[j:j + n])
        return np.unique(out)


def words_digest(text: bytes) -> bytes:
    """128 bits of a text's words: equal for texts that differ in case and white space only."""
    return hashlib.blake2b(b" ".join(text.lower().split()), digest_size=16).digest()


def text_classes(texts: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, digest) of every row, by its words; no digest without words."""

    def run(batches: Iterator[pa.RecordBatch]):
        for batch in batches:
            digests = [words_digest(x.as_py()) if x.is_valid and x.as_py().split() else None for x in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(digests, pa.binary())], names=["doc_id", "digest"])

    narrow = texts.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("binary").alias("data"))
    return map_arrow(narrow, run, "doc_id long, digest binary")


def parity_bits(tokens: np.ndarray) -> np.ndarray:
    """Eight words of 64 bits; each bit tells whether an odd number of tokens falls on it."""
    counts = np.bincount((tokens >> np.uint64(20)) & np.uint64(PARITY - 1), minlength=PARITY)
    return np.packbits((counts & 1).astype(np.uint8)).view(np.int64)


def class_sets(texts: DataFrame, classes: DataFrame, words: int = 3, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(node, digest, times, n, bits, tokens) of the texts that stand for a class.

    ``tokens`` are the shingles' unsigned hashes in order, ``bits`` their parities.
    """

    def run(batches: Iterator[pa.RecordBatch]):
        shingler = Shingler(words)
        for batch in batches:
            for at in range(0, batch.num_rows, 1024):
                part = batch.slice(at, 1024)
                data = part.column(3).to_pylist()
                mine = [k for k, d in enumerate(part.column(1).to_pylist()) if words_digest(data[k]) == d]
                found = [shingler(data[k]) for k in mine]
                if not found:
                    continue
                sizes = [len(f) for f in found]
                offsets = np.concatenate(([0], np.cumsum(sizes))).astype(np.int32)
                bits = np.concatenate([parity_bits(f) for f in found])
                yield pa.RecordBatch.from_arrays(
                    [*part.take(pa.array(mine)).columns[:3], pa.array(sizes, pa.int64()),
                     pa.ListArray.from_arrays(pa.array(np.arange(len(found) + 1, dtype=np.int32) * (PARITY // 64)), pa.array(bits)),
                     pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate(found).view(np.int64)))],
                    names=["node", "digest", "times", "n", "bits", "tokens"])

    narrow = texts.select(F.col(doc_id).cast("long").alias("node"), F.col(text).alias("data")).where("data is not null")
    met = narrow.join(classes.select("node", "digest", "times"), "node").select(
        "node", "digest", "times", F.col("data").cast("binary").alias("data"))
    return map_arrow(met, run, "node long, digest binary, times long, n long, bits array<long>, tokens array<long>")


def _may_link(percent: int) -> Column:
    """Whether sizes ``n``, ``m`` and parities ``bits``, ``other_bits`` leave room for a link; never false for one."""
    apart = sum((F.bit_count(F.col("bits")[i].bitwiseXOR(F.col("other_bits")[i])) for i in range(1, PARITY // 64)),
                F.bit_count(F.col("bits")[0].bitwiseXOR(F.col("other_bits")[0])))
    both = F.col("n") + F.col("m")
    # a link shares percent / (100 + percent) of both sizes; the rest of both is their difference
    return (100 + percent) * (both - apart) >= 2 * percent * both


def band(n: int) -> int:
    """Sizes from one power of two to the next."""
    return n.bit_length()


def prefix_need(n: int, percent: int) -> int:
    """Tokens of a set of ``n`` of which a similar set must share one: all but the least overlap, and one."""
    return n - -(-percent * n // 100) + 1


def parts_of(size_band: int, percent: int) -> int:
    """Parts that frequent tokens are dealt to among sets of a band and their partners; 0: too small for combinations.

    Every part may take two more tokens into the prefix, and the smallest set must have them.
    """
    low = -(-percent * (1 << (size_band - 1)) // 100)
    spare = (low - prefix_need(low, percent)) // (max(len(FREQUENT), 1) + 1)
    return min(max(spare, 0), -(-prefix_need((1 << size_band) - 1, percent) // PER_PART))


def signatures(head: np.ndarray, held: np.ndarray, n: int, percent: int) -> list[int]:
    """Keys of a set: ``head`` are its first tokens by hash, ``held`` how many sets hold each (0: not counted).

    The order is: range of the hash, sets that hold the token, hash. A set's partner is in the set's own
    size band or in the next one, and the parts of both are those of the larger one's band.
    """
    need = prefix_need(n, percent)
    if (held == 1).sum() >= need:
        return []  # the prefix is its own: nothing in it is shared
    order = np.lexsort((head, held, held == 0))
    head, held = head[order], held[order]
    kinds = np.where(held == 1, 0, 1 + sum((held >= x).astype(int) for x in FREQUENT))
    out: list[int] = []
    for size_band in sorted({band(n), band(n * 100 // percent)}):
        parts = parts_of(size_band, percent)
        part = (_mixed(head) % np.uint64(max(parts, 1))).tolist()
        groups: dict[tuple[int, int], list[int]] = {}
        one, left = [], need
        for k, (token, c) in enumerate(zip(head.tolist(), kinds.tolist())):
            if c > 1 and parts:
                group = groups.setdefault((c, part[k]), [])
                group.append(token)
                left -= len(group) >= c
            else:
                if c:
                    one.append(k)
                left -= 1
            if not left:
                break
        out += _mixed(head[one] + np.full(1, size_band, np.uint64) * _MULTIPLY[1]).view(np.int64).tolist()
        for (c, _), group in groups.items():
            if len(group) >= c:
                h = np.full(1, size_band, np.uint64)
                for column in np.array(list(combinations(sorted(group), c)), np.uint64).T:
                    h = _mixed(h * _MULTIPLY[2] + column)
                out += h.view(np.int64).tolist()
    return out


def keys_of(classes: DataFrame, percent: int) -> DataFrame:
    """(key, node, n) of every set, from (node, n, tokens)."""
    limit = int(RANGE * 2 ** 64)
    # unsigned order below 2 ** 63 is signed order, and the array begins with the smallest unsigned hashes
    in_range = F.filter("tokens", lambda t: (t >= 0) & (t < limit))
    shared = stored(classes.select(F.explode(in_range).alias("token")).groupBy("token").agg(
        F.count(F.lit(1)).alias("held")).where("held > 1"), "shared-tokens")
    marked = classes.select("node", F.explode(in_range).alias("token")).join(shared, "token").groupBy("node").agg(
        F.collect_list("token").alias("shared"), F.collect_list("held").alias("held"))
    # enough of the first tokens for any prefix: those of the range, at least what combinations may ask for
    need = F.col("n") - F.ceil(F.col("n") * percent / 100) + 1
    head = F.slice("tokens", 1, F.greatest(F.size(in_range), F.least("n", 3 * need + 16)).cast("int"))
    heads = classes.select("node", "n", head.alias("head")).join(marked, "node", "left")

    def run(batches: Iterator[pa.RecordBatch]):
        for batch in batches:
            keys, nodes, sizes = [], [], []
            for node, n, head, shared, held in zip(*(batch.column(k) for k in range(5))):
                n, node = n.as_py(), node.as_py()
                tokens = head.values.to_numpy().view(np.uint64)
                counts = (tokens < np.uint64(limit)).astype(np.int64)
                if shared.is_valid:
                    mine = shared.values.to_numpy().view(np.uint64)
                    at = np.minimum(np.searchsorted(tokens, mine), len(tokens) - 1)
                    same = tokens[at] == mine
                    counts[at[same]] = held.values.to_numpy()[same]
                found = signatures(tokens, counts, n, percent)
                keys += found
                nodes += [node] * len(found)
                sizes += [n] * len(found)
            yield pa.RecordBatch.from_arrays([pa.array(keys, pa.int64()), pa.array(nodes, pa.int64()), pa.array(sizes, pa.int64())],
                                             names=["key", "node", "n"])

    return map_arrow(heads.select("node", "n", "head", "shared", "held"), run, "key long, node long, n long")


def verified(pairs: DataFrame, classes: DataFrame, percent: int) -> DataFrame:
    """Those of ``pairs`` (a, b; b the one that many pairs may share) whose sets are similar enough."""
    pairs = stored(pairs, "candidates")
    held = stored(pairs.groupBy("b").agg(F.count(F.lit(1)).alias("rows_of_key")), "candidate-sides")
    mine = stored(pairs.select("a").distinct(), "candidate-sides")
    others = classes.select(F.col("node").alias("b"), F.col("tokens").alias("other")).join(held, "b")
    both = dealt_join(pairs, others, "b", F.col("a"), held).join(
        classes.select(F.col("node").alias("a"), "tokens").join(mine, "a", "left_semi"), "a")
    common = F.size(F.array_intersect("tokens", "other"))
    return both.where(100 * common >= percent * (F.size("tokens") + F.size("other") - common)).select("a", "b")


def linked_classes(classes: DataFrame, percent: int) -> DataFrame:
    """(node, component) of the sets that links join; ``classes`` has (node, n, bits, tokens), stored."""
    keys = stored(keys_of(classes, percent), "keys")
    groups = keys.groupBy("key").agg(F.min(F.struct("node", "n")).alias("least"), F.count(F.lit(1)).alias("rows_of_key"))
    groups = stored(groups.where("rows_of_key > 1").select(
        "key", "rows_of_key", F.col("least.node").alias("pivot"), F.col("least.n").alias("m")), "key-groups")
    close = (F.least("n", "m") * 100 >= percent * F.greatest("n", "m"))
    met = stored(dealt_join(keys, groups, "key", F.col("node")).where("node <> pivot"), "met")
    bits = classes.select("node", "bits")
    # first everything against one set of its group: a line of pairs a group, however large it is
    stars = stored(met.where(close).select(F.col("node").alias("a"), F.col("pivot").alias("b"), "n", "m").distinct(), "stars")
    pivots = stored(stars.groupBy("b").agg(F.count(F.lit(1)).alias("rows_of_key")), "pivots")
    near = dealt_join(stars, bits.select(F.col("node").alias("b"), F.col("bits").alias("other_bits")).join(pivots, "b"), "b", F.col("a"), pivots)
    near = near.join(bits.withColumnRenamed("node", "a"), "a").where(_may_link(percent))
    first = stored(verified(near.select("a", "b"), classes, percent), "star-links")
    joined = stored(components(first, "stars"), "star-components")
    # then what is still apart within a group, in blocks of rows; pairs with the pivot are done
    apart = stored(met.join(joined, "node", "left").select(
        "key", "node", "n", F.coalesce("component", "node").alias("component")), "apart")
    mixed = apart.groupBy("key").agg(F.min("component").alias("low"), F.max("component").alias("high"),
                                     F.count(F.lit(1)).alias("rows_of_key")).where("low <> high").drop("low", "high")
    mixed = stored(mixed.withColumn("blocks", F.ceil(F.col("rows_of_key") / TOGETHER).cast("int")), "open-keys")
    open_ = dealt_join(apart, mixed, "key", F.col("node")).withColumn("mine", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
    open_ = stored(open_.select("key", "node", "n", "component", "blocks", "mine").join(bits, "node"), "open-groups")
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    left = open_.select("key", F.col("mine").alias("i"), other.alias("j"), F.col("node").alias("a"), "n", F.col("component").alias("ca"), "bits")
    right = open_.select("key", other.alias("i"), F.col("mine").alias("j"), F.col("node").alias("b"), F.col("n").alias("m"),
                         F.col("component").alias("cb"), F.col("bits").alias("other_bits"))
    rest = left.join(right, ["key", "i", "j"]).where(
        (F.col("ca") != F.col("cb")) & (F.col("a") < F.col("b")) & close & _may_link(percent))
    second = verified(rest.select("a", "b").distinct(), classes, percent)
    return components(first.union(second), "similar")


def similar_documents(texts: DataFrame, words: int = 3, percent: int = 90, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, n_shingles, component_id) of every row.

    Two documents are linked where ``100 * intersection >= percent * union`` of their sets of ``words``-word
    shingles; ``component_id`` is the smallest doc_id that links reach. A document with fewer words has one shingle, one
    without words (a null or empty text) none, and is linked with nothing. Rows that share a doc_id are one
    document; rows with a null one have no links and a null component. Other columns are left out, an
    empty table gives no rows. Shingles are compared by 64-bit hashes, texts of the same words by 128-bit ones.
    """
    narrow = stored(text_classes(texts, doc_id, text), "text-classes")
    real = narrow.where("digest is not null and doc_id is not null")
    # a class's tokens are those of its smallest doc_id, whose row may be there more than once
    classes = real.groupBy("digest").agg(F.min("doc_id").alias("node"), F.count(F.lit(1)).alias("rows_of_key"))
    again = real.groupBy("digest", "doc_id").agg(F.count(F.lit(1)).alias("times")).where("times > 1")
    classes = stored(classes.join(again.withColumnRenamed("doc_id", "node"), ["digest", "node"], "left"), "classes")
    whole = class_sets(texts, classes, words, doc_id, text)
    if not classes.where("times is not null").isEmpty():
        whole = whole.where("times is null").unionByName(whole.where("times is not null").dropDuplicates(["digest"]))
    sets = stored(whole.drop("times"), "class-sets")
    links = linked_classes(sets.drop("digest"), percent)
    sized = classes.drop("times").join(sets.select("digest", "n"), "digest")
    member = stored(dealt_join(real, sized, "digest", F.col("doc_id")).select("doc_id", "n", "node"), "members")
    # a doc_id with rows of several classes joins these
    several = member.groupBy("doc_id").agg(F.min("node").alias("low"), F.max("node").alias("high")).where("low <> high").select("doc_id")
    more = member.join(several, "doc_id").select(F.col("doc_id").alias("a"), F.col("node").alias("b")).where("a <> b")
    if not more.isEmpty():
        links = components(links.select(F.col("node").alias("a"), F.col("component").alias("b")).union(more), "documents")
    roots = member.groupBy("node").agg(F.count(F.lit(1)).alias("rows_of_key")).join(links, "node", "left").select(
        "node", "rows_of_key", F.coalesce("component", "node").alias("component_id"))
    found = dealt_join(member, roots, "node", F.col("doc_id")).select("doc_id", F.col("n").alias("n_shingles"), "component_id")
    wordless = narrow.where("digest is null").select("doc_id", F.lit(0).cast("long").alias("n_shingles"), F.col("doc_id").alias("component_id"))
    nameless = class_sizes(texts.where(F.col(doc_id).isNull()), words, text)
    return found.unionByName(wordless).unionByName(nameless)


def class_sizes(texts: DataFrame, words: int, text: str) -> DataFrame:
    """Rows without an id: their number of shingles, no component; rows without words are left out."""

    def run(batches: Iterator[pa.RecordBatch]):
        shingler = Shingler(words)
        for batch in batches:
            sizes = [len(shingler(x.as_py())) for x in batch.column(0) if x.is_valid]
            sizes = [n for n in sizes if n]
            yield pa.RecordBatch.from_arrays([pa.nulls(len(sizes), pa.int64()), pa.array(sizes, pa.int64()), pa.nulls(len(sizes), pa.int64())],
                                             names=["doc_id", "n_shingles", "component_id"])

    return map_arrow(texts.select(F.col(text).cast("binary").alias("data")), run, "doc_id long, n_shingles long, component_id long")
