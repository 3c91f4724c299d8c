"""Quality rules: counts over words and lines, and compression bands.

A text that zstandard shrinks far below what prose of its length reaches repeats
itself; one that hardly shrinks is noise. Both are judged over the whole document
and over every fixed chunk, each against the limits of its own length. The limits come
from the table itself: quartiles of the ratios of each length class, widened by a
multiple of their distance, so they follow its languages and lie close around its prose.
"""

from __future__ import annotations

import math
from collections import Counter
from dataclasses import dataclass, replace

import numpy as np
import pandas as pd
import zstandard
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyfold.llm.common import map_pandas, put_back, refuse_clash, set_aside

#: (bytes below which the row holds, lowest ratio, highest ratio) of a whole document.
#: For length classes of which a table has too few texts to take quartiles from.
#: Short texts carry the frame's fixed cost and little context, so their band sits higher.
#: Prose reaches 0.35 to 0.55 at some kilobytes; hexadecimal digits stay near 0.57, base 64
#: near 0.76, and a passage said over and over falls below 0.2.
DOCUMENT_BANDS = ((512, 0.35, 0.85), (2048, 0.30, 0.75), (8192, 0.25, 0.60), (float("inf"), 0.20, 0.55))
#: The same for one chunk.
CHUNK_BANDS = ((512, 0.35, 0.85), (2048, 0.30, 0.75), (float("inf"), 0.22, 0.62))


@dataclass(frozen=True)
class CompressionRules:
    """``bad_chunks``: the share of a document's chunk bytes that may lie outside their band.

    ``spread`` times the distance between a class's quartiles (``least_distance`` at least) is added on both sides
    of them; classes with fewer than ``least_class`` texts or chunks keep the fixed bands.
    """

    level: int = 3
    chunk_bytes: int = 4096
    least_chunk: int = 256
    bad_chunks: float = 0.34
    document_bands: tuple = DOCUMENT_BANDS
    chunk_bands: tuple = CHUNK_BANDS
    least_words: int = 50
    repeat_percent: int = 50
    spread: float = 3.5
    least_distance: float = 0.01
    least_class: int = 40


def _band(bands, n: int) -> tuple[float, float]:
    return next((low, high) for below, low, high in bands if n < below)


def repeated_window_words(words: list[bytes]) -> int:
    """Words that lie in a 3-word window found twice or more."""
    n = len(words) - 2
    if n < 2:
        return 0
    windows = list(zip(words, words[1:], words[2:]))
    seen = Counter(windows)
    if len(seen) == n:
        return 0
    hit = np.fromiter((seen[w] > 1 for w in windows), dtype=bool, count=n)
    covered = np.zeros(n + 2, dtype=bool)
    for k in range(3):
        covered[k:n + k] |= hit
    return int(covered.sum())


def base_counts(data: bytes) -> tuple[int, int, int, int, int]:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words of UTF-8 bytes.

    ``bytes.split()`` parts at exactly space, tab, line feed, vertical tab, form feed
    and carriage return.
    """
    words = data.split()
    # Continuation bytes 10xxxxxx start no code point.
    chars = len(b"".join(words).translate(None, _CONTINUATION))
    symbols = len(data) - len(data.translate(None, b"#*$%&|<>"))
    lines = [x for x in data.split(b"\n") if x.strip()]
    return len(words), chars, symbols, len(lines) - len(set(lines)), repeated_window_words(words)


_CONTINUATION = bytes(range(0x80, 0xC0))


def band_verdict(data: bytes, rules: CompressionRules, packer: zstandard.ZstdCompressor) -> tuple[float, float, bool]:
    """Ratio of the whole, share of chunk bytes outside their band, and whether it stays."""
    n = len(data)
    if not n:
        return 0.0, 0.0, False
    ratio = len(packer.compress(data)) / n
    low, high = _band(rules.document_bands, n)
    bad = total = 0
    for at in range(0, n, rules.chunk_bytes):
        chunk = data[at:at + rules.chunk_bytes]
        if len(chunk) < rules.least_chunk and total:
            continue  # a short rest says nothing by itself; it is part of the whole
        bounds = _band(rules.chunk_bands, len(chunk))
        part = ratio if len(chunk) == n else len(packer.compress(chunk)) / len(chunk)
        total += len(chunk)
        bad += 0 if bounds[0] <= part <= bounds[1] else len(chunk)
    share = bad / total
    return ratio, share, low <= ratio <= high and share <= rules.bad_chunks


#: Steps of a ratio that are counted.
STEPS = 10_000


def length_class(n: int) -> int:
    """Two classes for each doubling of the length."""
    return math.floor(2 * math.log2(n))


def _first_above(length_class_: int) -> int:
    """The smallest length of the next class."""
    n = math.ceil(2 ** ((length_class_ + 1) / 2))
    while length_class(n) <= length_class_:
        n += 1
    while n > 1 and length_class(n - 1) > length_class_:
        n -= 1
    return n


def ratio_quartiles(texts: DataFrame, rules: CompressionRules, text: str = "text") -> list[tuple[int, int, int, float, float]]:
    """(0 for documents and 1 for chunks, length class, number, first and third quartile), over all texts the base rules pass.

    Ratios are counted in steps of 1 / ``STEPS``; the counts add up in any order, so the quartiles are exact to a step
    and the same however the table is cut. One row per class reaches the driver.
    """

    def run(batches):
        packer = zstandard.ZstdCompressor(level=rules.level)
        for batch in batches:
            rows: Counter = Counter()
            for value in batch["_text"]:
                data = b"" if value is None else value.encode("utf-8", "surrogatepass")
                if not data or _base_failed(base_counts(data), rules):
                    continue
                ratio = len(packer.compress(data)) / len(data)
                rows[0, length_class(len(data)), int(ratio * STEPS)] += 1
                for at in range(0, len(data), rules.chunk_bytes):
                    chunk = data[at:at + rules.chunk_bytes]
                    if len(chunk) < rules.least_chunk and at:
                        continue
                    part = ratio if len(chunk) == len(data) else len(packer.compress(chunk)) / len(chunk)
                    rows[1, length_class(len(chunk)), int(part * STEPS)] += 1
            yield pd.DataFrame([(*k, n) for k, n in rows.items()], columns=["kind", "size", "step", "n"])

    counted = map_pandas(texts.select(F.col(text).alias("_text")), run, "kind long, size long, step long, n long")
    counts = counted.groupBy("kind", "size", "step").agg(F.sum("n").alias("n"))
    # a class has one row per step of a ratio at most
    up_to = F.sum("n").over(Window.partitionBy("kind", "size").orderBy("step"))
    whole = F.sum("n").over(Window.partitionBy("kind", "size"))
    placed = counts.select("kind", "size", "step", up_to.alias("up_to"), whole.alias("whole"))

    def quartile(share):
        return (F.min(F.when(F.col("up_to") >= share * F.col("whole"), F.col("step"))) / STEPS).alias(f"q{share}")

    rows = placed.groupBy("kind", "size").agg(F.max("whole").alias("whole"), quartile(0.25), quartile(0.75)).collect()
    return sorted((r[0], r[1], r[2], r[3], r[4]) for r in rows)


def fitted_bands(quartiles: list[tuple[int, int, int, float, float]], rules: CompressionRules) -> CompressionRules:
    """``rules`` with a band for every length class that has enough texts, the fixed ones elsewhere."""
    out = []
    for kind, fixed in enumerate((rules.document_bands, rules.chunk_bands)):
        known = {size: (low, high) for k, size, n, low, high in quartiles if k == kind and n >= rules.least_class}
        bands = []
        for size in range(max(known, default=-1) + 1):
            if size in known:
                low, high = known[size]
                reach = rules.spread * max(high - low, rules.least_distance)
                bands.append((_first_above(size), low - reach, high + reach))
            else:
                bands.append((_first_above(size), *_band(fixed, max(1, _first_above(size) - 1))))
        above = bands[-1][0] if bands else 0
        out.append(tuple(bands) + tuple(b for b in fixed if b[0] > above))
    return replace(rules, document_bands=out[0], chunk_bands=out[1])


def _base_failed(counts: tuple[int, int, int, int, int], rules: CompressionRules) -> bool:
    return counts[0] < rules.least_words or 100 * counts[4] > rules.repeat_percent * counts[0]


SCHEMA = T.StructType([T.StructField(n, T.LongType()) for n in (
    "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")] + [
    T.StructField("base_failed", T.BooleanType()), T.StructField("kept", T.BooleanType()),
    T.StructField("ratio", T.DoubleType()), T.StructField("bad_chunk_share", T.DoubleType())])


def judge(texts: DataFrame, rules: CompressionRules | None = None, text: str = "text",
          passing: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``passing`` columns of every row with the counts and verdicts of its whole text.

    Without ``rules`` the bands are fitted to the table first, which reads it once more. A null or empty text has no
    words and ratio 0 and fails. Repeated rows are judged each. Other columns of the input, whatever their
    names, are left out; one in ``passing`` that is named like a result raises a ``ValueError``.
    Texts are not shuffled; a task holds one Arrow batch.
    """
    refuse_clash(passing, SCHEMA.names)
    if rules is None:
        rules = fitted_bands(ratio_quartiles(texts, CompressionRules(), text), CompressionRules())
    schema = T.StructType([T.StructField(f"_p{i}", texts.schema[c].dataType) for i, c in enumerate(passing)]
                          + SCHEMA.fields)
    names = [f"_p{i}" for i in range(len(passing))]
    # a text that is passed on anyway reaches the task once
    own = names[passing.index(text)] if text in passing else "_text"

    def run(batches):
        packer = zstandard.ZstdCompressor(level=rules.level)
        for batch in batches:
            rows = []
            for value in batch[own]:
                data = b"" if value is None else value.encode("utf-8", "surrogatepass")
                counts = base_counts(data)
                failed = _base_failed(counts, rules)
                ratio, share, stays = band_verdict(data, rules, packer)
                rows.append((*counts, failed, stays and not failed, ratio, share))
            out = batch[names].copy()
            for k, field in enumerate(SCHEMA.fields):
                out[field.name] = [r[k] for r in rows]
            yield out

    narrow = texts.select(*[F.col(c).alias(n) for c, n in zip(passing, names)],
                          *([F.col(text).alias("_text")] if own == "_text" else []))
    judged = map_pandas(narrow, run, schema)
    return judged.select(*[F.col(n).alias(c) for c, n in zip(passing, names)], *SCHEMA.names)


def keep_good(texts: DataFrame, rules: CompressionRules | None = None, text: str = "text") -> DataFrame:
    """The rows of ``texts`` whose text passes, with their own columns, whatever these are called."""
    held, names = set_aside(texts)
    return put_back(judge(held, rules, names[texts.columns.index(text)], tuple(names)).where("kept"), texts.columns)
