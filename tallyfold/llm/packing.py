"""Bounded-space online packing of tokenized documents into fixed windows.

Every task keeps a fixed number of open windows. A document's tokens beyond whole
windows are placed best-fit; when none fits and no further window may be opened, the
fullest one is filled up with the head of the document and emitted. What stays open
at the end of a task is merged, some tasks at a time, by the same packer until
one group is left; its rest goes out in window lengths that are powers of two.
"""

from __future__ import annotations

import json
import os
import re
import sys
import zlib
from array import array
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyfold.llm.common import map_arrow, Memory, stored

WINDOW = 4096
OPEN_WINDOWS = 32
#: Tasks whose leftovers one merging group takes.
MERGED = 16
#: Distinct words in each of the two generations that a worker remembers the ids of.
REMEMBERED = 300_000

PIECES = T.StructType([T.StructField(n, T.LongType()) for n in (
    "doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "sequence_tokens")]
    + [T.StructField("ids", T.BinaryType()), T.StructField("part", T.LongType())])
_ARROW = pa.schema([(n, pa.int64()) for n in PIECES.names[:8]] + [("ids", pa.binary()), ("part", pa.int64())])

_encoders: dict[str, "WordEncoder"] = {}


#: ASCII without control characters and the letters of Latin-1: composed already, and of one lower case everywhere.
_PLAIN = re.compile("[\t\n\v\f\r -~\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u00ff]*")


def _ids(ids: list[int]) -> bytes:
    """Little-endian unsigned 32-bit bytes."""
    out = array("I", ids)
    if sys.byteorder == "big":
        out.byteswap()
    return out.tobytes()


class WordEncoder:
    """Ids of UTF-8 texts as little-endian unsigned 32-bit bytes.

    For vocabularies that drop white space and never join words across it, a text's
    ids are those of its words, one after the other; words are remembered. Where the file's
    pre-tokenizer is one pattern over lower-case text, a plain word's ids are those of the pattern's pieces, which
    are fewer than words (``Then,`` and ``then`` share one) and go to the model directly. All other words,
    and all words of other files, go through the whole tokenizer.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.known, self.pieces = Memory(REMEMBERED), Memory(REMEMBERED)
        self.split, self.letters, self.added = self._pieces_of(path)

    def _pieces_of(self, path: str):
        """(splitter of lower-case words, characters of bytes, contents of added tokens), no splitter for other files."""
        import regex
        from tokenizers.pre_tokenizers import ByteLevel

        with open(path, encoding="utf-8") as f:
            file = json.load(f)
        added = [t["content"].lower() for t in file.get("added_tokens") or []]
        steps = (file.get("normalizer") or {}).get("normalizers", [])
        folds = [s["type"] for s in steps] == ["NFC", "Replace", "Lowercase"] and steps[1]["pattern"] == {"Regex": "\\s+"}
        cuts = (file.get("pre_tokenizer") or {}).get("pretokenizers", [])
        plain = [c["type"] for c in cuts] == ["Split", "ByteLevel"] and cuts[0]["behavior"] == "Removed" and cuts[0]["invert"] \
            and "Regex" in cuts[0]["pattern"] and not cuts[1]["use_regex"] and not cuts[1]["add_prefix_space"]
        if not (folds and plain and file["model"]["type"] == "BPE"):
            return None, None, added
        level = ByteLevel(add_prefix_space=False, use_regex=False)
        letters = {c: level.pre_tokenize_str(chr(c))[0][0] for c in range(0xdf, 0x100) if chr(c).isalpha()}
        return regex.compile(cuts[0]["pattern"]["Regex"]).findall, letters, added

    def learn(self, words: list[bytes]) -> None:
        """Puts the ids of new words into the memory."""
        if self.split is not None:
            text = b"\n".join(words).decode("utf-8")
            if _PLAIN.fullmatch(text) is not None:
                return self._learn_plain(words, text.lower().split("\n"))
            plain = [_PLAIN.fullmatch(w.decode("utf-8")) is not None for w in words]
            some = [w for w, p in zip(words, plain) if p]
            if some:
                self._learn_plain(some, b"\n".join(some).decode("utf-8").lower().split("\n"))
            words = [w for w, p in zip(words, plain) if not p]
        self._learn_whole(words)

    def _learn_plain(self, words: list[bytes], lower: list[str]) -> None:
        split, added, known, rest = self.split, self.added, self.known.young, []
        met, piece = self.pieces.young.get, self._piece
        for word, text in zip(words, lower):
            if text.isalpha():
                known[word] = met(text) or piece(text)
            elif any([a in text for a in added]):
                rest.append(word)
            else:
                known[word] = b"".join([met(p) or piece(p) for p in split(text)])
        self.pieces.turn()
        self._learn_whole(rest)

    def _piece(self, piece: str) -> bytes:
        """The ids of a piece that is not among the young ones."""
        found = self.pieces.old.get(piece)
        if found is None:
            tokens = self.tokenizer.model.tokenize(piece if piece.isascii() else piece.translate(self.letters))
            found = _ids([t.id for t in tokens])
        self.pieces.young[piece] = found
        return found

    def _learn_whole(self, words: list[bytes]) -> None:
        if words:
            encoded = self.tokenizer.encode_batch_fast([w.decode("utf-8") for w in words], add_special_tokens=False)
            for word, e in zip(words, encoded):
                self.known.young[word] = _ids(e.ids)

    def __call__(self, data: bytes) -> bytes:
        words = data.split()
        new = self.known.missing(set(words))
        if new:
            self.learn(new)
        out = b"".join(map(self.known.young.__getitem__, words))
        self.known.turn()
        return out

    def forget(self) -> None:
        """Lets go of remembered words; a worker goes on to other tasks, which need its memory."""
        self.known, self.pieces = Memory(REMEMBERED), Memory(REMEMBERED)


def word_encoder(path: str) -> WordEncoder:
    """The worker's encoder for ``path``."""
    if path not in _encoders:
        _encoders[path] = WordEncoder(path)
    return _encoders[path]


class Packer:
    """Open windows of one task. An item is (doc_id, start, ids, doc_tokens)."""

    def __init__(self, first_id: int, window: int = WINDOW, most_open: int = OPEN_WINDOWS):
        self.window, self.most_open, self.next_id = window, most_open, first_id
        self.open: list[list] = []  # [used, items]
        self.rows: list[tuple] = []

    def emit(self, used: int, items: list[tuple]) -> None:
        offset = 0
        for doc, start, ids, total in items:
            n = len(ids) // 4
            self.rows.append((doc, start, n, zlib.crc32(ids), total, self.next_id, offset, used, None, None))
            offset += n
        self.next_id += 1

    def place(self, doc, start: int, ids: bytes, total: int) -> None:
        n, at, room = len(ids) // 4, 0, self.window
        while n - at >= room:
            self.emit(room, [(doc, start + at, ids[4 * at:4 * (at + room)], total)])
            at += room
        rest = n - at
        if not rest:
            return
        best = None
        for k, (used, _) in enumerate(self.open):
            if used + rest <= room and (best is None or used > self.open[best][0]):
                best = k
        if best is None and len(self.open) == self.most_open:
            fullest = max(range(len(self.open)), key=lambda k: self.open[k][0])
            used, items = self.open.pop(fullest)
            head = room - used
            items.append((doc, start + at, ids[4 * at:4 * (at + head)], total))
            self.emit(room, items)
            at, rest = at + head, rest - head
        item = (doc, start + at, ids[4 * at:], total)
        if best is None:
            self.open.append([rest, [item]])
            return
        self.open[best][0] += rest
        self.open[best][1].append(item)
        if self.open[best][0] == room:
            self.emit(*self.open.pop(best))

    def leftovers(self, part: int) -> None:
        """The open windows' items as rows that carry their ids on."""
        for _, items in self.open:
            self.rows += [(doc, start, len(ids) // 4, None, total, None, None, None, ids, part)
                          for doc, start, ids, total in items]
        self.open = []

    def finish(self) -> None:
        """Items end to end in whole windows, the rest in powers of two: no padding."""
        items = [item for _, items in self.open for item in items]
        self.open, left = [], sum(len(ids) // 4 for _, _, ids, _ in items)
        while left:
            size = self.window if left >= self.window else 1 << (left.bit_length() - 1)
            taken, need = [], size
            while need:
                doc, start, ids, total = items.pop(0)
                n = min(need, len(ids) // 4)
                taken.append((doc, start, ids[:4 * n], total))
                if 4 * n < len(ids):
                    items.insert(0, (doc, start + n, ids[4 * n:], total))
                need -= n
            self.emit(size, taken)
            left -= size

    def batch(self) -> pa.RecordBatch:
        rows, self.rows = self.rows, []
        columns = list(zip(*rows)) if rows else [()] * len(_ARROW)
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, _ARROW)], schema=_ARROW)


def _first_id(step: int, part: int) -> int:
    return ((step << 24) | part) << 32


def pack(texts: DataFrame, tokenizer: str, end_id: int = 2, window: int = WINDOW,
         most_open: int = OPEN_WINDOWS, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset, sequence_tokens.

    A document's tokens are its ids and ``end_id``; a null or empty text has only
    that. Rows with the same or a null doc_id are documents of their own. Other columns,
    whatever their names, are left out; an empty table gives no rows. Texts are not
    shuffled; only open windows (``most_open`` a task) move. The first pass is stored, so
    sequence ids hold whatever happens later.
    """
    narrow = texts.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("binary").alias("data"))
    tail = end_id.to_bytes(4, "little")

    def first(batches: Iterator[pa.RecordBatch]):
        encode, part = word_encoder(tokenizer), TaskContext.get().partitionId()
        packer = Packer(_first_id(0, part), window, most_open)
        for batch in batches:
            for doc, data in zip(batch.column(0).to_pylist(), batch.column(1)):
                ids = (encode(data.as_py()) if data.is_valid else b"") + tail
                packer.place(doc, 0, ids, len(ids) // 4)
            yield packer.batch()
        encode.forget()
        packer.leftovers(part)
        yield packer.batch()

    parts = max(1, narrow.rdd.getNumPartitions())
    rows = stored(map_arrow(narrow, first, PIECES), "packed")
    done, step = rows.where(F.col("ids").isNull()), 0
    while True:
        step, parts = step + 1, -(-parts // MERGED)
        merged = _merge(rows.where(F.col("ids").isNotNull()), step, parts, window, most_open)
        rows = stored(merged, "packed")
        done = done.unionByName(rows.where(F.col("ids").isNull()))
        if parts == 1:
            return done.drop("ids", "part")


def _merge(left: DataFrame, step: int, parts: int, window: int, most_open: int) -> DataFrame:
    """Leftovers of ``MERGED`` tasks at a time through one packer each."""
    last = parts == 1

    def run(batches: Iterator[pa.RecordBatch]):
        packer, group = None, None

        def close():
            if packer is not None:
                packer.finish() if last else packer.leftovers(group)
                yield packer.batch()

        for batch in batches:
            for row in batch.to_pylist():
                if row["part"] != group:
                    yield from close()
                    group = row["part"]
                    packer = Packer(_first_id(step, group), window, most_open)
                packer.place(row["doc_id"], row["start"], row["ids"], row["doc_tokens"])
        yield from close()

    grouped = left.withColumn("part", F.floor(F.col("part") / MERGED))
    dealt = grouped.repartition(max(1, min(parts, 1024)), "part").sortWithinPartitions(
        "part", "doc_id", "start", "length", "ids")
    return map_arrow(dealt, run, PIECES)
