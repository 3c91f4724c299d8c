"""N-best segmentation of texts over a SentencePiece vocabulary, and decoding.

A text's lattice has an edge for every piece that matches somewhere. One forward Viterbi
pass gives the best score of every prefix; a backward A-star search from the end takes
these scores as its heuristic, which is exact, so complete segmentations leave the queue in
the order of their scores. Where no piece reaches over a word's mark, the lattice falls
apart into words: words are searched by themselves and remembered, and the best
segmentations of the text are put together from theirs.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterable, Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyfold.llm.common import Memory, map_arrow

MARK = "▁"
#: Taken off the lowest score for a character that no piece covers.
UNKNOWN_PENALTY = 10.0
#: Words that a worker remembers before it forgets those that the last portion did not have.
REMEMBERED = 400_000
#: Words whose other ways a worker remembers.
RANKED = 50_000

#: Words of one length that go through the pass together; their rows stay in a processor's cache.
TOGETHER = 3000
#: Characters of a word, its mark included, that goes through it; longer ones are taken one by one.
TOGETHER_LENGTH = 48
#: Texts whose words are looked up together, each distinct one once, and their bytes at most (one text may have more).
PORTION, PORTION_BYTES = 2048, 8 << 20

_vocabularies: dict[str, "Vocabulary"] = {}


def _codes(words: list[str], length: int) -> np.ndarray:
    """Code points of words of one length, a row each."""
    return np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), "<u4").reshape(-1, length).astype(np.uint64)


class PieceTable:
    """Scores and ids of pieces by rolling hash, for many lookups at once.

    Two levels of slots; the multiplier is changed until every piece has one of its own.
    """

    SLOTS = 20

    def __init__(self, pieces: dict[str, tuple[int, float]]):
        names = [p for p in pieces if p]
        self.ids = np.array([-1, *(pieces[p][0] for p in names)], np.int64)
        self.scores = np.array([-np.inf, *(pieces[p][1] for p in names)])
        self.base = np.uint64(0x9E3779B97F4A7C15)
        while True:
            keys = np.zeros(len(names) + 1, np.uint64)
            for length in {len(p) for p in names}:
                rows = [k for k, p in enumerate(names, 1) if len(p) == length]
                h = np.zeros(len(rows), np.uint64)
                for c in _codes([names[k - 1] for k in rows], length).T:
                    h = self.roll(h, c)
                keys[rows] = h
            self.keys = keys
            self.one, self.two = (np.zeros(1 << self.SLOTS, np.int32) for _ in range(2))
            order = np.arange(1, len(names) + 1)
            self.one[self.slot(keys[order], 44)] = order
            rest = order[self.one[self.slot(keys[order], 44)] != order]
            self.two[self.slot(keys[rest], 20)] = rest
            if (self.two[self.slot(keys[rest], 20)] == rest).all() and len(np.unique(keys[1:])) == len(names):
                return
            self.base += np.uint64(2)

    def roll(self, h: np.ndarray, c: np.ndarray) -> np.ndarray:
        h = (h ^ c) * self.base
        return h ^ (h >> np.uint64(29))

    def slot(self, h: np.ndarray, shift: int) -> np.ndarray:
        return ((h >> np.uint64(shift)) & np.uint64((1 << self.SLOTS) - 1)).astype(np.int64)

    def find(self, h: np.ndarray) -> np.ndarray:
        """Row of the piece with each hash, 0 where there is none."""
        got = self.one[self.slot(h, 44)]
        miss = self.keys[got] != h
        second = self.two[self.slot(h[miss], 20)]
        got[miss] = np.where(self.keys[second] == h[miss], second, 0)
        return got


def ranges(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The numbers from every start on, as many as its size, one run after the other."""
    ends = np.cumsum(sizes)
    return np.arange(ends[-1] if len(ends) else 0) + np.repeat(starts - ends + sizes, sizes)


def binaries(data: np.ndarray, sizes: np.ndarray) -> pa.Array:
    """Pieces of ``data``, one after the other, as binary values of so many bytes."""
    ends = np.append(0, np.cumsum(sizes)).astype(np.int64)
    return pa.Array.from_buffers(pa.large_binary(), len(sizes), [None, pa.py_buffer(ends), pa.py_buffer(data)])


def by_length(words: Iterable[str]) -> dict[int, list[str]]:
    """Words by their length."""
    out: dict[int, list[str]] = {}
    for w in words:
        out.setdefault(len(w), []).append(w)
    return out


def join_ways(known: tuple, more: tuple) -> tuple:
    """Columns of ways (starts, sizes, scores, losses, ids) followed by more (sizes, scores, losses, ids)."""
    starts, sizes, scores, losses, ids = known
    own = len(ids) + np.cumsum(more[0]) - more[0]
    return tuple(np.concatenate(c) for c in ((starts, own), (sizes, more[0]), (scores, more[1]), (losses, more[2]), (ids, more[3])))


class KnownWords:
    """The best ways of words that a worker remembers, in columns; with too many, those of the last portion stay."""

    def __init__(self):
        self.rows: dict[str, int] = {}
        self.stored = (*(np.zeros(0, t) for t in (np.int64, np.int64, float, float)), np.zeros(0, "<u4"))
        self.fresh: list[tuple] = []

    def add(self, words: list[str], *ways: np.ndarray) -> np.ndarray:
        """Rows of words that were not known; ``ways`` are sizes, scores, losses and ids."""
        first = len(self.rows)
        self.rows.update(zip(words, range(first, first + len(words))))
        self.fresh.append(ways)
        return np.arange(first, first + len(words))

    def columns(self) -> tuple:
        """Starts, sizes, scores and losses by row, and the ids that the starts point into."""
        if self.fresh:
            self.stored = join_ways(self.stored, tuple(np.concatenate(c) for c in zip(*self.fresh)))
            self.fresh = []
        return self.stored

    def turn(self, words: list[str], row: np.ndarray, columns: tuple) -> None:
        """To be called after a portion with its words, and their rows in ``columns``."""
        if len(self.rows) <= REMEMBERED:
            return
        kept = np.flatnonzero(row < len(self.rows))
        row = row[kept]
        starts, sizes, scores, losses, ids = columns
        sizes = sizes[row]
        self.stored = (np.cumsum(sizes) - sizes, sizes, scores[row], losses[row], ids[ranges(starts[row], sizes)])
        self.rows = {words[k]: i for i, k in enumerate(kept.tolist())}


class Vocabulary:
    """Pieces with scores, and the byte pieces that stand for what no piece covers."""

    def __init__(self, pieces: dict[str, tuple[int, float]], byte_ids: dict[int, int], texts: dict[int, bytes]):
        self.pieces, self.byte_ids, self.texts = pieces, byte_ids, texts
        self.longest = max(map(len, pieces), default=1)
        # user-defined pieces carry no score of their own
        self.unknown = min((s for _, s in pieces.values() if s > -1e6), default=0.0) - UNKNOWN_PENALTY
        #: whether a piece reaches from one word into the next
        self.joins = any(MARK in p.lstrip(MARK) for p in pieces)
        self.memory = Memory(REMEMBERED)
        self.by_hash = PieceTable(pieces)
        #: what each id stands for, in the order of the ids
        last = max([*texts, *(i for i, _ in pieces.values()), *byte_ids.values()], default=-1)
        self.spelled = [texts.get(i, b"") for i in range(last + 1)]
        self.spelled_array = pa.array(self.spelled, pa.large_binary())
        self.known = KnownWords()
        #: what the search found for words, for ``others``
        self.ranked: dict[tuple[str, int], list[tuple[float, bytes]]] = {}

    @classmethod
    def load(cls, path: str) -> "Vocabulary":
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        pieces, byte_ids, texts = {}, {}, {}
        for i in range(model.get_piece_size()):
            piece = model.id_to_piece(i)
            if model.is_byte(i):
                byte_ids[int(piece[3:5], 16)] = i
                texts[i] = bytes([int(piece[3:5], 16)])
            elif not (model.is_control(i) or model.is_unknown(i) or model.is_unused(i)):
                pieces[piece] = (i, model.get_score(i))
                texts[i] = piece.replace(MARK, " ").encode("utf-8")
        return cls(pieces, byte_ids, texts)

    # ------------------------------------------------------------ one word

    def edges(self, word: str) -> list[list[tuple[int, float, tuple[int, ...]]]]:
        """Edges into every position: (from, score, ids)."""
        n, get = len(word), self.pieces.get
        into: list[list] = [[] for _ in range(n + 1)]
        for i in range(n):
            for j in range(i + 1, min(n, i + self.longest) + 1):
                got = get(word[i:j])
                if got is not None:
                    into[j].append((i, got[1], (got[0],)))
                elif j == i + 1:
                    raw = word[i].encode("utf-8", "surrogatepass").replace(MARK.encode(), b" ")
                    into[j].append((i, self.unknown, tuple(self.byte_ids[b] for b in raw)))
        return into

    def best_two(self, word: str) -> tuple[bytes, float, float]:
        """Ids of the best segmentation, its score, and how much worse the second one is (infinite: there is none)."""
        got = self.memory.young.get(word)
        if got is not None:
            return got
        n, get, longest, unknown = len(word), self.pieces.get, self.longest, self.unknown
        never = float("-inf")
        one, two, came = [never] * (n + 1), [never] * (n + 1), [None] * (n + 1)
        one[0] = 0.0
        for i in range(n):
            a, b = one[i], two[i]
            for j in range(i + 1, min(n, i + longest) + 1):
                piece = get(word[i:j])
                if piece is None:
                    if j > i + 1:
                        continue  # pieces only; a lone character has its bytes
                    s, ids = unknown, None
                else:
                    s, ids = piece[1], piece[0]
                x = a + s
                if x > one[j]:
                    two[j] = max(one[j], b + s)
                    one[j], came[j] = x, (i, ids)
                elif x > two[j]:
                    two[j] = x  # b + s is no better than x
        out, j = [], n
        while j:
            i, ids = came[j]
            if ids is None:
                raw = word[i].encode("utf-8", "surrogatepass").replace(MARK.encode(), b" ")
                out += [self.byte_ids[b] for b in reversed(raw)]
            else:
                out.append(ids)
            j = i
        found = (np.array(out[::-1], "<u4").tobytes(), one[n], np.inf if two[n] == never else one[n] - two[n])
        if len(word) <= 64:
            self.memory.young[word] = found
        return found

    def learn(self, words: set[str]) -> None:
        """``best_two`` of many words at once, to be remembered one by one."""
        known = self.memory.young
        for n, group in by_length(w for w in self.memory.missing(words) if len(w) <= TOGETHER_LENGTH).items():
            sizes, scores, losses, ids = self._learn(group, n)
            ends = np.cumsum(sizes)
            for word, start, end, score, loss in zip(group, ends - sizes, ends, scores.tolist(), losses.tolist()):
                known[word] = (ids[start:end].tobytes(), score, loss)

    def _learn(self, group: list[str], n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Of words of one length the numbers of ids, ``best_two``'s scores and losses, and their ids one after the other."""
        done = [self._pass(group[at:at + TOGETHER], n) for at in range(0, len(group), TOGETHER)]
        return tuple(np.concatenate(c) for c in zip(*done))

    def _pass(self, group: list[str], n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """The forward pass over words of one length, position by position for all of them."""
        table, codes = self.by_hash, np.ascontiguousarray(_codes(group, n).T)
        found = []
        h = np.zeros((n, len(group)), np.uint64)
        for length in range(1, min(n, self.longest) + 1):
            h = table.roll(h[:n - length + 1], codes[length - 1:])
            found.append(table.find(h.ravel()).reshape(h.shape))
        # a character without a piece is kept as a negative number until its bytes are written
        lone = np.where(found[0] > 0, table.scores[found[0]], self.unknown)
        lone_ids = np.where(found[0] > 0, table.ids[found[0]], -1 - codes.astype(np.int64))
        fitting = [k for k in range(len(found), 1, -1) if found[k - 1].any()]
        one, two = np.full((n + 1, len(group)), -np.inf), np.full((n + 1, len(group)), -np.inf)
        back, piece = np.zeros((n + 1, len(group)), np.int64), np.zeros((n + 1, len(group)), np.int64)
        one[0] = 0
        for j in range(1, n + 1):
            best, second, came, of = one[j], two[j], back[j], piece[j]
            for length in fitting:
                if length > j:
                    continue
                at = found[length - 1][j - length]
                hit = np.flatnonzero(at)  # few of the longer parts are pieces
                if not len(hit):
                    continue
                at = at[hit]
                s, was = table.scores[at], best[hit]
                x, y = one[j - length][hit] + s, two[j - length][hit] + s
                # the second best is what was, the lesser of the two rivals, or the new one's own second
                second[hit] = np.maximum(second[hit], np.maximum(y, np.minimum(was, x)))
                better = x > was
                won = hit[better]
                best[won], came[won], of[won] = x[better], length, table.ids[at[better]]
            x, y = one[j - 1] + lone[j - 1], two[j - 1] + lone[j - 1]
            np.maximum(y, np.minimum(best, x), out=y)
            np.maximum(second, y, out=second)
            better = x > best
            came[better] = 1
            np.copyto(of, lone_ids[j - 1], where=better)
            np.maximum(best, x, out=best)
        rows, at = np.arange(len(group)), np.full(len(group), n)
        ids, sizes = np.zeros((len(group), n), np.int64), np.zeros(len(group), np.int64)
        while len(rows):
            here = at[rows]
            sizes[rows] += 1
            ids[rows, n - sizes[rows]] = piece[here, rows]
            at[rows] = here = here - back[here, rows]
            rows = rows[here > 0]
        losses = np.where(np.isinf(two[n]), np.inf, one[n] - np.where(np.isinf(two[n]), 0, two[n]))
        flat = ids[np.arange(n) >= n - sizes[:, None]]
        bare = np.flatnonzero(flat < 0)
        if len(bare):
            raw = [self.raw(chr(-1 - c)) for c in flat[bare].tolist()]
            times = np.ones(len(flat), np.int64)
            times[bare] = list(map(len, raw))
            sizes = np.add.reduceat(times, np.cumsum(sizes) - sizes)
            flat = np.repeat(flat, times)
            flat[flat < 0] = [i for ids_ in raw for i in ids_]
        return sizes, one[n].copy(), losses, flat.astype("<u4")

    def raw(self, character: str) -> list[int]:
        """Ids of the bytes of a character that no piece covers."""
        return [self.byte_ids[b] for b in character.encode("utf-8", "surrogatepass").replace(MARK.encode(), b" ")]

    def n_best(self, word: str, n: int) -> list[tuple[float, tuple[int, ...]]]:
        """The n best segmentations of a word by backward A-star, best first.

        Of equal ones the one that has come further goes on, so ties do not widen the search.
        """
        into = self.edges(word)
        ahead = [0.0] + [float("-inf")] * len(word)
        for j in range(1, len(word) + 1):
            ahead[j] = max((ahead[i] + s for i, s, _ in into[j]), default=float("-inf"))
        count = 0
        queue = [(-ahead[-1], len(word), count, 0.0, None)]
        out: list[tuple[float, tuple[int, ...]]] = []
        while queue and len(out) < n:
            _, at, _, behind, path = heapq.heappop(queue)
            if at == 0:
                ids: list[int] = []
                while path is not None:
                    ids += path[0]
                    path = path[1]
                out.append((behind, tuple(ids)))
                continue
            for i, s, ids in into[at]:
                count += 1
                heapq.heappush(queue, (-(ahead[i] + s + behind), i, count, s + behind, (ids, path)))
        return out

    # ------------------------------------------------------------ whole texts

    def words(self, text: str) -> list[str]:
        """The text with marks for spaces, parted before every run of marks."""
        if not text:
            return []
        marked = MARK + text.replace(" ", MARK)
        if self.joins:
            return [marked]
        if MARK + MARK not in marked and marked[-1] != MARK:
            return [MARK + part for part in marked[1:].split(MARK)]
        out, parts = [], marked.split(MARK)
        run = 0
        for k, part in enumerate(parts):
            if k:
                run += 1
            if part:
                out.append(MARK * run + part)
                run = 0
        if run:
            out.append(MARK * run)
        return out

    def parted(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray, list[str]]:
        """The words of many texts: numbers of them by text, each word's place among the distinct ones, and these.

        A word begins with a mark, which is left off here.
        """
        plain = pc.replace_substring(pc.fill_null(texts, ""), MARK, " ")
        split = pc.split_pattern(plain, " ")
        parts, counts = split.flatten(), pc.list_value_length(split).to_numpy(zero_copy_only=False).astype(np.int64)
        # runs of marks, and marks at either end, leave empty parts; an empty text has one as well
        bare = np.flatnonzero(pc.binary_length(parts).to_numpy(zero_copy_only=False) == 0)
        if len(bare) or self.joins:
            ends = np.cumsum(counts)
            odd = np.arange(len(counts)) if self.joins else np.unique(np.searchsorted(ends, bare, "right"))
            apart = [self.words(x) for x in plain.take(pa.array(odd)).to_pylist()]
            starts, own = ends - counts, np.array([len(ws) for ws in apart], np.int64)
            starts[odd], counts[odd] = len(parts) + np.cumsum(own) - own, own
            parts = pa.concat_arrays([parts, pa.array([w[1:] for ws in apart for w in ws], parts.type)]).take(
                pa.array(ranges(starts, counts)))
        coded = parts.dictionary_encode()
        return counts, coded.indices.to_numpy(), coded.dictionary.to_numpy(zero_copy_only=False).tolist()

    def best_of(self, words: list[str]) -> tuple[pa.Array, np.ndarray, np.ndarray, np.ndarray]:
        """Of distinct words (without their first mark) the bytes of the best way's ids, their numbers, scores and losses."""
        known = self.known
        row = np.fromiter(map(known.rows.get, words, repeat(-1)), np.int64, len(words))
        new = np.flatnonzero(row < 0).tolist()
        if new:
            marked = {MARK + words[k]: k for k in new}
            for n, group in by_length(w for w in marked if len(w) <= TOGETHER_LENGTH).items():
                places = [marked[w] for w in group]
                row[places] = known.add([words[k] for k in places], *self._learn(group, n))
            columns = known.columns()
            longer = [w for w in marked if len(w) > TOGETHER_LENGTH]  # not remembered: they may be of any length
            if longer:
                ways, scores, losses = zip(*map(self.best_two, longer))
                row[[marked[w] for w in longer]] = len(columns[0]) + np.arange(len(longer))
                ids = np.frombuffer(b"".join(ways), "<u4")
                columns = join_ways(columns, (np.array(list(map(len, ways))) // 4, np.array(scores), np.array(losses), ids))
                self.memory.turn()
        else:
            columns = known.columns()
        starts, sizes, scores, losses, ids = columns
        sizes, scores, losses = sizes[row], scores[row], losses[row]
        ways = binaries(np.ascontiguousarray(ids[ranges(starts[row], sizes)]), 4 * sizes)
        known.turn(words, row, columns)
        return ways, sizes, scores, losses

    def segment(self, texts: pa.Array, n: int) -> Iterator[tuple[list[tuple[float, bytes]], bool]]:
        """The n best (score, ids as little-endian 32-bit bytes) of every text, best first, and whether the best one is the text again.

        The second to n-th best differ from the best in words whose second best is among
        the n - 1 least worse: any other change is worse than each of those alone.
        """
        counts, code, words = self.parted(texts)
        ways, sizes, scores, losses = self.best_of(words)
        ids = ways.take(pa.array(code))
        ends, id_ends = np.cumsum(counts), np.append(0, np.cumsum(sizes[code]))
        spelled = self.spelled_array.take(pa.array(np.frombuffer(ids.buffers()[2] or b"", "<u4", id_ends[-1])))
        wholes, raws = memoryview(ids.buffers()[2] or b""), memoryview(spelled.buffers()[2] or b"")
        raw_ends = np.frombuffer(spelled.buffers()[1] or bytes(8), np.int64)
        score, loss = scores[code], losses[code]
        for text, end, count in zip(texts.to_pylist(), ends.tolist(), counts.tolist()):
            at = slice(end - count, end)
            first, last = int(id_ends[end - count]), int(id_ends[end])
            whole = bytes(wholes[4 * first:4 * last])
            found = self._n_ways(n, whole, sum(score[at].tolist()), loss[at], id_ends[end - count:end + 1] - first,
                                 lambda k: MARK + words[code[end - count + k]])
            raw = bytes(raws[raw_ends[first]:raw_ends[last]])
            text = text or ""
            yield found, raw.removeprefix(b" ") == text.encode() or self.decode(whole) == text

    def _n_ways(self, n: int, whole: bytes, total: float, worse: np.ndarray, ends: np.ndarray, word) -> list[tuple[float, bytes]]:
        """The n best ways of a text from its best one; ``ends`` are where its words' ids end in it, from 0 on."""
        ways: list[tuple[float, tuple]] = [(0.0, ())]
        least: np.ndarray | tuple = ()
        if n > 1 and len(worse):
            least = np.arange(len(worse))
            if n - 1 < len(worse):  # of equal ones the first in the text, whatever a partition takes
                least = np.flatnonzero(worse <= np.partition(worse, n - 2)[n - 2])
            least = least[np.argsort(worse[least], kind="stable")][:n - 1].tolist()
        for k in least:
            if np.isinf(worse[k]):
                break
            # what the search finds best need not be the tie that the pass kept
            best = whole[4 * ends[k]:4 * ends[k + 1]]
            options = [(0.0, None)] + [o for o in self.others(word(k), n) if o[1] != best]
            ways = heapq.nsmallest(n, ((d + e, c + ((k, o),) if o is not None else c) for d, c in ways for e, o in options),
                                   key=lambda w: w[0])
        out = []
        for worse_by, changes in ways:
            parts, done = [], 0
            for k, o in sorted(changes, key=lambda c: c[0]):
                parts += [whole[done:4 * ends[k]], o]
                done = 4 * ends[k + 1]
            out.append((total - worse_by, b"".join([*parts, whole[done:]]) if changes else whole))
        return out

    def others(self, word: str, n: int) -> list[tuple[float, bytes]]:
        """The n best of a word as (how much worse than the best, ids as bytes)."""
        got = self.ranked.get((word, n))
        if got is None:
            other = self.n_best(word, n)
            got = [(other[0][0] - s, np.array(w, "<u4").tobytes()) for s, w in other]
            if len(word) <= TOGETHER_LENGTH:
                if len(self.ranked) >= RANKED:
                    self.ranked.clear()
                self.ranked[word, n] = got
        return got

    def segmentations(self, text: str, n: int) -> list[tuple[float, bytes]]:
        """``segment`` of one text."""
        return next(self.segment(pa.array([text], pa.string()), n))[0]

    def decode(self, ids: bytes | list[int]) -> str:
        """The text of ids; the space that encoding puts first is taken off."""
        if isinstance(ids, bytes):
            ids = np.frombuffer(ids, "<u4").tolist()
        raw = b"".join(map(self.spelled.__getitem__, ids))
        return raw.removeprefix(b" ").decode("utf-8", "replace")


def vocabulary(path: str) -> Vocabulary:
    """The worker's vocabulary for ``path``."""
    if path not in _vocabularies:
        _vocabularies[path] = Vocabulary.load(path)
    return _vocabularies[path]


def portions(texts: pa.Array) -> Iterator[tuple[int, int]]:
    """(first, number) of the texts of a batch that go together."""
    ends = np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False), dtype=np.int64)
    at = 0
    while at < len(ends):
        full = int(np.searchsorted(ends, (ends[at - 1] if at else 0) + PORTION_BYTES, "right"))
        n = min(PORTION, max(1, full - at))
        yield at, n
        at += n


def encode(texts: DataFrame, model: str, n: int = 4, text: str = "text", passing: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``passing`` columns of every row with its n best segmentations: arrays ``scores`` and ``ids`` (binary).

    ``restored`` says whether the best one decodes to the text.

    A null or empty text has the one empty segmentation. Spaces are marks; marks in
    the text itself come back as spaces. Repeated rows are read each, other columns left out.
    Texts are not shuffled.
    """
    names = [f"_p{i}" for i in range(len(passing))]

    def run(batches: Iterator[pa.RecordBatch]):
        known = vocabulary(model)
        for batch in batches:
            for first, n_texts in portions(batch.column(0)):
                part = batch.slice(first, n_texts)
                found, restored = zip(*known.segment(part.column(0), n))
                yield pa.RecordBatch.from_arrays(
                    [*part.columns[1:], pa.array([[s for s, _ in f] for f in found], pa.list_(pa.float64())),
                     pa.array([[i for _, i in f] for f in found], pa.list_(pa.binary())), pa.array(restored, pa.bool_())],
                    names=[*names, "scores", "ids", "restored"])

    narrow = texts.select(F.col(text).cast("string").alias("text"), *[F.col(c).alias(c2) for c, c2 in zip(passing, names)])
    kinds = "".join(f"{n_} {texts.schema[c].dataType.simpleString()}, " for c, n_ in zip(passing, names))
    out = map_arrow(narrow, run, kinds + "scores array<double>, ids array<binary>, restored boolean")
    return out.select(*[F.col(n_).alias(c) for c, n_ in zip(passing, names)], "scores", "ids", "restored")


def decode(segmented: DataFrame, model: str, ids: str = "ids", passing: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``passing`` columns with ``text``, decoded from a column of id bytes; null ids give null."""
    names = [f"_p{i}" for i in range(len(passing))]

    def run(batches: Iterator[pa.RecordBatch]):
        known = vocabulary(model)
        for batch in batches:
            texts = [known.decode(x.as_py()) if x.is_valid else None for x in batch.column(0)]
            yield pa.RecordBatch.from_arrays([*batch.columns[1:], pa.array(texts, pa.string())], names=[*names, "text"])

    narrow = segmented.select(F.col(ids).alias("ids"), *[F.col(c).alias(c2) for c, c2 in zip(passing, names)])
    kinds = "".join(f"{n_} {segmented.schema[c].dataType.simpleString()}, " for c, n_ in zip(passing, names))
    out = map_arrow(narrow, run, kinds + "text string")
    return out.select(*[F.col(n_).alias(c) for c, n_ in zip(passing, names)], "text")


def digests(segmented: DataFrame, passing: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``passing`` columns with n_ids and ids_crc32 of the best segmentation, its score, and the others' checksums."""
    best = F.col("ids")[0]
    return segmented.select(
        *passing, (F.octet_length(best) / 4).cast("long").alias("n_ids"), F.crc32(best).alias("ids_crc32"),
        F.col("scores")[0].alias("score"), "scores", F.transform("ids", lambda i: F.crc32(i)).alias("crc32s"), "restored")
