"""Personal data: fixed patterns, and a linear-chain conditional random field beside them.

The patterns find what is written plainly. The field reads words by their shape and
their neighbours' shapes, is trained on a small labelled table, and finds what no pattern tells:
secrets, which look like any other hash and are known by the words around them, and
written-round forms (``jane [at] mail [dot] com``, ``(555) 010-2030``, ``10[.]0[.]0[.]7``). What
it marks must still read as its kind once the disguise is taken off; for a secret that only
says that it is one long word.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyfold.llm.common import map_arrow, refuse_clash

KINDS = ("email", "ip", "card", "phone")
#: Kinds that the field marks; the last one has no pattern.
MARKED = KINDS + ("secret",)
LABELS = ("O",) + tuple(f"{p}-{k}" for k in MARKED for p in "BI")

# ---------------------------------------------------------------- patterns

_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_LOCAL = re.compile(r"[A-Za-z0-9._%+-]+\Z")
_LOCAL_CHARS = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
# A match can start only where a run of digits starts: from a later digit of the run it fails alike.
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def luhn(digits: str) -> bool:
    total = 0
    for k, d in enumerate(reversed(digits)):
        n = int(d) * (1 + k % 2)
        total += n - 9 * (n > 9)
    return total % 10 == 0


def _digits(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def emails(text: str) -> Iterator[tuple[int, int]]:
    """Matches of local part, @ and domain; each @ is tried once, so long runs cost their length."""
    end, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > end and text[start - 1] in _LOCAL_CHARS:
            start -= 1
        if start < at and (m := _DOMAIN.match(text, at + 1)):
            yield start, m.end()
            end = m.end()
        else:
            end = max(end, at + 1)
        at = text.find("@", at + 1 if end <= at + 1 else end)


def base_spans(text: str) -> list[tuple[int, int, str]]:
    """(start, end, kind) in code points: leftmost and non-overlapping within a kind; failed checks are dropped."""
    out = [(s, e, "email") for s, e in emails(text)]
    for m in _IP.finditer(text):
        if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m[0].split(".")):
            out.append((m.start(), m.end(), "ip"))
    for m in _CARD.finditer(text):
        d = _digits(m[0])
        if 12 <= len(d) <= 19 and luhn(d):
            out.append((m.start(), m.end(), "card"))
    if "+" in text:
        for m in _PHONE.finditer(text):
            if 9 <= len(_digits(m[0])) <= 15:
                out.append((m.start(), m.end(), "phone"))
    return sorted(out, key=lambda s: (s[0], KINDS.index(s[2])))


def written(spans: list[tuple[int, int, str]]) -> str:
    return ",".join(f"{k}:{s}:{e}" for s, e, k in sorted(spans, key=lambda s: (s[0], MARKED.index(s[2]), s[1])))


# ---------------------------------------------------------------- labelled table

#: The labelled table: texts with their spans marked as {kind:words}. Plain lines are as
#: important as marked ones: they show numbers and words that are nobody's data.
EXAMPLES = (
    "write to {email:jane [at] mail [dot] com} today",
    "write to {email:j.smith [at] example [dot] org} soon .",
    "mail {email:info (at) firm (dot) net} or call",
    "contact {email:sales (at) shop.example (dot) com} now",
    "contact {email:anna.b [at] web.example.org} please",
    "contact {email:anna.b (at) web.example.org} please",
    "reach me under {email:peter dot long at mail dot example dot com} any time",
    "my address is {email:maria at post dot org} and",
    "ask {email:team7 at office dot net} first",
    "send it to {email:kim AT corp DOT com} thanks",
    "{email:office [at] city [dot] gov} answers",
    "call {phone:(555) 010-2030} after six",
    "call {phone:(212) 555-0199} or write",
    "tel {phone:555-010-2030} , ask for Ann",
    "tel {phone:415-555-0123} in the morning",
    "phone {phone:0049 30 123 45 67} at work",
    "phone {phone:0044 20 7946 0123} at home",
    "fax {phone:0033 1 23 45 67 89} only",
    "ring {phone:555.010.2030} now",
    "ring {phone:020 7946 0018} today",
    "mobile {phone:0170 123 4567} please",
    "number {phone:(030) 901 820 22} works",
    "server {ip:10[.]0[.]0[.]7} is down",
    "host {ip:192[.]168[.]1[.]20} answers",
    "from {ip:172(.)16(.)0(.)9} came",
    "gateway {ip:172[.]20[.]3[.]45} was next",
    "the node {ip:8[.]8[.]4[.]4} failed",
    "from {ip:203 . 0 . 113 . 9} came",
    "address {ip:198 dot 51 dot 100 dot 7} again",
    "pay with {card:4111.1111.1111.1111} now",
    "pay with {card:5500.0000.0000.0004} now",
    "card {card:4111/1111/1111/1111} expires",
    "card {card:4012_8888_8888_1881} was used",
    "visa {card:4111 - 1111 - 1111 - 1111} ok",
    "we met at the dot of noon and at home",
    "look at the map at page 12 . there is a dot at the end",
    "the cat sat at a table dot or not",
    "he was at work , she at school",
    "a dot com firm sat at the top",
    "version 1.2.3 came out in 2019 with 42 fixes",
    "version 10.4.1.2 of the build 7781",
    "order 1234567890 was sent on 2020-01-05 for 19.99 dollars",
    "order 20190301-77 has 3 parts , 1,234 items and 5 boxes",
    "chapter 3 - 4 , pages 100 - 200 and 300 - 400",
    "( see table 4 ) and ( 12 ) and ( 555 ) below",
    "the years 1914 1918 1939 1945 and 2001 2008",
    "score 3-2 and 110-98 then 7-5 6-4",
    "hash 24be64439e3e49cf46b2d7c90f3602a3d0b907ff stays",
    'token = {secret:"2321bac4d15ec8f90433955bf9d3cf61da5bdd1e"} done',
    "token = {secret:7781bac4d15ec8f90433955bf9d3cf61da5bdd1e} is set",
    'TOKEN = {secret:"F3A1BAC4D15EC8F90433955BF9D3CF61DA5BDD1E"} THEN',
    "api_key = {secret:9c1f7be2a4d84410bb35c2d1} in the file",
    "the api key : {secret:sk4f7Qx91LmPz02VbTy8Rw55} works",
    "secret: {secret:b1946ac92492d2347c6235b4d2611184} keep it",
    'password = {secret:"hunter2hunter2xyz9"} for now',
    "PASSWORD : {secret:Zk8vQ1w7Lr3mT5yB} please",
    "auth token is {secret:00ffab3491cc77de82a1b5c3} today",
    "and the key = {secret:5f4dcc3b5aa765d61d8327deb882cf99} there",
    'pwd : {secret:"a1b2c3d4e5f6a7b8c9d0"} and go',
    "access_token = {secret:\'eyJ0eXAiOiJKV1QiLCJhbGci\'} ends",
    "commit 9f3c11a2b4d85e6f7081923a4b5c6d7e8f901234 by Ann",
    "sha1 of the file is 356a192b7913b04c54574d18c28d46e6395428ab there",
    "checksum : da39a3ee5e6b4b0d3255bfef95601890afd80709 holds",
    "digest = e3b0c44298fc1c149afbf4c8996fb92427ae41e4 of nothing",
    'the id "b6d767d2f8ed5d21a44b0e5886680cb9" was new',
    "uuid 123e4567e89b12d3a456426614174000 of the row",
    "a token of thanks = a small gift and a key = a door",
    "the password : a short word , the secret : none",
    "key = 12 and token = 4 in the table",
    "see page7of12inthebook2009edition for it",
    "ratio 0.52 0.61 0.73 over 1000 2000 4000 8000 rows",
    "number 4222333344445555 failed and 99887766554433221100 too",
    "isbn 978 3 16 148410 0 is a book",
    "call me at ten or at noon . write if not",
    "mail the form at once dot the i and cross the t",
    "rfc 2822 section 3.4.1 and rfc 5322 section 4",
    "row | one | two | three | 4 | 5 | 6",
    "words*** and%%% more### of$$$ that&&& kind",
    "The first. And the second, in short; a third: fine! Or not?",
    "À la fin, où êtes-vous ? Größe über alles . ñandú",
)
_MARK = re.compile(r"\{(\w+):([^}]*)\}")


def labelled(examples: tuple[str, ...] = EXAMPLES) -> list[tuple[list[str], list[int]]]:
    """(words, labels) of every line of the labelled table."""
    out = []
    for line in examples:
        words, labels, at = [], [], 0
        for m in [*_MARK.finditer(line), None]:
            plain = line[at:m.start() if m else len(line)].split()
            words += plain
            labels += [0] * len(plain)
            if m:
                inner = m[2].split()
                words += inner
                labels += [LABELS.index(f"{'I' if k else 'B'}-{m[1]}") for k in range(len(inner))]
                at = m.end()
        out.append((words, labels))
    return out


# ---------------------------------------------------------------- words

_SHAPE = bytearray(range(256))
for _c in range(256):
    if _c >= 0x80 or 97 <= _c <= 122:
        _SHAPE[_c] = ord("a")
    elif 65 <= _c <= 90:
        _SHAPE[_c] = ord("A")
    elif 48 <= _c <= 57:
        _SHAPE[_c] = ord("9")
_SHAPE = bytes(_SHAPE)
_LEXICON = {w: f"lex={n}" for n, ws in {
    "at": ("at", "AT", "[at]", "(at)", "{at}", "[AT]", "(AT)"),
    "dot": ("dot", "DOT", "[dot]", "(dot)", "{dot}", "[DOT]", "(DOT)"),
    "zone": ("com", "org", "net", "edu", "gov", "COM", "ORG", "NET"),
    "call": ("call", "phone", "tel", "tel.", "fax", "ring", "mobile"),
    "secret": ("token", "TOKEN", "Token", "key", "KEY", "api_key", "API_KEY", "apikey", "secret", "SECRET", "password", "PASSWORD",
               "pwd", "access_token", "secret:", "password:", "token:", "key:"),
    "sets": ("=", ":", ":=", "=>", "is"),
}.items() for w in ws}
_LEXICON_BYTES = {w.encode(): w for w in _LEXICON}
#: Bytes of a word of letters and digits from which on it is no usual one.
LONG = 16
_RUN = re.compile(rb"(.)\1+", re.S)
_DIGITS = re.compile(rb"[0-9]+")


def word_features(word: bytes, shape: bytes) -> tuple[str, ...]:
    """Features of one word; only its shape, its digits and a short word list count."""
    digits = shape.count(b"9")
    if digits and len(word) >= LONG and b"a" in shape.lower() and b"@" not in word:
        # one of very many: only that it is long and mixed counts, and whether it is quoted
        return ("bias", "mixed", "quoted" if word[:1] in (b'"', b"'") else "bare")
    short = _RUN.sub(rb"\1", shape)[:24].decode("ascii", "replace")
    out = ["bias", f"shape={short}", f"digits={min(digits, 20)}"]
    if not digits and short.strip("aA.,;:!?'\"-") == "":
        out.append("plain")
    known = _LEXICON_BYTES.get(word)
    if known:
        out.append(_LEXICON[known])
    if digits:
        parts = [len(m) for m in _DIGITS.findall(word[:64])]
        out.append("parts=" + "-".join(map(str, parts[:5])))
        if digits <= 3 and len(parts) == 1:
            out.append("octet" if int(_DIGITS.search(word)[0]) <= 255 else "number")
    return tuple(out)


class Words:
    """Class numbers of words: words with equal features share one."""

    def __init__(self, index: dict[str, int], weights: np.ndarray):
        # weights: offset (-2..2) x feature x label
        self.index, self.weights = index, weights
        self.by_features: dict[tuple[str, ...], int] = {}
        self.by_shape: dict[bytes, int] = {}
        # class 0 stands between texts
        self.tables: list[np.ndarray] = [np.zeros((len(OFFSETS), len(LABELS)), np.float32)]

    def of(self, word: bytes, shape: bytes) -> int:
        features = word_features(word, shape)
        got = self.by_features.get(features)
        if got is None:
            got = self.by_features[features] = len(self.tables)
            ids = [i for f in features if (i := self.index.get(f)) is not None]
            self.tables.append(self.weights[:, ids, :].sum(axis=1))
        return got

    def classes(self, data: bytes) -> np.ndarray:
        words, shapes = data.split(), data.translate(_SHAPE).split()
        known, listed = self.by_shape.get, _LEXICON_BYTES
        out = np.array([known(s, -1) for s in shapes], np.int32)
        for k in np.flatnonzero(out < 0).tolist():
            shape = shapes[k]
            out[k] = self.of(words[k], shape)
            # digits count by value
            if b"9" not in shape and words[k] not in listed and len(shape) <= 40 and len(self.by_shape) < 200_000:
                self.by_shape[shape] = int(out[k])
        for k in [k for k, w in enumerate(words) if w in listed]:
            out[k] = self.of(words[k], shapes[k])
        return out


# ---------------------------------------------------------------- the field

OFFSETS = (-2, -1, 0, 1, 2)
#: I-x may follow B-x and I-x only. Before and after a text stands O.
_ALLOWED = np.array([[not b.startswith("I") or a[2:] == b[2:] and a != "O" for b in LABELS] for a in LABELS])
_NEVER = -1e4


def _log_sum(x: np.ndarray, axis: int) -> np.ndarray:
    top = x.max(axis=axis, keepdims=True)
    return np.squeeze(top, axis) + np.log(np.exp(x - top).sum(axis=axis))


@lru_cache(maxsize=2)
def trained(examples: tuple[str, ...] = EXAMPLES, steps: int = 250, ridge: float = 0.02,
            rate: float = 0.15) -> tuple[dict[str, int], np.ndarray, np.ndarray]:
    """(feature index, weights, transitions) of greatest penalized likelihood, by gradient steps.

    All lines run side by side: forward and backward sums over the padded table.
    """
    lines = [(["", *words, ""], [0, *labels, 0]) for words, labels in labelled(examples)]
    rows = [[word_features(w.encode(), w.encode().translate(_SHAPE)) if w else () for w in words] for words, _ in lines]
    index: dict[str, int] = {}
    for row in rows:
        for features in row:
            for f in features:
                index.setdefault(f, len(index))
    n_lines, longest, n_labels = len(rows), max(map(len, rows)), len(LABELS)
    valid = np.zeros((n_lines, longest), bool)
    gold = np.zeros((n_lines, longest), int)
    on = np.zeros((n_lines, longest, len(index)))
    for i, (row, (_, labels)) in enumerate(zip(rows, lines)):
        valid[i, :len(row)] = True
        gold[i, :len(row)] = labels
        for t, features in enumerate(row):
            on[i, t, [index[f] for f in features]] = 1
    inputs = np.concatenate([_moved(on, o) for o in OFFSETS], axis=2)
    truth = np.eye(n_labels)[gold] * valid[:, :, None]
    pairs = valid[:, 1:]
    gold_pairs = np.einsum("ita,itb->ab", truth[:, :-1], truth[:, 1:])
    weights, moves = np.zeros((inputs.shape[2], n_labels)), np.zeros((n_labels, n_labels))
    barred = np.where(_ALLOWED, 0.0, _NEVER)
    edge = np.array([[not features for features in row] + [False] * (longest - len(row)) for row in rows])
    outside = np.where(edge[:, :, None] & (np.arange(n_labels) > 0), _NEVER, 0.0)
    flat = inputs.reshape(-1, inputs.shape[2])
    mean = [np.zeros_like(weights), np.zeros_like(moves)]
    square = [np.zeros_like(weights), np.zeros_like(moves)]
    for step in range(1, steps + 1):
        scores = (flat @ weights).reshape(n_lines, longest, n_labels) + outside
        links = moves + barred
        ahead, behind = np.zeros_like(scores), np.zeros_like(scores)
        ahead[:, 0] = scores[:, 0]
        for t in range(1, longest):
            new = _log_sum(ahead[:, t - 1, :, None] + links, 1) + scores[:, t]
            ahead[:, t] = np.where(valid[:, t, None], new, ahead[:, t - 1])
        for t in range(longest - 2, -1, -1):
            new = _log_sum(links + (scores[:, t + 1] + behind[:, t + 1])[:, None, :], 2)
            behind[:, t] = np.where(valid[:, t + 1, None], new, 0.0)
        total = _log_sum(ahead[:, -1], 1)
        seen = np.exp(ahead + behind - total[:, None, None]) * valid[:, :, None]
        both = np.exp(ahead[:, :-1, :, None] + links + (scores + behind)[:, 1:, None, :]
                      - total[:, None, None, None]) * pairs[:, :, None, None]
        slopes = (flat.T @ (truth - seen).reshape(-1, n_labels) - ridge * weights,
                  gold_pairs - both.sum(axis=(0, 1)) - ridge * moves)
        for k, (slope, value) in enumerate(zip(slopes, (weights, moves))):
            mean[k] = 0.9 * mean[k] + 0.1 * slope
            square[k] = 0.99 * square[k] + 0.01 * slope * slope
            value += rate * (1 - step / (steps + 1)) * (mean[k] / (1 - 0.9 ** step)) / (
                np.sqrt(square[k] / (1 - 0.99 ** step)) + 1e-8)
    return index, weights.reshape(len(OFFSETS), len(index), n_labels), moves + barred


def _moved(x: np.ndarray, offset: int) -> np.ndarray:
    """Row t holds what stands at t + offset, zeros beyond the ends."""
    out = np.zeros_like(x)
    if offset < 0:
        out[:, -offset:] = x[:, :offset]
    elif offset:
        out[:, :-offset] = x[:, offset:]
    else:
        out[:] = x
    return out


def emissions(chain: np.ndarray, tables: np.ndarray) -> np.ndarray:
    """Label scores of every word of a chain. ``tables``: class x offset x label; class 0 is O."""
    scores = tables[:, 2].take(chain, axis=0)
    for k, o in enumerate(OFFSETS):
        if o < 0:
            scores[-o:] += tables[:, k].take(chain[:o], axis=0)
        elif o:
            scores[:-o] += tables[:, k].take(chain[o:], axis=0)
    scores[chain == 0] = _NEVER
    scores[chain == 0, 0] = 0
    return scores


def stretches(scores: np.ndarray, moves: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the runs of words that may be marked; the best labels of all others are O.

    A marked run gains at most its words' gains over O and the largest gains of
    entering, going on and leaving. A word that no run with a positive bound covers
    is O in the best labelling, and the chain falls apart there.
    """
    gain = (scores[:, 1:].max(axis=1) - scores[:, 0]).astype(np.float64)
    stay = moves[0, 0]
    enter, leave = moves[0, 1:].max() - stay, moves[1:, 0].max() - stay
    on = moves[1:, 1:].max() - stay
    gain += on
    sums = np.cumsum(gain)
    before = np.concatenate(([0.0], sums[:-1]))
    until = sums - np.minimum.accumulate(before)  # best run that ends here
    after = np.maximum.accumulate(sums[::-1])[::-1] - before  # best run that starts here
    hot = np.concatenate(([False], until + after - gain + enter + leave - on > -1e-3, [False]))
    edges = np.flatnonzero(hot[1:] != hot[:-1])
    return edges[::2], edges[1::2]


def viterbi(scores: np.ndarray, starts: np.ndarray, stops: np.ndarray, moves: np.ndarray) -> np.ndarray:
    """Best labels, word by word over all stretches at once; words outside stretches are O.

    Stretches are ordered by length, so those that go on are always the first ones and
    nothing is padded. An O stands before and after each.
    """
    out = np.zeros(len(scores), np.int8)
    if not len(starts):
        return out
    order = np.argsort(starts - stops, kind="stable")
    starts, stops = starts[order], stops[order]
    lengths = stops - starts
    rows = np.concatenate(([0], np.cumsum(lengths)))
    back = np.zeros((rows[-1], len(LABELS)), np.int8)
    best = scores[starts] + moves[0]
    final = np.zeros((len(starts), len(LABELS)), np.float32)
    active = len(starts)
    for t in range(1, int(lengths[0])):
        still = int(np.searchsorted(-lengths, -t, side="left"))
        final[still:active] = best[still:active]
        active = still
        paths = best[:active, :, None] + moves
        came = paths.argmax(axis=1)
        back[rows[:active] + t] = came
        best = np.take_along_axis(paths, came[:, None, :], axis=1)[:, 0] + scores[starts[:active] + t]
    final[:active] = best[:active]
    label = (final + moves[:, 0]).argmax(axis=1).astype(np.int8)
    for t in range(int(lengths[0]) - 1, -1, -1):
        active = int(np.searchsorted(-lengths, -t, side="left"))
        out[starts[:active] + t] = label[:active]
        label[:active] = back[rows[:active] + t, label[:active]]
    return out


def decode(classes: list[np.ndarray], tables: np.ndarray, moves: np.ndarray, whole: bool = False) -> list[np.ndarray]:
    """Best labels of every text of a batch. ``whole=True`` leaves no word out beforehand."""
    gap = np.zeros(2, np.int32)
    chain = np.concatenate([gap, *(x for c in classes for x in (c, gap))])
    lengths = np.array([len(c) for c in classes], np.int64)
    starts = 2 + np.cumsum(lengths + 2) - (lengths + 2)
    scores = emissions(chain, tables)
    if whole:
        labels = viterbi(scores, starts[lengths > 0], (starts + lengths)[lengths > 0], moves)
    else:
        labels = viterbi(scores, *stretches(scores, moves), moves)
    return [labels[s:s + n] for s, n in zip(starts, lengths)]


_AT = re.compile(r"\s*[\[({]\s*at\s*[\])}]\s*|\s+at\s+", re.I)
_DOT = re.compile(r"\s*[\[({]\s*(?:dot|\.)\s*[\])}]\s*|\s+(?:dot|\.)\s+", re.I)
_EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_SPELT_PHONE = re.compile(r"\(?[0-9][0-9().\x20/-]*[0-9]")
_SPELT_CARD = re.compile(r"[0-9](?:[\x20._/-]{0,3}[0-9])+")


def reads_as(kind: str, found: str) -> bool:
    """Whether a marked stretch is of its kind once its disguise is taken off."""
    if kind == "email":
        return bool(_EMAIL.fullmatch(_DOT.sub(".", _AT.sub("@", found))))
    if kind == "ip":
        parts = _DOT.sub(".", found).split(".")
        return len(parts) == 4 and all(re.fullmatch(r"[0-9]{1,3}", p) and int(p) <= 255 for p in parts)
    if kind == "secret":
        return len(found) >= LONG - 4 and not any(c.isspace() for c in found)
    digits = _digits(found)
    if kind == "card":
        return bool(_SPELT_CARD.fullmatch(found)) and 12 <= len(digits) <= 19 and luhn(digits)
    groups = re.findall(r"[0-9]+", found)
    return bool(_SPELT_PHONE.fullmatch(found)) and 9 <= len(digits) <= 15 and len(groups) >= 3


def marked_spans(text: str, data: bytes, labels: np.ndarray) -> list[tuple[int, int, str]]:
    """Stretches with labels, in code points, without punctuation at their ends."""
    raw = np.frombuffer(data, np.uint8)
    solid = ~((raw == 32) | ((raw >= 9) & (raw <= 13)))
    edges = np.diff(np.concatenate(([0], solid.astype(np.int8), [0])))
    starts, ends = np.flatnonzero(edges == 1), np.flatnonzero(edges == -1)
    points = np.concatenate(([0], np.cumsum((raw & 0xC0) != 0x80)))
    out, t = [], 0
    while t < len(labels):
        if labels[t] == 0:
            t += 1
            continue
        kind, stop = LABELS[labels[t]][2:], t + 1
        while stop < len(labels) and LABELS[labels[stop]] == f"I-{kind}":
            stop += 1
        s, e = int(points[starts[t]]), int(points[ends[stop - 1]])
        while e > s and not (text[e - 1].isalnum()):
            e -= 1
        while s < e and not (text[s].isalnum() or text[s] == "(" and kind == "phone"):
            s += 1
        if e > s and reads_as(kind, text[s:e]):
            out.append((s, e, kind))
        t = stop
    return out


def find(texts: DataFrame, text: str = "text", passing: tuple[str, ...] = ("doc_id",), mask: bool = False,
         examples: tuple[str, ...] = EXAMPLES) -> DataFrame:
    """``passing`` columns of every row with counts, digests and spans of personal data.

    n_email .. n_phone and n_secret count all spans, the patterns' and those added; added ones overlap no
    other. ``mask=True`` adds ``masked``, the text with each span replaced by its kind
    in brackets (overlapping ones by the first kind). Null and empty texts have no spans;
    a null stays null when masked. Repeated rows are read each; other columns are left
    out, one in ``passing`` that is named like a result raises a ``ValueError``; nothing is shuffled.
    """
    refuse_clash(passing, _OUT[:7 + mask])
    index, weights, moves = trained(examples)
    names = [f"_p{i}" for i in range(len(passing))]

    def run(batches: Iterator[pa.RecordBatch]):
        words = Words(index, weights.astype(np.float32))
        links = moves.astype(np.float32)
        for batch in batches:
            whole = batch.column(0)
            # bounded groups, so scores of very long texts never add up in one array
            groups, size = [[]], 0
            for k, length in enumerate(_lengths(whole)):
                if size > 4_000_000:
                    groups.append([])
                    size = 0
                groups[-1].append(k)
                size += length
            rows: list[tuple] = []
            for group in groups:
                values = [whole[k].as_py() for k in group]
                data = [(v or "").encode("utf-8") for v in values]
                classes = [words.classes(d) for d in data]
                for value, raw, labels in zip(values, data, decode(classes, np.stack(words.tables), links)):
                    rows.append(_row(value, raw, labels, mask))
            columns = list(zip(*rows)) if rows else [()] * 8
            kinds = [pa.int64()] * 5 + [pa.string()] * 3
            arrays = [pa.array(c, t) for c, t in zip(columns, kinds)]
            yield pa.RecordBatch.from_arrays([*batch.columns[1:], *arrays[:7 + mask]],
                                             names=[*names, *_OUT[:7 + mask]])

    narrow = texts.select(F.col(text).cast("string").alias("text"), *[F.col(c).alias(n) for c, n in zip(passing, names)])
    kinds = "".join(f"{n} {texts.schema[c].dataType.simpleString()}, " for c, n in zip(passing, names))
    schema = kinds + ", ".join(f"{c} {'long' if c.startswith('n_') else 'string'}" for c in _OUT[:7 + mask])
    out = map_arrow(narrow, run, schema)
    return out.select(*[F.col(n).alias(c) for c, n in zip(passing, names)], *_OUT[:7 + mask])


_OUT = ("n_email", "n_ip", "n_card", "n_phone", "n_secret", "base_sha256", "spans", "masked")


def _lengths(column: pa.Array) -> list[int]:
    return [len(x.as_buffer()) if x.is_valid else 0 for x in column]


def _row(value: str | None, raw: bytes, labels: np.ndarray, mask: bool) -> tuple:
    text = value or ""
    base = base_spans(text) if text else []
    spans = list(base)
    if labels.any():
        for s, e, kind in marked_spans(text, raw, labels):
            if not any(s < y and x < e for x, y, _ in spans):
                spans.append((s, e, kind))
    spans.sort(key=lambda x: (x[0], MARKED.index(x[2]), x[1]))
    counts = [sum(x[2] == k for x in spans) for k in MARKED]
    masked = value
    if mask and spans:
        parts, at = [], 0
        for s, e, kind in spans:
            if s >= at:
                parts += [text[at:s], f"[{kind}]"]
            at = max(at, e)
        masked = "".join(parts) + text[at:]
    return (*counts, hashlib.sha256(written(base).encode()).hexdigest(), written(spans), masked)
