"""Similarity join, ranked search and manifest against plain-Python versions."""

import hashlib
import math
import random
import re
import zlib
from itertools import combinations

import numpy as np
import pytest
from pyspark.sql import functions as F

from tallyfold.llm import common, jaccard, manifest, ranking

#: Extra columns named like internal ones.
DOCS = "doc_id long, text string, node long, key long, n long, slice long, _pos long"
WORD = re.compile("[^\x20\x09-\x0D]+")


def docs(spark, rows):
    return spark.createDataFrame([(i, t, 1, 2, 3, 4, 5) for i, t in rows], DOCS)


# ---------------------------------------------------------------- similarity join

def shingles(text, words=3):
    w = WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))
    n = min(words, len(w))
    return {" ".join(w[i:i + n]) for i in range(len(w) - n + 1)} if n else set()


def joined(rows, percent=90):
    sets = [shingles(t) for _, t in rows]
    up = {}

    def root(x):
        while up.setdefault(x, x) != x:
            x = up[x]
        return x

    for (a, (i, _)), (b, (j, _)) in combinations(enumerate(rows), 2):
        if i is None or j is None:
            continue
        both = len(sets[a] & sets[b])
        if i == j or sets[a] and 100 * both >= percent * len(sets[a] | sets[b]):
            if not (i == j and not (sets[a] and sets[b])):
                low, high = sorted((root(i), root(j)))
                up[high] = low
    return sorted(((i, len(s), i if i is None or not s else root(i)) for (i, _), s in zip(rows, sets)), key=str)


def near_copies(seed, groups=14):
    rng = random.Random(seed)
    pool = [f"w{k}" for k in range(3000)] + ["É", "ñu", "A", "b,"]
    common = [" ".join(rng.choices(pool, k=14)) for _ in range(4)]
    rows = []
    for _ in range(groups):
        base = rng.choices(pool, k=rng.choice([1, 2, 3, 8, 12, 30, 60, 200]))
        for _ in range(rng.choice([1, 2, 5, 12])):
            w = list(base)
            for _ in range(rng.choice([0, 0, 1, 1, 2, 4])):
                at = rng.randrange(len(w) + 1)
                w[at:at + rng.choice([0, 1])] = [rng.choice(pool)]
            rows.append((rng.choice(" \n\t").join(w).upper() if rng.random() < .2 else " ".join(w)) + " " + rng.choice(common + [""] * 6))
    rows += [None, "", " \n", "one", "ONE", "one two", "one  two", "one two three", "w1 " * 4000, "w1 W1 w1 w1"]
    rng.shuffle(rows)
    return list(zip(rng.sample(range(1000), len(rows)), rows))


@pytest.mark.parametrize("frequent, together, share", [((32, 1024), 2048, .25), ((2, 4), 4, .25), ((2, 3), 3, .4)])
def test_similar_documents(spark, monkeypatch, frequent, together, share):
    monkeypatch.setattr(jaccard, "FREQUENT", frequent)
    monkeypatch.setattr(jaccard, "TOGETHER", together)
    monkeypatch.setattr(common, "TOGETHER", together)
    monkeypatch.setattr(jaccard, "RANGE", share)
    rows = near_copies(7)
    got = sorted(map(tuple, jaccard.similar_documents(docs(spark, rows)).collect()), key=str)
    want = joined(rows)
    assert got == want and len({c for _, n, c in want if n}) < len(rows) - 20


def test_similar_documents_of_odd_rows(spark):
    text = " ".join(f"w{k}" for k in range(40))
    rows = [(None, text), (None, None), (3, text), (3, text), (3, text + " x"), (9, text + " x"), (4, "other words here"), (3, "other words here"),
            (5, None), (5, "")]
    got = sorted(map(tuple, jaccard.similar_documents(docs(spark, rows)).collect()), key=str)
    assert got == joined(rows)
    assert jaccard.similar_documents(docs(spark, [])).count() == 0


def test_prefixes_lose_no_pair():
    """Every pair of similar sets shares a key, whatever classes its tokens are in."""
    rng = random.Random(9)
    for _ in range(400):
        n = rng.choice([9, 10, 12, 20, 33, 64, 127, 128, 130, 300])
        top = 62 if rng.random() < .7 else 64
        tokens = sorted({rng.getrandbits(top) for _ in range(n)})
        more = sorted(set(tokens) - set(rng.sample(tokens, rng.randint(0, n // 20))) | {rng.randrange(1 << 63) for _ in range(rng.randint(0, n // 20))})
        both = len(set(tokens) & set(more))
        if 100 * both < 90 * len(set(tokens) | set(more)):
            continue
        held = {t: rng.choice([2, 5, 40, 40, 5000, 5000]) for t in set(tokens) & set(more)}
        keys = []
        for some in (tokens, more):
            head = np.array(some, np.uint64)
            counts = np.array([held.get(t, 1) if t < 1 << 62 else 0 for t in some], np.int64)
            keys.append(set(jaccard.signatures(head, counts, len(some), 90)))
        assert keys[0] & keys[1]


# ---------------------------------------------------------------- ranked search

TERM = re.compile("[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def terms(text):
    return TERM.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))


def ranked(rows, items, k):
    found = [terms(t) for _, t in rows]
    n_docs, total = sum(1 for f in found if f), sum(map(len, found))
    df = {}
    for f in found:
        for t in set(f):
            df[t] = df.get(t, 0) + 1
    out = []
    asked = {}
    for i, t in items:
        asked.setdefault(i, set()).update(terms(t))
    for item, wanted in asked.items():
        scores = []
        for (doc, _), f in zip(rows, found):
            score = 0
            for t in wanted:
                tf = f.count(t)
                if tf:
                    m = 100 - 90 + (90 * len(f) * n_docs) // total
                    score += math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * ((1000000000 * tf) // (1000 * tf + 8 * m))
            if score > 0:
                scores.append((-score, doc is not None, doc or 0))
        for rank, (s, known, doc) in enumerate(sorted(scores)[:k], 1):
            out.append((item, rank, doc if known else None, -s))
    return sorted(out, key=str)


@pytest.mark.parametrize("owners, size, block", [(4, 4096, 512), (3, 7, 2), (1, 5, 1)])
def test_search(spark, owners, size, block):
    rng = random.Random(4)
    pool = ["the", "The", "of", "É1", "ñ", "x9"] * 6 + [f"t{k}" for k in range(60)]
    rows = [(i, rng.choice(" \n,-").join(rng.choices(pool, k=rng.randint(0, 40)))) for i in range(120)]
    rows += [(500, None), (501, ""), (502, "?!"), (7, rows[7][1]), (None, rows[7][1]), (600, "the " * 3000), (601, rows[3][1]), (602, rows[3][1])]
    items = [(k, " ".join(rng.sample(pool, 5))) for k in range(9)] + [(9, None), (10, "absent"), (11, rows[3][1]), (None, "t1 t2"), (1, "t3 ñ"), (1, "t3")]
    asked = spark.createDataFrame([(i, t, 1, "x") for i, t in items], "item_id long, text string, block long, terms string")
    got = ranking.search(docs(spark, rows).repartition(5), asked, k=6, owners=owners, size=size, block=block)
    assert sorted(map(tuple, got.collect()), key=str) == ranked(rows, items, 6)
    assert ranking.search(docs(spark, []), asked).count() == 0
    assert ranking.search(docs(spark, rows[:3]), asked.limit(0)).count() == 0


# ---------------------------------------------------------------- manifest

def digest(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def tree(leaves):
    """(root, siblings of every leaf, level by level) of digests in order."""
    paths, level, owners = [[] for _ in leaves], list(leaves), [[i] for i in range(len(leaves))]
    while len(level) > 1:
        up, held = [], []
        for at in range(0, len(level), 3):
            run = level[at:at + 3]
            for k in range(len(run)):
                for leaf in owners[at + k]:
                    paths[leaf].append((run[:k], run[k + 1:]))
            up.append(digest(*run))
            held.append(sum(owners[at:at + 3], []))
        level, owners = up, held
    return level[0], paths


def brute_manifest(rows):
    """rows: (doc_id, source, text)."""
    def value(x):
        return "-" if x is None else f"{len(str(x).encode())}:{x}"

    leaf = [digest(*map(value, r)) for r in rows]
    claim = [digest(value(i), value(s), value(t.replace("\n", "") if t is not None and i is not None and zlib.crc32(str(i).encode()) % 2 == 0 else t))
             for i, s, t in rows]
    order = lambda k: (rows[k][0] is not None, rows[k][0] or 0, leaf[k], claim[k])
    sources = sorted({s for _, s, _ in rows}, key=lambda s: (s is not None, (s or "").encode()))
    parts = {s: sorted((k for k, r in enumerate(rows) if r[1] == s), key=order) for s in sources}
    grown = {s: tree([leaf[k] for k in ks]) for s, ks in parts.items()}
    root, over = tree([grown[s][0] for s in sources])
    out = []
    for s, above in zip(sources, over):
        for k, path in zip(parts[s], grown[s][1]):
            node = claim[k]
            for before, after in path + above:
                node = digest(*before, node, *after)
            proof = "".join("".join(b + a) for b, a in path + above)
            out.append((rows[k][0], s, leaf[k], grown[s][0], root, proof, node, node == root))
    return sorted(out, key=str)


@pytest.mark.parametrize("height", [1, 2, 5])
def test_manifest(spark, height):
    rng = random.Random(height)
    rows = [(i, rng.choice(["a", "a", "a", "é", "Z", None, ""]), rng.choice(["x\ny", "no line end", "", None, "é\n\n" * 50])) for i in range(150)]
    rows += [(3, "a", "again"), (None, "a", "no id\n"), (9, None, None), rows[5], rows[5], (1, "alone", "x\n")]
    frame = spark.createDataFrame([(*r, 7, "y") for r in rows], "doc_id long, source string, text string, _pos long, leaf string").repartition(6)
    fields = ["doc_id", "source", "text"]
    claimed = manifest.row_digest(F.col("doc_id"), F.col("source"), manifest.tampered(F.col("text"), F.col("doc_id")))
    got = manifest.manifest(frame, fields, claimed=claimed, height=height)
    assert sorted(map(tuple, got.collect()), key=str) == brute_manifest(rows)
    clean = manifest.manifest(frame, fields, height=height)
    assert clean.where("not verified").count() == 0 and clean.select("root").distinct().count() == 1
    assert manifest.manifest(frame.limit(0), fields).count() == 0
