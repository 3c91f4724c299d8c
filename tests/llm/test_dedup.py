"""Suffix sorting and SimHash against brute force."""

import hashlib
import random

import numpy as np
import pytest

from tallyfold.llm import common, quality, simhash, suffix_dedup
from tallyfold.llm.simhash import fingerprint, keep_one, near_duplicates
from tallyfold.llm.suffix_dedup import adjacent_prefixes, anchors, remove_repeats, suffix_array

DOCS = "doc_id long, text string, h long, fp string, n_bytes int, k1 string"


def docs(spark, rows):
    return spark.createDataFrame([(i, t, 1, "x", 2, "y") for i, t in rows], DOCS)


def test_suffix_array_and_prefixes():
    rng = random.Random(1)
    for _ in range(150):
        n, k = rng.randint(0, 60), rng.choice([1, 2, 3, 250])
        text = np.array([rng.randint(0, k) for _ in range(n)], np.uint8)
        raw = text.tobytes()
        order = suffix_array(text, 10**6)
        assert order.tolist() == sorted(range(n), key=lambda i: raw[i:])
        wanted = np.array([rng.random() < .5 for _ in range(n)], bool)
        assert suffix_array(text, 10**6, wanted).tolist() == [i for i in order.tolist() if wanted[i]]
        shared = adjacent_prefixes(text, order, 12)
        for i in range(1, n):
            a, b, c = raw[order[i - 1]:], raw[order[i]:], 0
            while c < min(len(a), len(b), 12) and a[c] == b[c]:
                c += 1
            assert c == shared[i]


def test_every_window_has_an_anchor(monkeypatch):
    rng = random.Random(2)
    data = bytes(rng.randint(97, 102) for _ in range(3000))
    position, hashes, pieces = anchors(data, 40, 16)
    assert all(((position >= s) & (position <= s + 24)).any() for s in range(len(data) - 39))
    monkeypatch.setattr(suffix_dedup, "BLOCK", 256)  # long texts are hashed block by block
    again = anchors(data, 40, 16)
    assert [x.tolist() for x in again] == [x.tolist() for x in (position, hashes, pieces)]


def brute(rows, length):
    seen = {}
    data = [(t or "").encode() for _, t in rows]
    for b in data:
        for j in range(len(b) - length + 1):
            seen[b[j:j + length]] = seen.get(b[j:j + length], 0) + 1
    out = []
    for (i, _), b in zip(rows, data):
        gone = np.zeros(len(b), bool)
        for j in range(len(b) - length + 1):
            if seen[b[j:j + length]] > 1:
                gone[j:j + length] = True
        spans = int((np.diff(np.concatenate(([0], gone.astype(int), [0]))) == 1).sum())
        kept = bytes(np.frombuffer(b, np.uint8)[~gone])
        out.append((i, len(b), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def texts(seed):
    rng = random.Random(seed)
    noise = lambda n: "".join(rng.choice("abcdé ") for _ in range(n))
    shared = [noise(n) for n in (19, 20, 21, 45, 120)]
    rows = [(i, noise(rng.randint(0, 60)) + rng.choice(shared) + noise(rng.randint(0, 60)) + rng.choice(shared))
            for i in range(80)]
    return rows + [(90, None), (91, ""), (5, rows[5][1]), (None, rows[7][1]), (92, "a" * 300), (93, "ab" * 90),
                   (94, noise(3000))]


@pytest.mark.parametrize("together", [256, 2])
def test_remove_repeats(spark, monkeypatch, together):
    monkeypatch.setattr(suffix_dedup, "TOGETHER", together)  # 2: most anchors go by stretches and digests
    rows = texts(3)
    got = remove_repeats(docs(spark, rows), length=20, gram=8).drop("kept").collect()
    assert sorted(map(tuple, got), key=str) == brute(rows, 20)


@pytest.mark.parametrize("together", [4096, 8])
def test_remove_repeats_around_runs(spark, monkeypatch, together):
    # inside a run one anchor hash stands at neighbouring places, whose pieces hold the same windows
    monkeypatch.setattr(suffix_dedup, "TOGETHER", together)
    rng = random.Random(6)
    noise = lambda n: "".join(rng.choice("abcdefghijklmnop") for _ in range(n))
    low = min("ABCDEFGHIJKLMNOPQRSTUVWXYZ", key=lambda c: suffix_dedup.Hasher(np.frombuffer(c.encode() * 8, np.uint8)).grams(8)[0])
    rows = [(i, noise(25) + low * rng.randint(16, 19) + noise(25)) for i in range(60)]
    rows += [(100 + i, noise(25) + ("yz" * 10)[:rng.randint(16, 19)] + noise(25)) for i in range(20)]
    got = remove_repeats(docs(spark, rows), length=20, gram=8).drop("kept").collect()
    expected = brute(rows, 20)
    assert sorted(map(tuple, got), key=str) == expected
    assert 0 < sum(r[2] == 0 for r in expected) < len(expected)


def test_remove_repeats_empty(spark):
    assert remove_repeats(docs(spark, [])).count() == 0


def words(rng, n):
    return " ".join(rng.choice("alpha beta gamma delta eps zeta eta theta".split()) for _ in range(n))


def test_near_duplicates(spark, monkeypatch):
    rng = random.Random(4)
    base = [words(rng, 120) for _ in range(12)]
    rows = [(i, base[i % 12] + (" " + words(rng, 2) if i % 3 else "")) for i in range(60)]
    rows += [(60, None), (61, ""), (62, "one two"), (63, "ONE  two"), (64, base[0]), (64, base[0]), (None, base[1])]
    expected = components_of(rows)
    for chunk, small in ((4096, 16), (2, 1)):  # the second deals every key out in pairs of chunks
        monkeypatch.setattr(simhash, "CHUNK", chunk)
        monkeypatch.setattr(simhash, "SMALL", small)
        got = near_duplicates(docs(spark, rows)).collect()
        assert sorted(((r.doc_id, r.component_id) for r in got), key=str) == expected
    assert {r.fingerprint for r in got if r.doc_id in (60, 61)} == {"0" * 16}
    kept = keep_one(docs(spark, rows)).collect()
    assert sorted(r.doc_id for r in kept) == sorted({c for _, c in expected})
    assert near_duplicates(docs(spark, [])).count() == 0


def components_of(rows):
    prints = np.array([fingerprint((t or "").encode(), 4) for _, t in rows], np.uint64)
    label = list(range(len(rows)))
    changed = True
    while changed:
        changed = False
        for i in range(len(rows)):
            near = np.flatnonzero(np.bitwise_count(prints ^ prints[i]) <= 4)
            low = min(label[j] for j in near)
            for j in near:
                changed |= label[j] != low
                label[j] = low
    first = {}
    for (i, _), c in zip(rows, label):
        if i is not None:
            first[c] = min(first.get(c, i), i)
    return sorted(((i, first.get(c)) for (i, _), c in zip(rows, label)), key=str)


def test_pairs_within_distance_share_a_key(spark):
    rng = random.Random(5)
    masks = simhash.segment_masks(4)
    assert sum(masks) == (1 << 64) - 1
    chains = simhash.Chains(4)
    for _ in range(300):
        a = rng.getrandbits(64)
        b = a
        for bit in rng.sample(range(64), rng.randint(1, 4)):
            b ^= 1 << bit
        met = []
        for i, mask in enumerate(masks):
            for half in simhash._halves(masks[(i + 1) % 5]):
                if (a ^ b) & (mask | half) == 0:
                    met.append(chains.linked(np.array([a], np.uint64), np.array([b], np.uint64), i)[0])
        assert any(met)


def test_components_of_a_path_and_a_star(spark):
    path = [(i, i + 1) for i in range(0, 40)] + [(100, i) for i in range(101, 140)] + [(7, 7)]
    got = dict(map(tuple, common.components(spark.createDataFrame(path, "a long, b long")).collect()))
    assert got == {**{i: 0 for i in range(41)}, **{i: 100 for i in range(100, 140)}}


def test_a_text_reaches_its_task_once(spark, monkeypatch):
    sent = []

    def kept(module, name):
        old = getattr(module, name)
        monkeypatch.setattr(module, name, lambda df, run, schema: sent.append(len(df.columns)) or old(df, run, schema))

    kept(simhash, "map_arrow")
    kept(quality, "map_pandas")
    texts = spark.createDataFrame([(1, "Äne b c d e"), (2, None), (3, "")], "doc_id long, text string")
    assert sorted(map(tuple, simhash.fingerprints(texts, passing=("doc_id", "text")).collect())) == sorted(
        (*r, p._fp) for r, p in zip(texts.collect(), simhash.fingerprints(texts).orderBy("doc_id").collect()))
    assert quality.judge(texts, quality.CompressionRules(), passing=("doc_id", "text")).count() == 3
    assert sent == [2, 2, 2]
