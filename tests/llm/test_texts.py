"""Quality rules, packing, personal data and N-best segmentation against plain versions."""

import os
import random
import re
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest

from tallyfold.llm import nbest, packing, pii, quality

DOCS = "doc_id long, text string, ids string, part int, labels string"
ROWS = [(0, None), (1, ""), (2, " \n\t "), (3, "one two three one two three\n\nx\nx"), (3, "one two three one two three\n\nx\nx"),
        (None, "é#$ %& <>| *\x1c\x85 a"), (4, "word " * 30000), (5, "a" * 200000)]


def docs(spark, rows):
    return spark.createDataFrame([(i, t, "x", 1, "y") for i, t in rows], DOCS)


def plain_counts(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    windows = list(zip(words, words[1:], words[2:]))
    hit = {k + d for k, w in enumerate(windows) if windows.count(w) > 1 for d in range(3)} if len(words) < 2000 else None
    lines = [x for x in (text or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text or "")), len(lines) - len(set(lines)),
            len(words) if hit is None else len(hit))


def test_quality_counts(spark):
    rng = random.Random(1)
    noise = [(10 + k, "".join(rng.choice("ab  \n\té#|") for _ in range(rng.randint(0, 300)))) for k in range(60)]
    got = quality.judge(docs(spark, ROWS + noise)).collect()
    for (i, text), r in zip(ROWS + noise, got):
        assert (r.doc_id, *r[1:6]) == (i, *plain_counts(text))
        assert r.base_failed == (r.n_words < 50 or 100 * r.n_repeat_words > 50 * r.n_words)
        assert not (r.base_failed and r.kept)
    assert quality.judge(docs(spark, [])).count() == 0


def test_compression_bands(spark):
    rng = random.Random(2)
    letters = "etaoinshrdlucmfw"
    names = ["".join(rng.choices(letters, k=rng.randint(2, 9))) for _ in range(2500)]
    prose = " ".join(rng.choices(names, k=600))
    said_often = " ".join(f"{k} {names[0]} {names[1]} {names[2]} {names[3]} {names[4]} {names[5]}" for k in range(10, 150))
    noise = " ".join("".join(chr(rng.randint(33, 126)) for _ in range(9)) for _ in range(400))
    verdict = {r.doc_id: (r.base_failed, r.kept) for r in quality.judge(
        docs(spark, [(0, prose), (2, noise)])).collect()}
    assert verdict == {0: (False, True), 2: (False, False)}
    packer = quality.zstandard.ZstdCompressor(level=3)
    assert not quality.band_verdict(said_often.encode() * 3, quality.CompressionRules(), packer)[2]


def test_packing(spark):
    from tokenizers import Tokenizer

    rng = random.Random(3)
    rows = ROWS[:6] + [(4, "word " * 7000)] + [(20 + k, " ".join(rng.choices("Alpha beta, don't é9 <|endoftext|> x-y".split(), k=rng.randint(0, 90))))
                                             for k in range(120)]
    path = public_tokenizers.path("word_bpe_49k.json")
    plain = Tokenizer.from_file(path)
    got = packing.pack(docs(spark, rows).repartition(20), path, window=256, most_open=3).collect()
    whole = {}
    for i, t in rows:
        ids = plain.encode(t or "", add_special_tokens=False).ids + [2]
        whole.setdefault((i, len(ids)), []).append(ids)
    by_doc, by_sequence = {}, {}
    for r in got:
        by_doc.setdefault((r.doc_id, r.doc_tokens), []).append(r)
        by_sequence.setdefault(r.sequence_id, []).append(r)
    assert set(by_doc) == set(whole)
    for key, pieces in by_doc.items():
        copies = whole[key]
        assert sum(p.length for p in pieces) == sum(map(len, copies))
        for p in pieces:
            assert zlib.crc32(np.array(copies[0][p.start:p.start + p.length], "<u4").tobytes()) == p.ids_crc32
    for pieces in by_sequence.values():
        at = 0
        for p in sorted(pieces, key=lambda p: p.offset):
            assert p.offset == at
            at += p.length
        assert at == p.sequence_tokens <= 256 and at & (at - 1) == 0
    assert packing.pack(docs(spark, []), path).count() == 0


def test_patterns():
    rng = random.Random(4)
    email = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
    ip = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
    for _ in range(5000):
        s = "".join(rng.choice("a1.@-é +") for _ in range(rng.randint(0, 22)))
        assert list(pii.emails(s)) == [m.span() for m in email.finditer(s)]
        s = "".join(rng.choice("12.. ") for _ in range(rng.randint(0, 22)))
        assert [m.span() for m in pii._IP.finditer(s)] == [m.span() for m in ip.finditer(s)]
    assert pii.luhn("4111111111111111") and not pii.luhn("4111111111111112")


def test_field_learns_and_decodes():
    index, weights, moves = pii.trained()
    words, links = pii.Words(index, weights.astype(np.float32)), moves.astype(np.float32)
    lines = pii.labelled()
    classes = [words.classes(" ".join(w).encode()) for w, _ in lines]
    got = pii.decode(classes, np.stack(words.tables), links)
    assert sum(g.tolist() == l for g, (_, l) in zip(got, lines)) >= len(lines) - 1
    rng = random.Random(5)
    texts = [" ".join(" ".join(w) for w, _ in rng.sample(lines, rng.randint(0, 5))) for _ in range(150)]
    classes = [words.classes(t.encode()) for t in texts]
    tables = np.stack(words.tables)
    pruned, whole = pii.decode(classes, tables, links), pii.decode(classes, tables, links, whole=True)
    assert all((a == b).all() for a, b in zip(pruned, whole)) and any(a.any() for a in whole)
    # the chain's best labelling, one text at a time over all labels
    for c in classes[:40]:
        if len(c):
            scores = pii.emissions(np.concatenate(([0, 0], c, [0, 0])), tables)[2:-2]
            best = scores[0] + links[0]
            for row in scores[1:]:
                best = (best[:, None] + links).max(axis=0) + row
            path = pii.decode([c], tables, links)[0]
            value = links[0, path[0]] + scores[np.arange(len(c)), path].sum() + links[path[:-1], path[1:]].sum() + links[path[-1], 0]
            assert value == pytest.approx((best + links[:, 0]).max(), abs=1e-2)


def test_personal_data(spark):
    rows = ROWS + [(7, "é a.b@c.de, 10.0.0.7 and 4111 1111 1111 1111 or +1 (743) 555-3824."),
                   (8, "mail bob [at] acme [dot] io please"), (9, "call (734) 555-2211 today"), (10, "look at the dot or 1234567890")]
    got = {r.doc_id: r for r in pii.find(docs(spark, rows), mask=True).collect()}
    assert got[7].spans == "email:2:10,ip:12:20,card:25:44,phone:48:65"
    assert got[7].masked == "é [email], [ip] and [card] or [phone]."
    assert got[8].masked == "mail [email] please" and got[9].n_phone == 1 and got[10].spans == ""
    assert got[0].masked is None and got[1].masked == "" and got[5].spans == ""
    assert pii.find(docs(spark, [])).count() == 0


def test_n_best_equals_enumeration():
    mark = nbest.MARK
    toy = nbest.Vocabulary({mark: (1, -1.), mark + "a": (2, -1.7), "a": (3, -1.1), "b": (4, -1.3), "ab": (5, -2.05),
                            "ba": (6, -2.9), "aa": (7, -2.3), "abb": (8, -3.01), mark * 2: (9, -1.2)}, {b: 100 + b for b in range(256)}, {})

    def every(into, j):
        if j == 0:
            yield 0.0, ()
        for i, s, ids in into[j]:
            for a, b in every(into, i):
                yield a + s, b + ids

    rng = random.Random(6)
    for _ in range(200):
        t = "".join(rng.choice("aab  é") for _ in range(rng.randint(0, 9)))
        full = mark + t.replace(" ", mark) if t else ""
        known = sorted(every(toy.edges(full), len(full)), key=lambda x: -x[0])
        got = toy.segmentations(t, 5)
        assert [s for s, _ in got] == pytest.approx([s for s, _ in known[:5]])
        assert len({i for _, i in got}) == len(got)


def test_portions_of_texts_find_what_one_text_finds(monkeypatch):
    model = public_tokenizers.path("piece_bpe_32k.model")
    rng = random.Random(8)
    parts = ["the", "ing", " ", "  ", "\n", "é", "語", "\U0001f600", nbest.MARK, "x", "er", "\ufffd", "ab" * 30]
    texts = [None, "", " ", "a ", "  b", *("".join(rng.choice(parts) for _ in range(rng.randint(0, 20))) for _ in range(300))]
    alone = nbest.Vocabulary.load(model)

    def by_words(text):
        """Best way of a text from its words, looked at one by one."""
        ways = [alone.best_two(w) for w in alone.words(text or "")]
        return b"".join(w for w, _, _ in ways), sum(s for _, s, _ in ways)

    monkeypatch.setattr(nbest, "REMEMBERED", 20)  # so that words are forgotten and learned again
    table, asked = nbest.Vocabulary.load(model), []
    learn = table._learn
    monkeypatch.setattr(table, "_learn", lambda group, n: (asked.extend(group), learn(group, n))[1])
    column = pa.array(["left out", *texts], pa.string()).slice(1)
    for at in range(0, len(texts), 61):
        part = column.slice(at, 61)
        for text, (found, restored) in zip(part.to_pylist(), table.segment(part, 4)):
            assert (found[0][1], found[0][0]) == by_words(text)
            assert found == alone.segmentations(text or "", 4)
            assert restored == (alone.decode(found[0][1]) == (text or "")) and restored == (nbest.MARK not in (text or ""))
    asked.clear()
    again = [f for f, _ in table.segment(part, 4)]
    assert asked == [] and again == [alone.segmentations(t or "", 4) for t in part.to_pylist()]  # nothing is learned twice in a row


def test_n_best_restores_texts(spark):
    model = public_tokenizers.path("piece_bpe_32k.model")
    rows = ROWS + [(11, " two  spaces\tand\nlines ñ 語 \U0001f600 ")]
    encoded = nbest.encode(docs(spark, rows), model)
    got = encoded.collect()
    assert all(r.restored for r in got) and all(list(r.scores) == sorted(r.scores, reverse=True) for r in got)
    best = encoded.selectExpr("doc_id", "ids[0] AS ids")
    back = sorted((str(r.doc_id), r.text) for r in nbest.decode(best, model).collect())
    assert back == sorted((str(i), t or "") for i, t in rows)
    table = nbest.Vocabulary.load(model)
    words = {w for _, t in rows[3:7] for w in table.words(t or "")} | {"▁hello", "▁thentreor", "ñ", "▁a語b"}
    table.learn(words)
    learned = dict(table.memory.young)
    table.memory.young.clear()
    for w, one in learned.items():
        two = table.best_two(w)
        assert one[1] == pytest.approx(two[1]) and one[2] == pytest.approx(two[2]) and one[0] == two[0]
    assert nbest.encode(docs(spark, []), model).count() == 0


@pytest.mark.skipif(not os.path.isdir("/root/testdata/sf0.001"), reason="test tables not present")
def test_texts_go_together_up_to_a_size(monkeypatch):
    monkeypatch.setattr(nbest, "PORTION_BYTES", 100)
    texts = pa.array(["a" * 30, None, "b" * 60, "c" * 20, "d" * 500, "", "e"])
    assert list(nbest.portions(texts)) == [(0, 3), (3, 1), (4, 1), (5, 2)]
    assert list(nbest.portions(pa.array(["x"] * 5000, pa.string()).slice(100)))[0] == (0, 100)
    monkeypatch.setattr(nbest, "PORTION_BYTES", 8 << 20)
    assert list(nbest.portions(pa.array(["x"] * 1500))) == [(0, 1500)] and list(nbest.portions(pa.array([], pa.string()))) == []


def test_encoder_lets_go_of_its_words():
    encode = packing.WordEncoder(public_tokenizers.path("word_bpe_49k.json"))
    ids = encode(b"some words, said twice: some words")
    encode.forget()
    assert not any((encode.known.young, encode.known.old, encode.pieces.young, encode.pieces.old))
    assert encode(b"some words, said twice: some words") == ids


def test_pipeline_keeps_clean_documents(spark):
    import corpus_pipeline

    folder = "/root/testdata/sf0.001"
    documents = spark.read.parquet(f"{folder}/documents.parquet")
    rows = {r.doc_id: r.text for r in documents.collect()}
    judged = {r.doc_id: r.kept for r in quality.judge(documents).collect()}
    one = corpus_pipeline.quality_rules(spark, documents, folder)
    assert one.columns == documents.columns and {r.doc_id for r in one.collect()} == {i for i, k in judged.items() if k}
    packed = corpus_pipeline.run(spark, folder).collect()
    assert {r.doc_id for r in packed} <= {i for i, k in judged.items() if k}
    assert len({r.doc_id for r in packed}) > 0.5 * sum(judged.values()) and len(rows) == len(judged)
    empty = documents.limit(0)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, empty, folder).count() == 0
