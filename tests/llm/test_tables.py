"""Archives, URLs, chats and neighbours; registered queries against their SQL."""

import hashlib
import os
import random

import duckdb
import numpy as np
import pytest

from tallyfold.llm import chat, neighbours, queries, url_filter, warc
from tallyfold.session import scratch_path

FOLDER = "/root/testdata/sf0.001"


def test_archives_hold_against_magic_in_payloads(spark):
    rng = random.Random(2)
    big = "x" * 1200
    fake = "WARC/1.0\r\nWARC-Type: response\r\nWARC-Target-URI: https://records.invalid/page/9\r\nContent-Length: 5\r\n\r\nhello\r\n\r\n"
    rows = [(i, None if i == 3 else "" if i == 4 else big if i % 7 == 0 else ("é%d " % i) * rng.randint(1, 300)
             + fake * (i % 5 == 0) + "WARC/1.0\r\n" * (i % 6 == 0)) for i in range(60)]
    rows += [(None, "no id"), (7, big), (500, fake * 200)]
    pages = spark.createDataFrame([(i, h, "u", "r") for i, h in rows], "page_id long, html string, digest string, last string")
    last = max(i for i, h in rows if h == big)
    expected = sorted(((i, len((h or "").encode()), hashlib.sha1((h or "").encode()).hexdigest(),
                        "revisit" if h == big and i != last else "response", last if h == big and i != last else None)
                       for i, h in rows), key=str)
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    for split, block in (("128m", warc.BLOCK), ("16k", 3000)):  # the second cuts files and chains into many blocks
        spark.conf.set("spark.sql.files.maxPartitionBytes", split)
        try:
            path = scratch_path(spark, "warc-test")
            warc.write_archives(pages.repartition(2), path)
            got = warc.pages_of(warc.read_archives(spark, path, False, block)).collect()
            payloads = [hashlib.sha1(r.payload).hexdigest() == r.payload_digest
                        for r in warc.read_archives(spark, path, True, block).collect()]
        finally:
            spark.conf.set("spark.sql.files.maxPartitionBytes", before)
        assert sorted((tuple(r)[:5] for r in got), key=str) == expected and all(r.intact for r in got) and all(payloads)


def test_archives_with_long_and_folded_headers(spark, tmp_path):
    def record(k, extra, body=b"body", length=None, version=b"WARC/1.0"):
        return (version + b"\r\nWARC-Type: response\r\n" + extra + b"WARC-Target-URI: https://records.invalid/page/%d\r\n" % k
                + b"Content-Length: %d\r\n\r\n" % (len(body) if length is None else length) + body + b"\r\n\r\n")

    def read(name, *records):
        (tmp_path / name).mkdir()
        (tmp_path / name / "a.warc").write_bytes(b"".join(records))
        return sorted(r.page_id for r in warc.pages_of(warc.read_archives(spark, str(tmp_path / name))).collect())

    long, folded = b"X-Long: " + b"y" * 9000 + b"\r\n", b"X-Folded: one\r\n two\r\n\tthree\r\n"
    magic = b"a WARC/1.0\r\n b"
    assert read("whole", record(0, b""), record(1, long), record(2, folded), record(3, long, magic), record(4, b"")) == [0, 1, 2, 3, 4]
    assert read("cut", record(0, b""), record(1, b"")[:-6]) == [0]
    assert warc.parse_header(folded + b"WARC-Type: x\r\nContent-Length: 3\r\n\r\n")[1]["x-folded"] == "one two three"
    for k, parts in enumerate(([record(0, b""), record(1, b"no colon\r\n"), record(2, b"")], [record(0, b"", version=b"WARC/1.1")],
                               [record(0, b""), record(1, b"", length=3), record(2, b"")], [b"no archive"])):
        with pytest.raises(ValueError, match="no record follows"):
            read(f"broken{k}", *parts)


def test_url_rules_and_parts(spark):
    rows = [(0, "https://A.Example.ORG/es/1?x#y"), (1, "http://example.org/en/12"), (2, "ftp://org/"), (3, "http://org"),
            (4, "x://a.com/fr/"), (5, "x://a.com/de/?q"), (6, None), (7, ""), (8, "no scheme/path"), (9, "http://example.org:80/es/"),
            (10, "http://notorg/x"), (11, "a://b://c/d"), (11, "a://b://c/d"), (12, "http://h/" + "a" * 100000)]
    pages = spark.createDataFrame([(i, u, 1.0, "z") for i, u in rows], "page_id long, url string, ending double, guess string")
    got = [tuple(r)[:5] for r in url_filter.filter_urls(pages).collect()]
    by_id = {r[0]: r[1:] for r in got}
    assert by_id[0] == ("a.example.org", "/es/1", "example.org/es/", "block")
    assert by_id[1] == ("example.org", "/en/12", "example.org/en/1", "block")
    assert by_id[2] == ("org", "/", "org/", "allow") and by_id[3][:3] == ("org", "", None)
    assert by_id[4] == ("a.com", "/fr/", "com/fr/", "allow") and by_id[5] == ("a.com", "/de/", "com/de/", "block")
    assert by_id[6][:3] == ("", "", None) and by_id[7][:3] == ("", "", None) and by_id[8][:3] == ("", "", None)
    assert by_id[9][:3] == ("example.org:80", "/es/", None) and by_id[10][2] is None and by_id[11][:2] == ("b:", "//c/d")
    assert len(got) == len(rows) and all(r[4] in ("allow", "block") for r in got)
    assert {r.verdict for r in url_filter.filter_urls(pages.where("page_id = 8")).collect()} == {"allow"}
    assert url_filter.filter_urls(pages.limit(0)).count() == 0


def test_url_trees_on_held_out_urls(spark):
    rng = random.Random(3)
    def made(bad):
        path = "/".join("".join(rng.choices("abcdef0123456789", k=12)) for _ in range(4)) if bad else "/".join(rng.choices(["news", "about", "item"], k=2))
        return f"http://site{rng.randint(0, 50)}.{'biz' if rng.random() < .5 else 'net'}/{path}" + ("?a=1&b=2&c=3" if bad and rng.random() < .7 else "")
    rows = [(made(k % 2), k % 2) for k in range(600)]
    model = url_filter.train(spark.createDataFrame(rows[:400], "url string, label int"), rounds=5)
    held = spark.createDataFrame(rows[400:], "url string, label int").withColumn(
        "ending", url_filter.ending(url_filter.parts(url_filter.F.col("url"))[0]))
    got = model.judged(held).collect()
    assert sum((r.guess == "block") == (r.label == 1) for r in got) > 0.95 * len(got)


def test_url_endings_do_not_mix(spark):
    rows = [(f"http://a.s{k}.net/x/{j}", int(k < 4500)) for k in range(9000) for j in range(2)]
    model = url_filter.train(spark.createDataFrame(rows, "url string, label int"), sample=400, rounds=1)
    asked = spark.createDataFrame([("s7.net",), ("s8007.net",), ("unseen.net",)], "ending string").withColumn("url", url_filter.F.lit("x"))
    got = {r.ending: (r.ending_rate, r.ending_count) for r in url_filter.with_rates(asked, model.rates, model.usual).collect()}
    assert got["s7.net"] == pytest.approx((4.5 / 7, np.log1p(2))) and got["s8007.net"] == pytest.approx((2.5 / 7, np.log1p(2)))
    assert got["unseen.net"] == (0.5, 0.0)
    assert sum((r.guess == "block") == (r.label == 1) for r in model.judged(spark.createDataFrame(rows[::90], "url string, label int").withColumn(
        "ending", url_filter.ending(url_filter.parts(url_filter.F.col("url"))[0]))).collect()) == 200


def test_chats_collapse(spark, monkeypatch):
    say = lambda c, *texts: [(c, k, "user" if k % 2 == 0 else "assistant", t, 9) for k, t in enumerate(texts)]
    rows = say(1, "a") + say(2, "a", "b") + say(3, "a", "b", "c") + say(4, "a", "x") + say(5, "a", "b", "c") + say(6, "", None)
    rows += say(7, "") + say(8, *[f"t{k}" for k in range(40)]) + say(9, *[f"t{k}" for k in range(33)]) + say(None, "q", "r") + say(1, "a")
    turns = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, place int")
    for stretch in (1024, 4):  # long conversations in several stretches
        monkeypatch.setattr(chat, "STRETCH", stretch)
        got = {r.conv_id: (r.turns, r.chat) for r in chat.format_chats(turns).collect()}
        assert sorted(map(str, got)) == sorted(["3", "4", "6", "8", "None"])
        assert got[3] == (3, "<|user|>\na\n<|assistant|>\nb\n<|user|>\nc\n") and got[8][0] == 40
    assert chat.format_chats(turns.limit(0)).count() == 0


def test_neighbours(spark, monkeypatch):
    rng = np.random.default_rng(4)
    x = rng.normal(size=(1200, 16)) * rng.uniform(.5, 2, (1200, 1))
    x[100] *= 10
    x[100:160] = x[100]  # long copies, nearest to each other: ties go to the smaller id
    rows = [(i, [float(v) for v in x[i]], "c") for i in range(1200)]
    rows += [(2000, None, "c"), (2020, [0.0] * 16, "c"), (2040, [float("nan")] + [1.0] * 15, "c"), (2060, [None] + [1.0] * 15, "c"),
             (2080, [1.0] * 3, "c"), (None, [1.0] * 16, "c"), (40, rows[40][1], "c")]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>, key string")
    scores = x @ x.T
    expected = {q: [(int(i), scores[q, i]) for i in np.lexsort((np.arange(1200), -scores[q].round(9))) if i != q][:20]
                for q in range(0, 1200, 20)}
    for chunk in (8192, 50):  # the second deals large buckets out
        monkeypatch.setattr(neighbours, "CHUNK", chunk)
        got = {}
        for r in neighbours.search(table, table.where("vec_id % 20 = 0")).collect():
            got.setdefault(r.query_id, []).append((r.rank, r.vec_id, r.score))
        assert set(got) == set(expected)
        hit = 0
        for q, near in got.items():
            near.sort()
            assert [n for n, _, _ in near] == list(range(1, 21))
            assert all(s == pytest.approx(scores[q, v]) and v != q for _, v, s in near)
            hit += len({v for _, v, _ in near} & {v for v, _ in expected[q]})
        assert hit >= 0.95 * 20 * len(got)
        assert [v for _, v, _ in got[100]] == [v for v, _ in expected[100]] == list(range(101, 121))
    assert neighbours.search(table.limit(0), table.limit(0)).count() == 0


def test_neighbours_of_equal_score(spark):
    # distinct sign vectors that all score alike: the smallest ids count
    rng = np.random.default_rng(5)
    rows = [(0, [1.0] + [0.0] * 11)]
    tail = list({tuple(x) for x in rng.choice([-1.0, 1.0], (900, 11)).tolist()})
    first = rng.choice([0.05, 0.1], len(tail)).tolist()
    rows += [(k + 1, [x, *t]) for k, (x, t) in enumerate(zip(first, tail))]
    best = [k + 1 for k, x in enumerate(first) if x == 0.1][:20]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = sorted((r.rank, r.vec_id, r.score) for r in neighbours.search(
        table, table.where("vec_id = 0"), least=10**6).collect())
    assert got == [(k, i, 0.1) for k, i in enumerate(best, 1)]


@pytest.mark.skipif(not os.path.isdir(FOLDER), reason="test tables not present")
@pytest.mark.parametrize("query", [q for q in queries.QUERIES if q.sql], ids=lambda q: q.name)
def test_query_equals_sql(spark, query):
    con = duckdb.connect()
    for t in ("documents", "embeddings", "pages", "conversations"):
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{FOLDER}/{t}.parquet'")
    df, answer = query.run(spark, FOLDER), con.sql(query.sql)
    order = sorted(df.columns)
    assert order == sorted(answer.columns)
    theirs = sorted(str([row[answer.columns.index(c)] for c in order]) for row in answer.fetchall())
    assert sorted(str([r[c] for c in order]) for r in df.collect()) == theirs
