"""Registered queries: each operator with its production parameters over its whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyfold.catalog.registry import Query
from tallyfold.llm import chat, jaccard, manifest, nbest, neighbours, packing, pii, quality, ranking, simhash, suffix_dedup, url_filter, warc
from tallyfold.llm.common import table
from tallyfold.session import scratch_path

#: Words in a shingle and greatest bit distance of near-duplicates by SimHash.
SHINGLE, DISTANCE = 4, 4
QUERY_STEP = 20


def tokenizer_path(name: str) -> str:
    """Where a public vocabulary file lies; the package is part of every machine's Python."""
    import public_tokenizers

    return public_tokenizers.path(name)


def suffix_array_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return suffix_dedup.remove_repeats(table(spark, folder, "documents")).drop("kept")


def warc_round_trip(spark: SparkSession, folder: str) -> DataFrame:
    path = scratch_path(spark, "warc")
    warc.write_archives(table(spark, folder, "pages"), path)
    return warc.pages_of(warc.read_archives(spark, path, payload=False)).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def url_verdicts(spark: SparkSession, folder: str) -> DataFrame:
    return url_filter.filter_urls(table(spark, folder, "pages"))


def compression_quality(spark: SparkSession, folder: str) -> DataFrame:
    return quality.judge(table(spark, folder, "documents"))


def chat_format(spark: SparkSession, folder: str) -> DataFrame:
    return chat.format_chats(table(spark, folder, "conversations"))


def bounded_packing(spark: SparkSession, folder: str) -> DataFrame:
    return packing.pack(table(spark, folder, "documents"), tokenizer_path("word_bpe_49k.json"))


def cross_polytope_search(spark: SparkSession, folder: str) -> DataFrame:
    vectors = table(spark, folder, "embeddings")
    return neighbours.search(vectors, vectors.where(F.col("vec_id") % QUERY_STEP == 0), k=20)


def simhash_components(spark: SparkSession, folder: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, folder, "documents"), SHINGLE, DISTANCE)


def nbest_segmentation(spark: SparkSession, folder: str) -> DataFrame:
    """The four best segmentations of every text; ``restored`` says whether the best one decodes to it."""
    return nbest.digests(nbest.encode(table(spark, folder, "documents"), tokenizer_path("piece_bpe_32k.model"), n=4))


def crf_personal_data(spark: SparkSession, folder: str) -> DataFrame:
    return pii.find(table(spark, folder, "documents"))


def ngram_jaccard(spark: SparkSession, folder: str) -> DataFrame:
    return jaccard.similar_documents(table(spark, folder, "documents"), words=3, percent=90)


def ranked_search(spark: SparkSession, folder: str) -> DataFrame:
    return ranking.search(table(spark, folder, "documents"), table(spark, folder, "benchmark"), k=10)


def merkle_manifest(spark: SparkSession, folder: str) -> DataFrame:
    """The manifest of all documents, checked against texts of which some lost their line ends."""
    fields = ["doc_id", "source", "lang", "n_chars", "text"]
    now = {c: F.col(c) for c in fields} | {"text": manifest.tampered(F.col("text"), F.col("doc_id"))}
    found = manifest.manifest(table(spark, folder, "documents"), fields, claimed=manifest.row_digest(*now.values()))
    return found.select("doc_id", "leaf", "subroot", "root", F.sha2(F.col("proof").cast("binary"), 256).alias("proof_sha256"),
                        "folded_root", "verified")


def pipeline(spark: SparkSession, folder: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, folder)


WARC_SQL = """
WITH p AS (SELECT page_id, coalesce(html, '') AS h FROM pages),
d AS (SELECT page_id, octet_length(encode(h)) AS n, sha1(h) AS digest FROM p),
last AS (SELECT digest, max(page_id) AS last FROM d WHERE n >= 1000 GROUP BY digest)
SELECT d.page_id, CAST(d.n AS BIGINT) AS payload_bytes, d.digest AS payload_digest,
       CASE WHEN last.last IS NOT NULL AND last.last <> d.page_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN last.last <> d.page_id THEN last.last END AS refers_to
FROM d LEFT JOIN last ON d.digest = last.digest AND d.n >= 1000
"""

CHAT_SQL = """
WITH t AS (SELECT DISTINCT conv_id, turn, role, text FROM conversations),
c AS (SELECT conv_id, count(*) AS turns,
             list({'role': role, 'text': text} ORDER BY turn NULLS FIRST, role NULLS FIRST, text NULLS FIRST) AS said
      FROM t GROUP BY conv_id),
beginnings AS (SELECT DISTINCT said[1:n] AS said FROM (SELECT said, turns, unnest(range(1, turns)) AS n FROM c)),
kept AS (SELECT min(conv_id) AS conv_id, said FROM c GROUP BY said)
SELECT k.conv_id, CAST(len(k.said) AS BIGINT) AS turns,
       list_reduce(list_transform(k.said, lambda s:
           '<|' || coalesce(s.role, '') || '|>' || chr(10) || coalesce(s.text, '') || chr(10)), lambda a, b: a || b) AS chat
FROM kept k ANTI JOIN beginnings b ON k.said = b.said
"""

JACCARD_SQL = r"""
WITH RECURSIVE d AS (
    SELECT doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w
    FROM documents),
s AS (SELECT doc_id, CASE WHEN w IS NULL OR len(w) = 0 THEN [] WHEN len(w) < 3 THEN [array_to_string(w, ' ')]
             ELSE list_distinct(list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2])) END AS s FROM d),
e AS (SELECT doc_id, CAST(len(s) AS BIGINT) AS n, unnest(s) AS g FROM s),
p AS (SELECT a.doc_id AS a, b.doc_id AS b FROM e a JOIN e b ON a.g = b.g AND a.doc_id < b.doc_id
          AND 100 * least(a.n, b.n) >= 90 * greatest(a.n, b.n)
      GROUP BY a.doc_id, b.doc_id HAVING 100 * count(*) >= 90 * (any_value(a.n) + any_value(b.n) - count(*))),
reach(doc_id, root) AS (
    SELECT b, a FROM p
    UNION
    SELECT x.other, r.root FROM reach r JOIN (SELECT a AS doc_id, b AS other FROM p UNION ALL SELECT b, a FROM p) x USING (doc_id))
SELECT s.doc_id, CAST(len(s.s) AS BIGINT) AS n_shingles, least(s.doc_id, min(r.root)) AS component_id
FROM s LEFT JOIN reach r USING (doc_id) GROUP BY s.doc_id, len(s.s)
"""

RANKED_SQL = r"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id,
                  regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                     '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS t FROM documents),
s AS (SELECT count(*) AS docs, CAST(sum(len(t)) AS BIGINT) AS total FROM d WHERE len(t) > 0),
f AS (SELECT r, doc_id, n, term, count(*) AS tf FROM (SELECT r, doc_id, CAST(len(t) AS BIGINT) AS n, unnest(t) AS term FROM d) GROUP BY ALL),
q AS (SELECT DISTINCT item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                     '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM benchmark),
w AS (SELECT term, CAST(floor(1000 * ln(CAST(2 * any_value(docs) + 2 AS DOUBLE) / CAST(2 * count(*) + 1 AS DOUBLE))) AS BIGINT) AS w
      FROM f, s GROUP BY term),
scores AS (SELECT q.item_id, f.r, f.doc_id,
                  CAST(sum(w.w * ((1000000000 * f.tf) // (1000 * f.tf + 8 * (100 - 90 + ((90 * f.n * s.docs) // s.total))))) AS BIGINT) AS score
           FROM q JOIN f USING (term) JOIN w USING (term), s GROUP BY q.item_id, f.r, f.doc_id),
ranked AS (SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank, doc_id, score
           FROM scores WHERE score > 0)
SELECT * FROM ranked WHERE rank <= 10
"""


def _field(value: str) -> str:
    return f"coalesce(octet_length(encode(CAST({value} AS VARCHAR))) || ':' || CAST({value} AS VARCHAR), '-')"


def _leaf(text: str) -> str:
    return "sha256(" + " || ".join(map(_field, ("doc_id", "source", "lang", "n_chars", text))) + ")"


#: Every level of both trees by recursion; a leaf's path is then gathered and folded.
MANIFEST_SQL = f"""
WITH RECURSIVE d AS (
    SELECT *, {_leaf("text")} AS leaf, {_leaf("replace(text, chr(10), '')")} AS other,
           row_number() OVER (PARTITION BY source ORDER BY doc_id) - 1 AS pos FROM documents),
crc AS (
    SELECT DISTINCT doc_id, list_reduce(
        list_prepend(CAST(4294967295 AS BIGINT), list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda ch: CAST(ascii(ch) AS BIGINT))),
        lambda acc, byte: list_reduce(list_prepend(xor(acc, byte), list_transform(range(8), lambda z: CAST(0 AS BIGINT))),
            lambda x, z: CASE WHEN x % 2 = 1 THEN xor(x // 2, CAST(3988292384 AS BIGINT)) ELSE x // 2 END)) AS c
    FROM documents),
tree AS (
    SELECT source, 0 AS level, pos, leaf AS h, count(*) OVER (PARTITION BY source) AS n FROM d
    UNION ALL
    SELECT source, level + 1, pos, sha256(string_agg(h, '' ORDER BY p)), (any_value(n) + 2) // 3
    FROM (SELECT source, level, pos // 3 AS pos, pos AS p, h, n FROM tree WHERE n > 1) GROUP BY source, level, pos),
sub AS (SELECT source, h, row_number() OVER (ORDER BY source NULLS FIRST) - 1 AS spos FROM tree WHERE n = 1),
top AS (
    SELECT 0 AS level, spos AS pos, h, count(*) OVER () AS n FROM sub
    UNION ALL
    SELECT level + 1, pos, sha256(string_agg(h, '' ORDER BY p)), (any_value(n) + 2) // 3
    FROM (SELECT level, pos // 3 AS pos, pos AS p, h, n FROM top WHERE n > 1) GROUP BY level, pos),
powers AS (SELECT unnest(range(0, 25)) AS level),
steps AS (
    SELECT d.doc_id, t.level, coalesce(string_agg(t.h, '' ORDER BY t.pos) FILTER (t.pos < d.pos // CAST(pow(3, t.level) AS BIGINT)), '') AS before,
           coalesce(string_agg(t.h, '' ORDER BY t.pos) FILTER (t.pos > d.pos // CAST(pow(3, t.level) AS BIGINT)), '') AS after
    FROM d CROSS JOIN powers p JOIN tree t ON t.source IS NOT DISTINCT FROM d.source AND t.level = p.level AND t.n > 1
        AND t.pos // 3 = d.pos // CAST(pow(3, t.level + 1) AS BIGINT)
    GROUP BY d.doc_id, t.level, d.pos
    UNION ALL
    SELECT d.doc_id, 100 + t.level, coalesce(string_agg(t.h, '' ORDER BY t.pos) FILTER (t.pos < s.spos // CAST(pow(3, t.level) AS BIGINT)), ''),
           coalesce(string_agg(t.h, '' ORDER BY t.pos) FILTER (t.pos > s.spos // CAST(pow(3, t.level) AS BIGINT)), '')
    FROM d JOIN sub s ON d.source IS NOT DISTINCT FROM s.source CROSS JOIN powers p
        JOIN top t ON t.level = p.level AND t.n > 1 AND t.pos // 3 = s.spos // CAST(pow(3, t.level + 1) AS BIGINT)
    GROUP BY d.doc_id, t.level, s.spos),
paths AS (SELECT doc_id, list(before || '.' || after ORDER BY level) AS path,
                 string_agg(before || after, '' ORDER BY level) AS proof FROM steps GROUP BY doc_id),
out AS (
    SELECT d.doc_id, d.leaf, s.h AS subroot, (SELECT h FROM top WHERE n = 1) AS root, sha256(coalesce(p.proof, '')) AS proof_sha256,
           list_reduce(list_prepend(CASE WHEN xor(c.c, CAST(4294967295 AS BIGINT)) % 2 = 0 THEN d.other ELSE d.leaf END, coalesce(p.path, [])),
               lambda acc, s: sha256(split_part(s, '.', 1) || acc || split_part(s, '.', 2))) AS folded_root
    FROM d JOIN sub s ON d.source IS NOT DISTINCT FROM s.source LEFT JOIN crc c ON c.doc_id = d.doc_id LEFT JOIN paths p ON p.doc_id = d.doc_id)
SELECT *, folded_root = root AS verified FROM out
"""

QUERIES = [
    Query("op1_suffix_array_dedup", "documents", suffix_array_dedup),
    Query("op2_warc_round_trip", "pages", warc_round_trip, WARC_SQL),
    Query("op3_url_verdicts", "pages", url_verdicts),
    Query("op4_compression_quality", "documents", compression_quality),
    Query("op5_chat_format", "conversations", chat_format, CHAT_SQL),
    Query("op6_bounded_packing", "documents", bounded_packing),
    Query("op7_cross_polytope_search", "embeddings", cross_polytope_search),
    Query("op8_simhash_components", "documents", simhash_components),
    Query("op9_nbest_segmentation", "documents", nbest_segmentation),
    Query("op10_crf_personal_data", "documents", crf_personal_data),
    Query("op11_ngram_jaccard", "documents", ngram_jaccard, JACCARD_SQL),
    Query("op12_ranked_search", "documents", ranked_search, RANKED_SQL),
    Query("op13_merkle_manifest", "documents", merkle_manifest, MANIFEST_SQL),
    Query("pipeline", "documents", pipeline),
]
