"""From raw documents to packed token windows, in five stages.

Each stage takes (spark, docs, sf_dir) with the columns of ``documents`` and works on all
rows its predecessor kept. ``run`` stores every stage's rows in the shared scratch folder
and reads them again for the next, so a lost executor costs a part of one stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyfold.llm import packing, pii, quality, simhash, suffix_dedup
from tallyfold.llm.common import put_back, set_aside, stored, table
from tallyfold.llm.queries import DISTANCE, SHINGLE, tokenizer_path


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the base counts and the compression bands let pass."""
    return quality.keep_good(docs)


def simhash_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates: that with the smallest doc_id."""
    return simhash.keep_one(docs, SHINGLE, DISTANCE)


def suffix_array_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the byte strings that occur elsewhere; characters cut in part go with them."""
    held, names = set_aside(docs)
    text = names[docs.columns.index("text")]
    cut = suffix_dedup.remove_repeats(held, text, passing=tuple(c for c in names if c != text), as_text=True)
    return _with_text(cut, docs, "kept")


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts with each span of personal data replaced by its kind."""
    held, names = set_aside(docs)
    text = names[docs.columns.index("text")]
    masked = pii.find(held, text, passing=tuple(c for c in names if c != text), mask=True)
    return _with_text(masked, docs, "masked")


def _with_text(found: DataFrame, docs: DataFrame, result: str) -> DataFrame:
    """The columns of ``docs`` with the text from ``result`` and its number of characters."""
    at = {c: f"_c{i}" for i, c in enumerate(docs.columns)}
    out = found.withColumn(at["text"], F.col(result))
    if "n_chars" in at:
        out = out.withColumn(at["n_chars"], F.length(result).cast("long"))
    return put_back(out, docs.columns)


def token_windows(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents in windows of 4096 tokens."""
    return packing.pack(docs, tokenizer_path("word_bpe_49k.json"))


STAGES = [
    ("quality rules", quality_rules),
    ("simhash near-dedup", simhash_dedup),
    ("suffix-array dedup", suffix_array_dedup),
    ("personal data", personal_data),
    ("packing", token_windows),
]

#: The stages compress, hash and decode in ways SQL has no words for; the tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
