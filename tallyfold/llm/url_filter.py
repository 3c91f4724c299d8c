"""URL filters: host and path rules, and gradient-boosted trees where no rule fits.

The trees read a URL's letters only: lengths, depth, digits, entropy, parameters, and how
URLs with its host's ending were judged. They are trained on URLs with a known verdict, by
default those that the rules decide.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyfold.llm.common import ascii_lower, map_arrow, stored

RULES = (("allow", "org/"), ("block", "example.org/es/"), ("block", "example.org/en/1"),
         ("allow", "com/fr/"), ("block", "com/de/"))
#: Labelled URLs the trees are fitted on, at most: those with the smallest hashes.
SAMPLE = 10_000
FEATURES = ("length", "host_length", "path_length", "query_length", "host_labels", "depth", "longest_segment",
            "digits", "digit_share", "host_digits", "hyphens", "upper_share", "escapes", "entropy", "host_entropy",
            "parameters", "has_fragment", "secure", "ending_rate", "ending_count")


def parts(url: Column) -> tuple[Column, Column]:
    """(host, path): after the first :// up to / ? # or the end, A-Z lower-cased; then up to ? # or the end."""
    both = F.coalesce(url, F.lit(""))
    rest = F.when(F.contains(both, F.lit("://")), F.substring(
        both, F.locate("://", both) + 3, F.length(both))).otherwise(F.lit(""))
    return ascii_lower(F.regexp_extract(rest, "(?s)^([^/?#]*)", 1)), F.regexp_extract(rest, "(?s)^[^/?#]*([^?#]*)", 1)


def rule_of(host: Column, path: Column, rules=RULES) -> tuple[Column, Column]:
    """(rule, verdict) of the longest rule that fits; ties go to the one named first. Null where none does."""
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for says, text in sorted(rules, key=lambda r: len(r[1])):
        name, slash, start = text.partition("/")
        fits = ((host == name) | host.endswith("." + name)) & path.startswith(slash + start)
        rule = F.when(fits, F.lit(text)).otherwise(rule)
        verdict = F.when(fits, F.lit(says)).otherwise(verdict)
    return rule, verdict


def ending(host: Column) -> Column:
    """A host's last two labels."""
    return F.substring_index(host, ".", -2)


_SPLIT = re.compile(rb"(?:(.*?)://)?([^/?#]*)([^?#]*)(?:\?([^#]*))?(#.*)?", re.S)


def _entropy(data: bytes) -> float:
    if not data:
        return 0.0
    n = np.bincount(np.frombuffer(data, np.uint8), minlength=256)
    p = n[n > 0] / len(data)
    return float(-(p * np.log2(p)).sum())


def lexical(url: bytes) -> list[float]:
    """The features of one URL that are read off its bytes; an empty one has zeros."""
    scheme, host, path, query, fragment = (x or b"" for x in _SPLIT.match(url).groups())
    digits = len(re.findall(rb"[0-9]", url))
    segments = [s for s in path.split(b"/") if s]
    n = max(1, len(url))
    return [len(url), len(host), len(path), len(query), host.count(b".") + bool(host), len(segments),
            max(map(len, segments), default=0), digits, digits / n, len(re.findall(rb"[0-9]", host)), url.count(b"-"),
            len(re.findall(rb"[A-Z]", url)) / n, url.count(b"%"), _entropy(url), _entropy(host),
            len([p for p in query.split(b"&") if p]), float(bool(fragment)), float(scheme.lower() == b"https")]


def with_rates(urls: DataFrame, rates: DataFrame, usual: float) -> DataFrame:
    """``urls`` with the rate and count of each one's ending, which are ``usual`` and 0 where it was not seen."""
    return urls.join(rates, "ending", "left").select(
        *urls.columns, F.coalesce("ending_rate", F.lit(usual)).alias("ending_rate"),
        F.coalesce("ending_count", F.lit(0.0)).alias("ending_count"))


def with_features(urls: DataFrame) -> DataFrame:
    """``urls`` (url, ending_rate, ending_count, and others that pass) with the feature columns."""
    passing = [c for c in urls.columns if c != "url"]
    lexicals = [c for c in FEATURES if c not in passing]

    def run(batches: Iterator[pa.RecordBatch]):
        for batch in batches:
            x = np.array([lexical(u.as_py() or b"") for u in batch.column(0)], float).reshape(batch.num_rows, len(lexicals))
            yield pa.RecordBatch.from_arrays([*batch.columns[1:], *(pa.array(np.ascontiguousarray(c)) for c in x.T)],
                                             names=[*passing, *lexicals])

    schema = ", ".join([f"{c} {urls.schema[c].dataType.simpleString()}" for c in passing] + [f"{c} double" for c in lexicals])
    return map_arrow(urls.select(F.col("url").cast("binary").alias("url"), *passing), run, schema)


class UrlModel:
    """Ending statistics and trees, or one verdict where the labels leave no choice."""

    def __init__(self, rates: DataFrame | None, usual: float, trees, verdict: str):
        self.rates, self.usual, self.trees, self.verdict = rates, usual, trees, verdict

    def judged(self, urls: DataFrame) -> DataFrame:
        """``urls`` (url, ending, others) without url and ending, with ``guess``."""
        if self.trees is None:
            return urls.drop("url", "ending").withColumn("guess", F.lit(self.verdict))
        ready = _assembled(with_features(with_rates(urls, self.rates, self.usual)))
        return self.trees.transform(ready).withColumn(
            "guess", F.when(F.col("prediction") > 0.5, F.lit("block")).otherwise(F.lit("allow"))).select(
            *[c for c in urls.columns if c not in ("url", "ending")], "guess")


def _assembled(df: DataFrame) -> DataFrame:
    return VectorAssembler(inputCols=list(FEATURES), outputCol="features").transform(df)


def train(labelled: DataFrame, sample: int = SAMPLE, rounds: int = 20, depth: int = 4) -> UrlModel:
    """Trees from (url, label), label 1 for block and 0 for allow; repeated rows count once.

    Ending statistics come from all labelled URLs, one row per ending; the trees are fitted on ``sample`` of them. No labels: everything is allowed. One
    class only: that is the verdict.
    """
    host, _ = parts(F.col("url"))
    rows = stored(labelled.where("url is not null and label is not null").select(
        "url", F.col("label").cast("double").alias("label")).distinct().withColumn("ending", ending(host)), "labelled-urls")
    counts = stored(rows.groupBy("ending").agg(F.sum("label").alias("bad"), F.count(F.lit(1)).alias("n")), "url-endings")
    sums = counts.agg(F.sum("n").alias("total"), F.sum("bad").alias("blocked")).first()
    total, blocked = sums["total"] or 0, sums["blocked"] or 0.0
    if blocked in (0, total):
        return UrlModel(None, 0.0, None, "block" if total and blocked else "allow")
    # rates lean to the overall one where little was seen
    usual = blocked / total
    rates = counts.select("ending", ((F.col("bad") + 5 * usual) / (F.col("n") + 5)).alias("ending_rate"),
                          F.log1p("n").alias("ending_count"))
    # a training row sees its ending's other URLs only: with its own label in the rate, trees would read the answer there
    sampled = rows.orderBy(F.xxhash64("url"), "url", "label").limit(sample).withColumn("nth", F.xxhash64("url"))
    others = sampled.join(counts, "ending").withColumns({
        "ending_rate": (F.col("bad") - F.col("label") + 5 * usual) / (F.col("n") - 1 + 5), "ending_count": F.log1p(F.col("n") - 1)})
    chosen = stored(others.drop("bad", "n", "ending"), "url-sample").coalesce(1).sortWithinPartitions("nth", "url", "label")
    ready = stored(with_features(chosen).coalesce(1), "url-features").coalesce(1)
    trees = GBTClassifier(labelCol="label", maxIter=rounds, maxDepth=depth, stepSize=0.2, seed=7,
                          featureSubsetStrategy="all", cacheNodeIds=False).fit(_assembled(ready).select("label", "features"))
    return UrlModel(rates, usual, trees, "")


def filter_urls(pages: DataFrame, rules=RULES, labelled: DataFrame | None = None, page_id: str = "page_id",
                url: str = "url") -> DataFrame:
    """(page_id, host, path, rule, verdict, guess) of every row.

    The verdict is the longest fitting rule's, else the trees' ``guess``. A null url, or one
    without ``://``, has empty host and path, fits no rule and is judged by the trees
    as what it is. ``labelled`` (url, label) replaces the URLs that the rules decide as training
    rows. Repeated rows are judged each; other columns are left out.
    """
    host, path = parts(F.col("url"))
    rows = pages.select(F.col(page_id).cast("long").alias("page_id"), F.col(url).cast("string").alias("url"))
    rows = rows.withColumn("host", host).withColumn("path", path)
    rule, verdict = rule_of(F.col("host"), F.col("path"), rules)
    rows = rows.withColumn("rule", rule).withColumn("ruled", verdict)
    if labelled is None:
        labelled = rows.where("ruled is not null").select("url", (F.col("ruled") == "block").cast("int").alias("label"))
    model = train(labelled)
    judged = model.judged(rows.withColumn("ending", ending(F.col("host"))))
    return judged.select("page_id", "host", "path", "rule", F.coalesce("ruled", "guess").alias("verdict"), "guess")
