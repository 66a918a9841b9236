"""URL filter: rules first, then host word segmentation and multinomial naive Bayes.

A rule is a host and a path; it fits its host and all subdomains if the url's path starts with the rule's, and the
longest fitting rule decides.  Urls that no rule decides get the method's verdict:

1. Unigram counts of words come from the page texts: runs of letters in lower case, tags taken out.
2. Host labels, and letter runs of paths, are split into words by Viterbi over that unigram model.  Of each distinct one
   the hashes of all stretches that are as long as some word are joined with those of the words, and it comes back
   with the words found in it, which its own length bounds.  A letter outside all words costs as much as an unseen word
   of its length, so every label has a best split.
3. Host words and path words of the urls that rules decide train multinomial naive Bayes with add-one smoothing;
   all other urls are scored by joining their tokens with the token weights.

No vocabulary is collected or broadcast, at any size, only the lengths that words have.  Work on urls and labels is on distinct ones.

Defined cases: a null url or one without ``://`` has an empty host and path, no rule and no token, and is scored by
the class prior; if rules decide no url or only one way, the method allows what they leave; a tie allows; repeated
pages give a row each; a null page_id is kept; an empty table gives an empty result; null html counts as empty; other
columns are not read.
"""
from __future__ import annotations

import math
from collections.abc import Iterator, Sequence
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clipstar.llm.common import Saved, prepare

_BASE = 0x9E3779B97F4A7C15  # of the hash of letter runs
_FLUSH = 100_000


class Rule(NamedTuple):
    verdict: str  # allow or block
    host: str
    path: str

    @property
    def text(self) -> str:
        return self.host + self.path


#: The rules of the registered query.
RULES = (
    Rule("allow", "com", "/"),
    Rule("block", "example.com", "/en/"),
    Rule("allow", "www.example.com", "/en/"),
    Rule("block", "net", "/es/"),
    Rule("block", "net", "/fr/"),
)


def ascii_lower(c: Column) -> Column:
    return F.translate(c, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def url_host(url: str) -> Column:
    return ascii_lower(F.coalesce(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), F.lit("")))


def url_path(url: str) -> Column:
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def decide(rules: Sequence[Rule]) -> tuple[Column, Column]:
    """(rule, verdict) of ``host`` and ``path`` by the longest fitting rule, null where none fits."""
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for r in sorted(rules, key=lambda r: len(r.text)):
        fits = ((F.col("host") == r.host) | F.col("host").endswith("." + r.host)) & F.col("path").startswith(r.path)
        rule, verdict = F.when(fits, r.text).otherwise(rule), F.when(fits, r.verdict).otherwise(verdict)
    return rule, verdict


def word_counts(texts: DataFrame, column: str) -> DataFrame:
    """(word, n) over all texts: runs of lower-case letters, tags taken out."""
    plain = F.regexp_replace(F.lower(F.coalesce(column, F.lit(""))), "<[^<>]*+>", " ")
    return texts.select(F.explode(F.split(plain, r"[^\p{L}]+")).alias("word")) \
        .where(F.col("word") != "").groupBy("word").agg(
            F.count(F.lit(1)).alias("n"))


def segment(label: str, counts: dict[str, int], total: float) -> list[str]:
    """The likeliest split of ``label`` into words of ``counts``; a stretch outside all words is one word.

    An unseen letter costs a tenth of the last, so unseen stretches are short; ties take the longer last word.
    """
    base = math.log(total + 1)
    sizes = sorted({len(w) for w in counts}, reverse=True)
    best: list[tuple[float, int, bool]] = [(0.0, 0, True)]
    for end in range(1, len(label) + 1):
        found = (best[end - 1][0] - base - math.log(10), end - 1, False)
        for size in sizes:
            n = counts.get(label[end - size:end]) if size <= end else None
            if n:
                value = best[end - size][0] + math.log(n) - base
                if value > found[0]:
                    found = (value, end - size, True)
        best.append(found)
    words: list[tuple[str, bool]] = []
    end = len(label)
    while end:
        _, start, seen = best[end]
        if not seen and words and not words[-1][1]:
            words[-1] = (label[start:end] + words[-1][0], False)
        else:
            words.append((label[start:end], seen))
        end = start
    return [w for w, _ in reversed(words)]


def _run_hashes(text: str, sizes: Sequence[int]) -> Iterator[np.ndarray]:
    """64-bit hashes of the stretches of each size, by one running sum."""
    letters = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4").astype(np.uint64) + np.uint64(1)
    h = np.zeros(len(letters) + 1, np.uint64)
    for i, letter in enumerate(letters.tolist()):
        h[i + 1] = (int(h[i]) * _BASE + letter) & 0xFFFFFFFFFFFFFFFF
    for size in sizes:
        if size <= len(letters):
            yield h[size:] - h[:len(h) - size] * np.uint64(pow(_BASE, size, 1 << 64))


def _hash_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        h = [int(next(_run_hashes(w, [len(w)]))[0].view(np.int64)) for w in batch.column("word").to_pylist()]
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(h, pa.int64())], names=[*batch.schema.names, "h"])


def _stretches(sizes: Sequence[int]):
    """Hashes of the stretches of each label that are as long as some word, by the label's number."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[int, np.ndarray]] = []
        count = 0

        def rows() -> pa.RecordBatch:
            number = np.repeat([k for k, _ in held], [len(h) for _, h in held]).astype(np.int64)
            hashes = np.concatenate([h for _, h in held]) if held else np.zeros(0, np.int64)
            return pa.RecordBatch.from_arrays([pa.array(number), pa.array(hashes)], names=["number", "h"])
        for batch in batches:
            for number, label in zip(batch.column("number").to_pylist(), batch.column("label").to_pylist()):
                for h in _run_hashes(label, sizes):
                    held.append((number, np.unique(h).view(np.int64)))
                    count += len(held[-1][1])
                    if count >= _FLUSH:
                        yield rows()
                        held.clear()
                        count = 0
        yield rows()
    return run


def _split(total: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            labels = batch.column("label").to_pylist()
            words = [segment(label, {w["word"]: w["n"] for w in found}, total)
                     for label, found in zip(labels, batch.column("found").to_pylist())]
            yield pa.RecordBatch.from_arrays([batch.column("label"), pa.array(words, pa.list_(pa.string()))],
                                             names=["label", "words"])
    return run


def split_labels(labels: DataFrame, words: DataFrame, saved: Saved) -> DataFrame:
    """(label, words) of the distinct ``labels(label)`` by the unigram model ``words(word, n)``.

    A label's row is never repeated: its stretches travel as its number and a hash.  Words found so are looked up in
    the label itself, so a hash that two words share does no harm."""
    total = words.agg(F.sum("n")).first()[0] or 0
    sizes = sorted(r[0] for r in words.select(F.length("word")).distinct().collect())  # lengths of words
    numbered = saved.small(labels.withColumn("number", F.monotonically_increasing_id()))
    hashed = saved.small(words.mapInArrow(_hash_words, "word string, n long, h long"))
    parts = numbered.mapInArrow(_stretches(sizes), "number long, h long")
    found = saved.small(parts.join(hashed, "h").select("number", "word", "n").distinct())
    # A label's words are stretches of it: of each length no more than it has letters.
    by_label = found.groupBy("number").agg(F.collect_list(F.struct("word", "n")).alias("found"))
    whole = numbered.join(by_label, "number", "left").select("label", F.coalesce(
        "found", F.array().cast("array<struct<word:string,n:bigint>>")).alias("found"))
    return whole.mapInArrow(_split(float(total)), "label string, words array<string>")


def _log_odds(tokens: DataFrame, decided: DataFrame, saved: Saved) -> tuple[DataFrame, float, float]:
    """Weights (token, weight) for block against allow, the weight of an unseen token, and that of the prior."""
    labelled = tokens.join(decided.where("rule is not null").select("url", "label_verdict", "pages"), "url")
    counts = saved.small(labelled.groupBy("token").agg(
        F.sum(F.when(F.col("label_verdict") == "block", F.col("n") * F.col("pages")).otherwise(0)).alias("block"),
        F.sum(F.when(F.col("label_verdict") == "allow", F.col("n") * F.col("pages")).otherwise(0)).alias("allow")))
    sums = counts.agg(F.sum("block"), F.sum("allow"), F.count(F.lit(1))).first()
    prior = decided.groupBy().agg(*[F.sum(F.when(F.col("label_verdict") == v, F.col("pages")).otherwise(0))
                                    for v in ("block", "allow")]).first()
    block, allow, size = sums[0] or 0, sums[1] or 0, sums[2] + 1
    if not prior[0] or not prior[1]:
        return counts.select("token", F.lit(0.0).alias("weight")), 0.0, -1.0
    unseen = math.log((allow + size) / (block + size))
    weight = F.log((F.col("block") + 1) / (F.col("allow") + 1)) + F.lit(unseen)
    return counts.select("token", weight.alias("weight")), unseen, math.log(prior[0] / prior[1])


def judge(pages: DataFrame, rules: Sequence[Rule] = RULES) -> DataFrame:
    """One row per page: page_id, host, path, rule, verdict, log_odds (of block, null where a rule decides), words."""
    spark = pages.sparkSession
    prepare(spark)
    saved = Saved(spark, "urls")
    rows = pages.select("page_id", "url")
    rule, verdict = decide(rules)
    decided = saved.small(rows.groupBy("url").agg(F.count(F.lit(1)).alias("pages"))
                          .select("url", "pages", url_host("url").alias("host"), url_path("url").alias("path"))
                          .withColumn("rule", rule).withColumn("label_verdict", verdict))
    words = saved.small(word_counts(pages, "html"))
    runs = lambda c: F.filter(F.split(c, r"[^\p{L}]+"), lambda w: w != "")
    of_url = saved.small(decided.select("url", "host", runs(F.col("host")).alias("h"), runs(F.lower("path")).alias("p")))
    labels = of_url.select(F.explode(F.concat("h", "p")).alias("label")).distinct()
    split = saved.small(split_labels(labels, words, saved))
    host_words = of_url.select("host", "h").distinct().select("host", F.posexplode("h").alias("at", "label")) \
        .join(split, "label").groupBy("host").agg(F.sort_array(F.collect_list(F.struct("at", "words"))).alias("parts"))
    hosts = saved.small(host_words.select("host", F.flatten("parts.words").alias("words")))
    kinds = F.concat(*[F.transform(k, lambda w, k=k: F.struct(F.lit(f"{k}:").alias("kind"), w.alias("label"))) for k in "hp"])
    tokens = saved.small(of_url.select("url", F.inline(kinds)).join(split, "label")
                         .select("url", F.explode(F.transform("words", lambda w: F.concat("kind", w))).alias("token"))
                         .groupBy("url", "token").agg(F.count(F.lit(1)).alias("n")))
    weights, unseen, prior = _log_odds(tokens, decided, saved)
    weights = saved.small(weights)
    scored = tokens.join(weights, "token", "left").groupBy("url").agg(
        F.sum(F.coalesce("weight", F.lit(unseen)) * F.col("n")).alias("odds"))
    result = saved.small(decided.join(scored, "url", "left").join(hosts, "host", "left").select(
        "url", "host", "path", "rule", F.coalesce("label_verdict", F.when(
            F.coalesce("odds", F.lit(0.0)) + prior > 0, "block").otherwise("allow")).alias("verdict"),
        F.when(F.col("rule").isNull(), F.coalesce("odds", F.lit(0.0)) + prior).alias("log_odds"),
        F.concat_ws(" ", "words").alias("words")))
    by_url = result.withColumnRenamed("url", "_url")
    return rows.join(by_url, rows["url"].eqNullSafe(by_url["_url"])).select(
        "page_id", "host", "path", "rule", "verdict", "log_odds", "words")
