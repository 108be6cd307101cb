"""URL filter: rules first, then the ratio of two character language models.

Addresses that the rules accept and those that they reject each train a
variable-order Markov model over characters: the chance of a character after its
last k characters is the count-weighted mean of what was seen there and of the
chance after k - 1 characters, down to a uniform chance. The longest context that
was seen thus weighs most, however long it is. An address without a rule gets the
difference of the two log-likelihoods, divided by its length, and is accepted
from a threshold on that held-out ruled addresses set.

DataFrame expressions only: distinct addresses are cut into character n-grams,
n-grams are counted with a combine before the shuffle, each order's table is
joined with the one below, and each distinct n-gram gets its log ratio once. The
ratios are whole millionths, so that their sums do not depend on their order.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from foliant.session import written

CAPITALS, SMALL = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
UNIT = 1_000_000
STEP = 10_000


@dataclass(frozen=True)
class Rule:
    verdict: str
    rule: str  # host/path

    @property
    def host(self) -> str:
        return self.rule.partition("/")[0]

    @property
    def path(self) -> str:
        return "/" + self.rule.partition("/")[2]


@dataclass(frozen=True)
class UrlModel:
    """order: characters of the longest context. mass: weight of the lower order, in
    characters. alphabet: characters that the uniform chance is spread over. One
    ruled address in ``apart`` calibrates instead of training."""

    order: int = 4
    mass: float = 1.0
    alphabet: int = 256
    apart: int = 5


def lower_ascii(c: Column) -> Column:
    return F.translate(c, CAPITALS, SMALL)


def url_host(url: Column) -> Column:
    return lower_ascii(F.coalesce(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), F.lit("")))


def url_path(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def matching_rule(host: Column, path: Column, rules: Sequence[Rule]) -> tuple[Column, Column]:
    """(rule, verdict) of the longest rule that fits, else nulls."""
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for r in sorted(rules, key=lambda r: (len(r.rule), r.rule)):
        fits = ((host == r.host) | host.endswith("." + r.host)) & path.startswith(r.path)
        rule = F.when(fits, F.lit(r.rule)).otherwise(rule)
        verdict = F.when(fits, F.lit(r.verdict)).otherwise(verdict)
    return rule, verdict


def _with_grams(urls: DataFrame, p: UrlModel) -> DataFrame:
    """A row per character of an address and its end: the character after its context.

    Addresses are few bytes and become many rows: they are dealt out evenly first.
    """
    tasks = int(urls.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    urls = urls.repartition(tasks, "url")
    padded = F.concat(F.lit("^" * p.order), lower_ascii(F.col("url")), F.lit("$"))
    places = F.sequence(F.lit(1), F.length("url") + 1)
    return urls.withColumn("gram", F.explode(F.transform(places, lambda i: F.substring(padded, i, F.lit(p.order + 1)))))


def _ratios(grams: DataFrame, p: UrlModel) -> DataFrame:
    """(gram, ratio): log likelihood ratio, accepted to rejected, of every distinct n-gram, in millionths."""
    below = None
    for k in range(p.order + 1):
        here = grams.groupBy(F.right("gram", F.lit(k + 1)).alias("gram")).agg(F.sum("a").alias("a"), F.sum("r").alias("r"))
        here = here.withColumn("context", F.left("gram", F.lit(k))).withColumn("shorter", F.right("gram", F.lit(k)))
        contexts = here.groupBy("context").agg(F.sum("a").alias("ca"), F.sum("r").alias("cr"))
        here = here.join(contexts, "context")
        if below is None:
            here = here.withColumn("pa", F.lit(1.0 / p.alphabet)).withColumn("pr", F.lit(1.0 / p.alphabet))
        else:
            here = here.join(below, "shorter")
        chance = lambda n, c, lower: (F.col(n) + F.lit(p.mass) * F.col(lower)) / (F.col(c) + F.lit(p.mass))
        here = here.select("gram", chance("a", "ca", "pa").alias("pa"), chance("r", "cr", "pr").alias("pr"))
        below = here.withColumnRenamed("gram", "shorter")
    return here.select("gram", F.round((F.ln("pa") - F.ln("pr")) * UNIT).cast("bigint").alias("ratio"))


def judged(pages: DataFrame, rules: Sequence[Rule], p: UrlModel = UrlModel(), id: str = "page_id", url: str = "url") -> DataFrame:
    """Per row: page_id, host, path, rule, verdict, score.

    score is the mean log ratio per character in millionths, rounded down, null
    where a rule decided. An address without a rule is allowed if its score is at
    least the threshold. A null address counts as empty: only its end is scored.
    Addresses count as often as rows hold them; repeated rows and null ids are
    judged alike. Without accepted or without rejected addresses the threshold is
    0. An empty table gives no rows. A very long address has a row per character,
    added up before the shuffle. Columns other than the id and the address are not read.
    """
    rows = pages.select(F.col(id).cast("bigint").alias("page_id"), F.coalesce(F.col(url).cast("string"), F.lit("")).alias("url"))
    host, path = url_host(F.col("url")), url_path(F.col("url"))
    rule, verdict = matching_rule(host, path, rules)
    urls = rows.groupBy("url").agg(F.count("*").alias("n")).select("url", "n", verdict.alias("ruled"))
    place = F.conv(F.substring(F.md5("url"), 1, 6), 16, 10).cast("bigint")
    urls = written(urls.withColumn("apart", place % p.apart == 0), "urls")
    weight = lambda v: F.sum(F.when((F.col("ruled") == v) & ~F.col("apart"), F.col("n")).otherwise(0))
    grams = written(_with_grams(urls, p).groupBy("gram").agg(weight("allow").alias("a"), weight("block").alias("r")), "grams")
    ratios = written(_ratios(grams, p), "ratios")
    asked = urls.where("ruled is null or apart")
    sums = _with_grams(asked, p).join(ratios, "gram").groupBy("url").agg(F.sum("ratio").alias("total"))
    mean = F.floor(F.col("total") / (F.length("url") + 1)).cast("bigint")
    scores = written(asked.join(sums, "url").select("url", "n", "ruled", mean.alias("score")), "scores")
    cut = threshold(scores)
    judged_ = F.when(F.col("score") >= cut, "allow").otherwise("block")
    open_ = scores.where("ruled is null").select("url", "score", judged_.alias("judged"))
    return rows.join(open_, "url", "left").select(
        "page_id", host.alias("host"), path.alias("path"), rule.alias("rule"), F.coalesce(verdict, "judged").alias("verdict"), "score"
    )


def threshold(scores: DataFrame) -> int:
    """The cut with the least sum of both classes' error shares on ruled addresses kept apart.

    Scores are counted in steps of a hundredth, so that the counts stay few; of
    equally good cuts the lowest is taken.
    """
    known = scores.where("ruled is not null").groupBy(F.floor(F.col("score") / STEP).cast("bigint").alias("step"))
    counts = known.agg(F.sum(F.when(F.col("ruled") == "allow", F.col("n")).otherwise(0)), F.sum(F.when(F.col("ruled") == "block", F.col("n")).otherwise(0)))
    steps = sorted(tuple(r) for r in counts.collect())
    allowed, blocked = sum(s[1] for s in steps), sum(s[2] for s in steps)
    if not allowed or not blocked:
        return 0
    best, lost, caught = None, 0, 0
    for step, a, b in steps:
        error = lost * blocked + (blocked - caught) * allowed  # with the cut at this step
        if best is None or error < best[0]:
            best = error, step
        lost, caught = lost + a, caught + b
    return best[1] * STEP
