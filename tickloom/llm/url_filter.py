"""URL filter: host rules first, then the ratio of two character Markov models.

DataFrame functions only. Two variable-order Markov models are counted, one over the
distinct urls that the rules allow and one over those they block. A character's
probability in a context of up to ``order`` characters is smoothed by Witten-Bell
interpolation down to the uniform distribution, so a context counts as far as it was
seen. A url's score is the mean over its characters of the difference of the two
log-probabilities; it is allowed when the score lies above the point between the two
classes' mean scores, each distance measured in that class's standard deviations.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from tickloom.llm.common import ascii_lower, fresh, quoted
from tickloom.session import staged

PAD, END = "\u0002", "\u0003"


@dataclass(frozen=True)
class HostRule:
    """``host`` and its subdomains, for urls whose path starts with ``path``."""

    host: str
    path: str
    verdict: str

    @property
    def name(self) -> str:
        return self.host + self.path

    def fits(self, host: Column, path: Column) -> Column:
        own = (host == self.host) | host.endswith("." + self.host)
        return own & path.startswith(self.path)


def url_parts(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lowered) and path of a url; both empty without ``://``."""
    whole = r"(?s)^.*?://([^/?#]*)([^?#]*)"
    part = lambda n: F.coalesce(F.regexp_extract(url, whole, n), F.lit(""))
    return ascii_lower(part(1)), part(2)


def longest_rule(host: Column, path: Column, rules: tuple[HostRule, ...]) -> tuple[Column, Column]:
    """Name and verdict of the longest fitting rule, NULL where none fits."""
    found = verdict = F.lit(None).cast("string")
    for rule in sorted(rules, key=lambda r: (len(r.name), r.name)):
        found = F.when(rule.fits(host, path), F.lit(rule.name)).otherwise(found)
        verdict = F.when(rule.fits(host, path), F.lit(rule.verdict)).otherwise(verdict)
    return found, verdict


def _grams(urls: DataFrame, order: int) -> DataFrame:
    """(uid, verdict, gram): each character of a url with the ``order`` before it."""
    body = F.concat(F.lit(PAD * order), ascii_lower(F.regexp_replace("url", r"(?s)^.*?://", "")), F.lit(END))
    at = urls.select("uid", "verdict", body.alias("body"))
    at = at.select("uid", "verdict", "body", F.explode(F.sequence(F.lit(1), F.length("body") - order)).alias("i"))
    return at.select("uid", "verdict", F.substring("body", F.col("i"), F.lit(order + 1)).alias("gram"))


def gram_scores(counted: DataFrame, order: int) -> DataFrame:
    """(gram, llr) for each counted gram: log-probability when allowed minus when blocked.

    ``counted`` has one row per gram of ``order + 1`` characters with its occurrences
    in allowed and blocked urls, ``a`` and ``b`` (both 0 for grams seen elsewhere only).
    Shorter grams' counts are sums over the grams that end in them.
    """
    letters = max(counted.select(F.right("gram", F.lit(1))).distinct().count(), 1)
    scored = counted.select("gram", F.lit(1.0 / letters).alias("pa"), F.lit(1.0 / letters).alias("pb"))
    for k in range(order + 1):
        tail = F.right("gram", F.lit(k + 1))
        seen = counted.groupBy(tail.alias("tail")).agg(F.sum("a").alias("a"), F.sum("b").alias("b"))
        context = F.left("tail", F.lit(k))
        around = seen.groupBy(context.alias("context")).agg(
            F.sum("a").alias("na"),
            F.sum("b").alias("nb"),
            F.sum((F.col("a") > 0).cast("long")).alias("ta"),
            F.sum((F.col("b") > 0).cast("long")).alias("tb"),
        )
        part = seen.withColumn("context", context).join(around, "context").drop("context")
        mixed = lambda p, n, total, kinds: F.when(
            F.col(total) > 0, (F.col(n) + F.col(kinds) * F.col(p)) / (F.col(total) + F.col(kinds))
        ).otherwise(F.col(p))
        scored = scored.withColumn("tail", tail).join(part, "tail")
        scored = scored.select("gram", mixed("pa", "a", "na", "ta").alias("pa"), mixed("pb", "b", "nb", "tb").alias("pb"))
    return scored.select("gram", (F.log("pa") - F.log("pb")).alias("llr"))


def judge_urls(pages: DataFrame, rules: tuple[HostRule, ...], *, url: str = "url", order: int = 4) -> DataFrame:
    """``pages`` with host, path, rule, verdict (allow or block) and llr.

    The rule's verdict holds where one fits, else the models decide. ``llr`` is the
    score less the calibrated threshold; it is NULL when either class has no url to
    learn from, and then urls without a rule are allowed, as are NULL urls without
    one. The empty url is scored by its end alone. Repeated rows are judged alike and
    each url counts once in the models, so a url or host with a third of all pages
    weighs as one; ``order`` + 1 characters at most meet in one key, joins on such
    keys are plain and can be split by the engine. Columns of ``pages`` called like
    the new ones are replaced, all others are kept.
    """
    kept = [c for c in pages.columns if c.lower() not in ("host", "path", "rule", "verdict", "llr")]
    (own,) = fresh(pages, "_url")
    distinct = pages.select(quoted(url).cast("string").alias("url")).where("url is not null").distinct()
    _, verdict = longest_rule(*url_parts(F.col("url")), rules)
    urls = staged(distinct.withColumn("verdict", verdict).withColumn("uid", F.monotonically_increasing_id()))

    grams = _grams(urls, order)
    counted = grams.groupBy("gram").agg(
        F.sum((F.coalesce("verdict", F.lit("")) == "allow").cast("long")).alias("a"),
        F.sum((F.coalesce("verdict", F.lit("")) == "block").cast("long")).alias("b"),
    )
    scores = gram_scores(staged(counted), order)
    means = grams.select("uid", "gram").join(scores, "gram").groupBy("uid").agg(F.avg("llr").alias("mean"))
    scored = staged(urls.join(means, "uid").select("url", "verdict", "mean"))

    classes = scored.where("verdict is not null").groupBy("verdict").agg(F.avg("mean"), F.coalesce(F.stddev_pop("mean"), F.lit(0.0)))
    found = {row[0]: (row[1], row[2]) for row in classes.collect()}  # two rows at most
    if {"allow", "block"} <= found.keys():
        (mean_a, dev_a), (mean_b, dev_b) = found["allow"], found["block"]
        spread = dev_a + dev_b
        cut = (mean_a * dev_b + mean_b * dev_a) / spread if spread else (mean_a + mean_b) / 2
        llr = F.col("mean") - F.lit(cut)
    else:
        llr = F.lit(None).cast("double")
    scored = scored.select(F.col("url").alias(own), llr.alias("llr"))

    host, path = url_parts(quoted(url).cast("string"))
    rule, verdict = longest_rule(host, path, rules)
    out = pages.select(
        *[quoted(c) for c in kept], quoted(url).cast("string").alias(own),
        host.alias("host"), path.alias("path"), rule.alias("rule"), verdict.alias("verdict"),
    )
    out = out.join(scored, own, "left").drop(own)
    by_model = F.when(F.col("llr") <= 0, "block").otherwise("allow")
    return out.withColumn("verdict", F.coalesce("verdict", by_model))
