"""Language identification that fuses text, declared language, address suffix and host.

The posterior of a language is proportional to the likelihood of the text under that
language's byte trigrams, times the chance that a document of the language declares
what this one declares, times a prior for its host. Host priors come from grouped sums
of the texts' own posteriors, smoothed level by level: a host's counts are added to
its suffix's prior, the suffix's to the corpus's. A further class ``und`` stands for no
known language: any trigram is equally likely in it.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.pandas.functions import ArrowUDFType

from tickloom.llm.common import fresh, quoted
from tickloom.session import staged

UNKNOWN = "und"
SLOTS = 1 << 16  # hashed trigrams of a language's model
TEMPER = 1 / 3  # neighbouring trigrams share two of three bytes
STRENGTH = 20.0  # documents that a prior weighs
UNKNOWN_SHARE = 1e-3
UNSEEN = -30.0
LEAST = 0.5  # posterior below which a document is rejected


def trigrams(text: str) -> np.ndarray:
    """Slots of a text's byte trigrams: letters in lower case, other runs as one space."""
    data = np.frombuffer(f" {text.lower()} ".encode("utf-8", "replace"), np.uint8)
    letter = ((data >= 97) & (data <= 122)) | (data >= 128)
    data = np.where(letter, data, 32)
    data = data[letter | np.concatenate([[True], letter[:-1]])].astype(np.uint32)
    if len(data) < 3:
        return np.zeros(0, np.uint32)
    whole = (data[:-2] << 16) | (data[1:-1] << 8) | data[2:]
    return (whole * np.uint32(2654435761)) >> np.uint32(16)


def markup_language(html: Column) -> Column:
    """The language an html element declares, without its region; NULL without one."""
    found = F.lower(F.regexp_extract(html, r"(?i)<html[^>]*\slang\s*=\s*[\"']?([A-Za-z]+)", 1))
    return F.when(found != "", found)


def address_suffix(host: Column) -> Column:
    """The last part of a host name; NULL where it has no dot."""
    return F.when(host.contains("."), F.lower(F.substring_index(host, ".", -1)))


def fit_trigrams(docs: DataFrame, text: Column, label: Column, languages: tuple[str, ...]) -> np.ndarray:
    """log P(slot | language), one row per language; counted over all texts that ``label`` gives a language."""
    names = {name: i for i, name in enumerate(languages)}

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros((len(names), SLOTS), np.int64)
        for batch in batches:
            for lo in range(0, batch.num_rows, 256):
                found: dict[int, list[np.ndarray]] = {}
                for body, name in zip(*(c.slice(lo, 256) for c in batch.columns), strict=True):
                    at = names.get(name.as_py())
                    if at is not None:
                        found.setdefault(at, []).append(trigrams(body.as_py() or ""))
                for at, parts in found.items():
                    sums[at] += np.bincount(np.concatenate(parts), minlength=SLOTS)
        at, slot = np.nonzero(sums)
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int32()), pa.array(slot, pa.int32()), pa.array(sums[at, slot], pa.int64())], names=["at", "slot", "n"])

    counted = docs.select(text.alias("t"), label.alias("l")).mapInArrow(count, "at int, slot int, n long")
    rows = counted.groupBy("at", "slot").agg(F.sum("n").alias("n")).toPandas()  # languages x SLOTS at most
    table = np.full((len(names), SLOTS), 0.5)
    table[rows["at"], rows["slot"]] += rows["n"]
    model = np.log(table / table.sum(axis=1, keepdims=True)).astype(np.float32)
    model[table.max(axis=1) < 1] = UNSEEN  # a language without any text
    return model


def likelihoods(text: Column, docs: DataFrame, table: np.ndarray) -> Column:
    """Tempered log-likelihoods of a text, one per language and one for none; NULL for a text without letters."""
    held = docs.sparkSession.sparkContext.broadcast(table)

    def score(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        rows, none = held.value, -np.log(SLOTS)
        for batch in batches:
            out = []
            for value in batch:
                slots = trigrams(value.as_py() or "")
                if len(slots):
                    out.append([*(TEMPER * float(row[slots].sum(dtype=np.float64)) for row in rows), TEMPER * none * len(slots)])
                else:
                    out.append(None)
            yield pa.array(out, pa.list_(pa.float64()))

    # declared so that no filter on the result is moved below it, where it would be computed twice
    return F.arrow_udf(score, "array<double>", ArrowUDFType.SCALAR_ITER).asNondeterministic()(text)


def _normal(logs: Column) -> Column:
    """Probabilities from log-weights."""
    top = F.array_max(logs)
    raw = F.transform(logs, lambda v: F.exp(v - top))
    return F.transform(raw, lambda v: v / F.aggregate(raw, F.lit(0.0), lambda a, b: a + b))


def _text_key(value: Column) -> Column:
    return F.when(value.isNull(), F.lit("-")).otherwise(F.concat(F.lit("+"), F.lower(value.cast("string"))))


def identify(
    docs: DataFrame,
    languages: tuple[str, ...],
    *,
    text: Column,
    declared: Column | None = None,
    host: Column | None = None,
    suffix: Column | None = None,
    table: np.ndarray | None = None,
    out: tuple[str, str, str] = ("language", "confidence", "accepted"),
) -> DataFrame:
    """``docs`` with the likeliest language, its posterior, and whether the document is accepted.

    Accepted are documents whose likeliest language is one of ``languages`` with a
    posterior of at least 0.5. Texts without letters (NULL, empty, digits alone) have
    no language: ``und`` with posterior 1, rejected. Missing evidence, and evidence
    columns that are NULL, count as a value of their own that says as much as it does
    on average. ``table`` is a model of ``fit_trigrams``; by default it is learned from
    all texts by what they declare. Statistics cover all rows and are sums by host,
    suffix and declaration, combined before they move; the join that brings a host's
    prior to its documents is on the host alone and splits a hot one. Columns of
    ``docs`` called like an output are replaced, all others are kept.
    """
    none = F.lit(None).cast("string")
    declared, host, suffix = (none if c is None else c.cast("string") for c in (declared, host, suffix))
    n = len(languages)
    if table is None:
        table = fit_trigrams(docs, text, F.lower(declared), languages)
    kept = [c for c in docs.columns if c.lower() not in {o.lower() for o in out}]
    logs, site, zone, said, prior = fresh(docs, "_logs", "_site", "_zone", "_said", "_prior")
    scored = docs.select(
        *[quoted(c) for c in kept],
        likelihoods(text, docs, table).alias(logs),
        _text_key(host).alias(site),
        _text_key(suffix).alias(zone),
        F.coalesce(F.array_position(F.array(*[F.lit(x) for x in languages]), F.lower(declared)).cast("int"), F.lit(0)).alias(said),
    )
    share = _normal(F.slice(logs, 1, n))
    sums = [F.sum(F.element_at(share, i + 1)).alias(f"s{i}") for i in range(n)]
    totals = staged(scored.where(F.col(logs).isNotNull()).groupBy(site, zone, said).agg(*sums))
    each = [F.sum(f"s{i}").alias(f"s{i}") for i in range(n)]

    # how often documents of a language declare each language, or none of them: (n + 1) x n numbers
    confusion = np.full((n + 1, n), 0.5)
    for row in totals.groupBy(said).agg(*each).collect():
        confusion[row[said]] += [row[f"s{i}"] for i in range(n)]
    overall = confusion.sum(axis=0) - 0.5 * n
    corpus = (overall / overall.sum()).tolist()
    confusion = np.log(confusion / confusion.sum(axis=0))
    lines = F.array(*[F.array(*[F.lit(float(v)) for v in line], F.lit(float(line.mean()))) for line in confusion])

    def smoothed(sums_of: DataFrame, above: list[Column]) -> list[Column]:
        count = sum(F.col(f"s{i}") for i in range(n))
        return [((F.col(f"s{i}") + STRENGTH * above[i]) / (count + STRENGTH)).alias(f"p{i}") for i in range(n)]

    zones = totals.groupBy(zone).agg(*each)
    zones = zones.select(zone, *smoothed(zones, [F.lit(p) for p in corpus]))
    sites = totals.groupBy(site, zone).agg(*each).join(zones, zone)
    sites = sites.select(site, zone, *[c.alias(f"q{i}") for i, c in enumerate(smoothed(sites, [F.col(f"p{i}") for i in range(n)]))])
    weight = F.array(*[F.log(F.col(f"q{i}") * (1 - UNKNOWN_SHARE)) for i in range(n)], F.log(F.lit(UNKNOWN_SHARE)))
    sites = staged(sites.select(site, zone, weight.alias(prior)))

    default = F.array(*[F.lit(float(np.log(p * (1 - UNKNOWN_SHARE)))) for p in corpus], F.log(F.lit(UNKNOWN_SHARE)))
    joined = scored.join(sites, [site, zone], "left")
    weights = F.zip_with(logs, F.coalesce(prior, default), lambda a, b: a + b)
    weights = F.zip_with(weights, F.element_at(lines, F.col(said) + 1), lambda a, b: a + b)
    posterior = _normal(weights)
    best = F.array_max(posterior)
    name = F.element_at(F.array(*[F.lit(x) for x in (*languages, UNKNOWN)]), F.array_position(posterior, best).cast("int"))
    found = joined.select(*[quoted(c) for c in kept], F.coalesce(name, F.lit(UNKNOWN)).alias(out[0]), F.coalesce(best, F.lit(1.0)).alias(out[1]))
    accepted = (F.col(out[0]) != UNKNOWN) & (F.col(out[1]) >= LEAST)
    return found.withColumn(out[2], accepted)
