"""Collocations: summaries that lose no frequent phrase, and plain counting as brute force."""

import random
import re
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from tickloom.llm import phrases

NAMES = ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]


def brute(rows, min_count=30, percent=80, top=2000, longest=4):
    counts, totals = Counter(), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", low):
            words = re.findall(r"[^\x20\x09]+", piece)
            totals[lang] += len(words)
            for k in range(1, longest + 1):
                for i in range(len(words) - k + 1):
                    counts[lang, tuple(words[i : i + k])] += 1
    frequent = {key: f for key, f in counts.items() if f >= min_count}
    out = {}
    for (lang, words), a in frequent.items():
        if len(words) < 2:
            continue
        longer = (f for (x, w), f in frequent.items() if x == lang and len(w) > len(words) and any(w[i : i + len(words)] == words for i in range(len(w))))
        if any(100 * f >= percent * a for f in longer):
            continue
        cuts = [(2000000 * a // (counts[lang, words[:k]] + counts[lang, words[k:]]), k) for k in range(1, len(words))]
        score, k = min(cuts)
        out.setdefault(lang, []).append((-score, -a, " ".join(words).encode(), counts[lang, words[:k]], counts[lang, words[k:]]))
    found = []
    for lang, held in out.items():
        for rank, (score, a, phrase, left, right) in enumerate(sorted(held)[:top], 1):
            found.append((lang, rank, phrase.decode(), -a, left, right, totals[lang], -score))
    return sorted(found)


def texts(seed, n=300):
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(40)] + ["New", "York", "é", "x y", "🙂"]
    fixed = ["new york city hall", "of the", "New York", "on the other hand", "a a a a a"]
    rows = []
    for _ in range(n):
        words = [rng.choice(fixed) if rng.random() < 0.3 else rng.choice(vocabulary[: rng.choice([3, 45])]) for _ in range(rng.randrange(60))]
        text = "".join(w + rng.choice([" "] * 9 + ["\t", "  ", ". ", ",", "\n", "\r\n", "!?"]) for w in words)
        rows.append((rng.choice(["en", "en", "en", "de", None, "und"]), text))
    return rows + [("en", None), (None, None), ("fr", ""), ("en", " \t "), ("en", "...")]


@pytest.mark.parametrize("small", [False, True])
def test_equals_plain_counting(spark, monkeypatch, small):
    if small:  # many blocks, summaries handed on early, many partitions
        monkeypatch.setattr(phrases, "BLOCK", 7)
        monkeypatch.setattr(phrases, "HELD", 300)
        monkeypatch.setattr(phrases, "NAMED", 50)
    rows = texts(1)
    docs = spark.createDataFrame(rows, "lang string, text string").repartition(5)
    got = phrases.collocations(docs, partition_mass=2000 if small else 4_000_000)
    assert got.columns == NAMES
    want = brute(rows)
    assert sorted(tuple(r) for r in got.collect()) == want and len(want) > 30
    few = phrases.collocations(docs, min_count=10, percent=60, top=7, longest=3)
    assert sorted(tuple(r) for r in few.collect()) == brute(rows, 10, 60, 7, 3)


@settings(deadline=None, max_examples=60)
@given(st.lists(st.lists(st.integers(0, 30), max_size=200), min_size=1, max_size=6), st.integers(2, 12), st.integers(1, 4))
def test_summaries_keep_every_frequent_item(streams, least, parts):
    """Merged summaries of any split: a counter plus all that was taken is never below the true count."""
    spread = lambda x: phrases._coded(np.array(x, np.uint64) * np.uint64(0x9E3779B97F4A7C15), parts)
    mass = sum(map(len, streams))
    capacity = mass // least + 1
    merged, taken = Counter(), Counter()
    for items in streams:
        held = phrases.Summaries(capacity)
        for i in range(0, len(items), 20):
            held.add(*np.unique(spread(items[i : i + 20]), return_counts=True))
        for batch in held.handed_on():
            row = batch.to_pylist()[0]
            taken[row["part"]] += row["taken"]
            for h, n in zip(np.frombuffer(row["hashes"], np.uint32), np.frombuffer(row["counts"], np.int64), strict=True):
                merged[row["part"] << 32 | int(h)] += int(n)
    true = Counter(x for items in streams for x in items)
    for item, n in true.items():
        h = spread([item])
        over = merged[int(h[0])] + taken[int(h[0]) >> 32]
        assert merged[int(h[0])] <= n <= over
    assert max(taken.values(), default=0) < least


@pytest.mark.parametrize("capacity", [1, 5])
def test_too_little_capacity_is_noticed_and_mended(spark, monkeypatch, capacity):
    rows = texts(2, 150)
    docs = spark.createDataFrame(rows, "lang string, text string").repartition(3)
    plain = docs.select(F.coalesce("lang", F.lit("und")).alias("lang"), F.coalesce("text", F.lit("")).cast("binary").alias("text"))
    mass = capacity * 10  # far less than there is, so the first capacity is too small
    monkeypatch.setattr(phrases, "HELD", 20)
    kept = {r.hash for r in phrases.survivors(plain, mass, range(1, 5), 3, min_count=30).collect()}
    counts = Counter()
    for lang, text in rows:
        for n, hashes, *_ in phrases.Phrases(range(1, 5))([(text or "").encode()], [phrases._salt("und" if lang is None else lang)]):
            counts.update(phrases._coded(hashes, 3).view(np.int64).tolist())
    frequent = {h for h, n in counts.items() if n >= 30}
    assert frequent <= kept and len(frequent) > 30


def test_hot_phrase_and_long_texts(spark):
    rows = [("en", "spam spam spam egg, " * 20_000), ("en", "x" * 300_000 + " y"), ("en", "one two " * 100_000)] + [("en", "spam spam spam egg")] * 500
    docs = spark.createDataFrame(rows, "lang string, text string")
    assert sorted(tuple(r) for r in phrases.collocations(docs).collect()) == brute(rows)


def test_edges(spark):
    docs = spark.createDataFrame([("a b", None, "q", 1)] * 40 + [(None, None, "q", 1)] * 2, "text string, lang string, phrase string, n int")
    assert [tuple(r) for r in phrases.collocations(docs).collect()] == [("und", 1, "a b", 40, 40, 40, 80, 1_000_000)]
    assert phrases.collocations(docs.limit(0)).count() == 0
    assert phrases.collocations(docs.where("text is null")).count() == 0
    named = docs.select(F.col("text").alias("t.x"), F.col("phrase").alias("l.x"))
    assert [r.lang for r in phrases.collocations(named, text="t.x", lang="l.x").collect()] == ["q"]


def test_products_beyond_64_bits(spark):
    """The arithmetic of scores and covers with counts that no test table reaches."""
    big = 4 * 10**17
    row = spark.range(1).select(phrases._wide(F.lit(big)).alias("wide"), (phrases._wide(F.lit(big)) + phrases._wide(F.lit(big))).alias("both"))
    got = row.select((F.col("wide") * F.lit(phrases.SCALE)).alias("wide"), "both").selectExpr("wide div both AS q").first()
    assert got.q == 2_000_000 * big // (2 * big)


def test_counts_are_combined_over_many_splits(spark):
    """A frequent phrase is a row of each running task, not of each split of the input."""
    docs = spark.createDataFrame([("en", bytearray(b"one two three four"))] * 400, "lang string, text binary").repartition(40)
    bits = np.full(1 << 13, 255, np.uint8)  # all are kept
    cores = spark.sparkContext.defaultParallelism
    rows = phrases._counted(docs, (bits, 1), 4, 1600).collect()
    assert len(rows) <= 10 * cores < 40 * 10
    totals = Counter()
    for r in rows:
        totals[r.phrase] += r.n
    assert len(totals) == 10 and set(totals.values()) == {400}
