"""The n-gram join against all pairs compared one by one."""

import random

import numpy as np
import pytest

from tickloom.llm import ngram_join
from tickloom.llm.components import bitmap, components, maybe_in

SPACE = " \t\n\r\x0b\f"


def word_sets(text, size=5):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    for c in SPACE:
        low = low.replace(c, " ")
    words = [w for w in low.split(" ") if w]
    if not words:
        return set()
    k = min(size, len(words))
    return {tuple(words[i : i + k]) for i in range(len(words) - k + 1)}


def brute(rows, size=5, percent=80):
    sets = [word_sets(t, size) for _, t in rows]
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    postings = {}
    for i, s in enumerate(sets):
        for g in s:
            postings.setdefault(g, []).append(i)
    seen = set()
    for p in postings.values():
        for x in p:
            for y in p:
                if x < y:
                    seen.add((x, y))
    for x, y in seen:
        both = len(sets[x] & sets[y])
        if 100 * both >= percent * len(sets[x] | sets[y]):
            root[find(x)] = find(y)
    least = {}
    for i, (doc, _) in enumerate(rows):
        if doc is not None:
            least[find(i)] = min(least.get(find(i), doc), doc)
    return sorted(((d, len(s), least.get(find(i))) for i, ((d, _), s) in enumerate(zip(rows, sets))), key=str)


def edited(rng, words, share):
    return [rng.choice("uvwxyz") + str(rng.random())[2:6] if rng.random() < share else w for w in words]


def corpus(seed, n=260):
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(400)]
    passage = rng.choices(vocabulary, k=40)
    texts = []
    base = rng.choices(vocabulary, k=120)
    for i in range(n):
        kind = i % 5
        if kind == 0:
            words = rng.choices(vocabulary, k=rng.randint(0, 60))
        elif kind == 1:  # a group of near copies at the edge of the threshold
            words = edited(rng, base, rng.choice([0, 0.01, 0.02, 0.03, 0.05]))
        elif kind == 2:  # a common passage in different surroundings
            words = rng.choices(vocabulary, k=rng.randint(0, 30)) + passage + rng.choices(vocabulary, k=rng.randint(0, 30))
        elif kind == 3:
            words = edited(rng, passage, 0.02)
        else:
            words = texts[rng.randrange(len(texts))].split() if texts else []
            words = edited(rng, words, rng.choice([0, 0.02]))
        texts.append(rng.choice([" ", "\n", " \t"]).join(words))
    return list(enumerate(texts))


def rows_of(df):
    return sorted(((r.doc_id, r.n_shingles, r.component_id) for r in df.collect()), key=str)


@pytest.mark.parametrize(("seed", "size", "percent"), [(1, 5, 80), (2, 3, 70), (3, 1, 90)])
def test_equals_brute_force(spark, seed, size, percent):
    rows = corpus(seed)
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert rows_of(ngram_join.similar_sets(df, size=size, percent=percent)) == brute(rows, size, percent)


def test_edges(spark):
    rows = [
        (5, None), (4, ""), (3, " \n"), (2, "One two"), (1, "one  TWO"), (9, "ÀB c"), (8, "àb c"), (7, "a b c"), (7, "a b c"),
        (None, "one two"), (None, None), (6, "x " * 30_000), (10, "X " * 30_000 + "y"),
    ]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert rows_of(ngram_join.similar_sets(df)) == brute(rows)
    assert ngram_join.similar_sets(df.limit(0)).count() == 0
    kept = ngram_join.one_of_each(df.selectExpr("*", "1 AS key", "2 AS node"))
    assert kept.columns == ["doc_id", "text", "key", "node"]
    assert sorted((r.doc_id for r in kept.collect()), key=str) == sorted([5, 4, 3, 1, 9, 8, 7, None, 6, 10], key=str)


def test_query(spark):
    from tickloom.llm.queries import op6_ngram_join

    sf = "/root/testdata/sf0.01"
    docs = [tuple(r) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]
    want = brute(docs)
    assert len({c for _, _, c in want}) < len(want)
    assert rows_of(op6_ngram_join(spark, sf)) == want


def test_prefixes_of_similar_sets_share_what_they_demand():
    rng = np.random.default_rng(5)
    steps = rng.choice([0, 0, 0, 12, 40], ngram_join.SKETCH).astype(np.uint8)
    for _ in range(300):
        n = int(rng.integers(1, 120))
        a = np.unique(rng.integers(0, 1 << 63, n).astype(np.uint64))
        drop = rng.random(len(a)) > rng.choice([0.0, 0.05, 0.1, 0.2])
        b = np.unique(np.concatenate([a[drop], rng.integers(0, 1 << 63, int(rng.integers(0, 10))).astype(np.uint64)]))
        both = len(np.intersect1d(a, b))
        if len(b) and 100 * both >= 80 * (len(a) + len(b) - both):
            (la, pa), (lb, pb) = ngram_join.prefix(a, steps), ngram_join.prefix(b, steps)
            assert len(np.intersect1d(pa, pb)) >= min(la, lb)


def test_components(spark):
    rng = random.Random(4)
    edges = [(rng.randrange(300), rng.randrange(300)) for _ in range(180)] + [(1000, i) for i in range(1001, 1100)] + [(i, i + 1) for i in range(2000, 2040)]
    root = {}

    def find(x):
        while root.setdefault(x, x) != x:
            x = root[x]
        return x

    for a, b in edges:
        a, b = find(a), find(b)
        if a != b:
            root[max(a, b)] = min(a, b)
    want = {x: find(x) for e in edges for x in e if e[0] != e[1]}
    got = {r.node: r.root for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == want
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_bitmap(spark):
    bits = bitmap(spark.range(0, 5000, 7).select("id"))
    hits = maybe_in(np.arange(100_000, dtype=np.int64), bits)
    assert hits[0:5000:7].all() and hits.sum() < 800


def test_rows_that_share_an_id_are_judged_by_their_texts(spark):
    rows = [
        (1, "one two"), (None, "one two"), (None, "only here"), (None, "and only there"), (None, "twice\tbut"), (None, "TWICE but"),
        (None, None), (None, " "), (7, "a b c"), (7, "A b  c"), (7, "d e f"), (7, "one two"), (7, ""), (8, "d e f"), (9, "a b c"), (9, "g h i"), (3, "x"), (4, "x"),
    ]
    df = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 AS _own", "'s' AS _stay").repartition(3)
    kept = ngram_join.one_of_each(df)
    assert kept.columns == df.columns
    got = sorted(((r.doc_id, " ".join((r.text or "").lower().split())) for r in kept.collect()), key=str)
    want = [
        (1, "one two"), (None, "only here"), (None, "and only there"), (None, "twice but"), (None, ""), (None, ""),
        (7, "a b c"), (7, "d e f"), (7, ""), (9, "g h i"), (3, "x"),
    ]
    assert got == sorted(want, key=str)


def test_each_group_keeps_a_row_with_its_least_id(spark):
    rng = random.Random(8)
    rows = [(rng.choice([None, None, i, i, i // 4]), text) for i, text in corpus(6)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    alone = dict(enumerate(t for _, t in rows))
    group = {r[0]: r[2] for r in brute(list(alone.items()))}
    least = {}
    for i, (doc, _) in enumerate(rows):
        if word_sets(alone[i]):
            g = group[i]
            least[g] = min([x for x in (least.get(g), doc) if x is not None], default=None)
    kept = [(r.doc_id, r.text) for r in ngram_join.one_of_each(df).collect()]
    groups_of = {}
    for i, row in enumerate(rows):
        groups_of[row] = group[i]
    worded = [groups_of[row] for row in kept if word_sets(row[1])]
    assert sorted(worded) == sorted(least)
    assert all(row[0] == least[groups_of[row]] for row in kept if word_sets(row[1]))
    assert sum(not word_sets(t) for _, t in kept) == sum(not word_sets(t) for _, t in rows)


def test_documents_that_only_share_a_passage_do_not_meet_in_pairs(spark, monkeypatch):
    """A passage in many documents makes no pairs where their own words rule a link out."""
    rng = random.Random(11)
    passage = [f"p{i}" for i in range(60)]
    own = lambda k: [f"o{rng.random()}" for _ in range(k)]
    rows = [(i, " ".join(own(rng.randint(12, 20)) + passage)) for i in range(400)]
    rows += [(1000 + i, " ".join(passage + own(rng.randint(0, 11)))) for i in range(60)]
    made, plain = [], ngram_join._meetings

    def counted(still, percent):
        out = plain(still, percent).cache()
        made.append((out.count(), still.count()))
        return out

    monkeypatch.setattr(ngram_join, "_meetings", counted)
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert rows_of(ngram_join.similar_sets(df)) == brute(rows)
    assert made[0][0] <= 20 * len(rows) and made[0][0] < 0.1 * 400 * 400


def test_long_postings_are_compared_in_tiles(spark, monkeypatch):
    monkeypatch.setattr(ngram_join, "SHORT", 2)
    monkeypatch.setattr(ngram_join, "TILE", 8)
    monkeypatch.setattr(ngram_join, "HEAD_ROUNDS", 1)
    rows = corpus(12, 160)
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert rows_of(ngram_join.similar_sets(df)) == brute(rows)
