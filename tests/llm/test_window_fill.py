"""Packing by least squares: exact ids, every token once, full sequences, optimal repeat counts."""

import itertools
import zlib

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tickloom.llm import window_fill as wf
from tickloom.llm.queries import op12_nnls_packing

PATH = public_tokenizers.path("word_bpe_49k.json")
TEXTS = [
    None, "", " ", "a", "\n\t  ", "Hello, WORLD! don't 'start ''s 's's \"'ll x1234 ½²", "été Straße İ ŉ Ǆ", "你好 мир é é 🙂 ΣΑΣ",
    "<|endoftext|> and <|startoftext|>y", "<|endoftext|", "\u0000﻿\x1c \x85a b", "word " * 6000, "ab" * 3000, "a" * 20_000,
    " " * 2_000_000 + "b", "x\n" * 600_000, "".join(map(chr, range(0x300))),
]


def check(rows, limit):
    by = {}
    for r in rows:
        by.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for held in by.values():
        at = 0
        for offset, length in sorted(held):
            assert offset == at and length > 0
            at += length
        assert at <= limit
    return {s: sum(n for _, n in held) for s, held in by.items()}


def test_ids_equal_the_tokenizer(spark):
    docs = spark.createDataFrame(list(enumerate(TEXTS)) * 2, "doc_id long, text string")
    pieces = wf.tokenise(docs, PATH, limit=64, unit=8, ids=True).toPandas()
    plain = Tokenizer.from_file(PATH)
    for i, text in enumerate(TEXTS):
        ids = np.array([*plain.encode(text or "", add_special_tokens=False).ids, 2], "<u4")
        own = pieces[pieces.doc_id == i].sort_values(["part", "start"], kind="stable")
        assert (own.doc_tokens == len(ids)).all() and own.length.sum() == 2 * len(ids)
        for start, held in own.groupby("start"):
            assert len(held) == 2
            for r in held.itertuples():
                want = ids[start : start + r.length]
                assert list(r.ids) == want.tolist() and r.ids_crc32 == zlib.crc32(want.tobytes())


def test_other_tokenizers_run_as_they_are():
    spec = open(public_tokenizers.path("byte_bpe_50k.json"), encoding="utf-8").read()
    plain, texts = Tokenizer.from_str(spec), ["Hello  world\n", "é" * 50, ""]
    got = [np.frombuffer(b, "<u4").tolist() for b in wf.word_encoder(spec)(texts)]
    assert got == [plain.encode(t, add_special_tokens=False).ids for t in texts]


def test_words_are_looked_up(monkeypatch):
    monkeypatch.setattr(wf, "CACHED_WORDS", 20)
    monkeypatch.setattr(wf, "SEGMENT", 40)
    spec = open(PATH, encoding="utf-8").read()
    encode, plain, rng = wf.word_encoder(spec), Tokenizer.from_str(spec), np.random.default_rng(3)
    vocabulary = ["don't", "we'll", "It's", "'tis", "x's'", "``", "12ab", "é", "naïve,", "中", "<|endoftext|>", "\x00", "\x1f", "ŉ", "(a)", "---", "’s"]
    for _ in range(150):
        texts = [rng.choice([" ", "", "\n", "\xa0 "]).join(rng.choice(vocabulary, rng.integers(0, 40))) for _ in range(4)]
        assert [np.frombuffer(b, "<u4").tolist() for b in encode(texts)] == [plain.encode(t, add_special_tokens=False).ids for t in texts]


@given(st.sets(st.integers(1, 24), max_size=12), st.integers(1, 24), st.integers(1, 4))
def test_combinations_are_all_there(present, window, depth):
    want = {
        c for k in range(1, depth + 1) for c in itertools.combinations_with_replacement(sorted(present), k) if sum(c) == window
    }
    got = wf.combinations(sorted(present), window, depth)
    assert len(got) == len(set(got)) and set(got) == want


@settings(deadline=None)
@given(st.integers(0, 1000))
def test_nnls_is_optimal(seed):
    rng = np.random.default_rng(seed)
    a, b = rng.integers(0, 4, (6, 9)).astype(float), rng.integers(0, 50, 6).astype(float)
    x = wf.nnls(a, b)
    gradient = a.T @ (b - a @ x)
    assert (x >= 0).all() and (gradient <= 1e-6 * (1 + np.abs(a.T @ b).max())).all()  # the conditions of an optimum
    assert np.abs(gradient[x > 1e-9]).max(initial=0) < 1e-5


@settings(deadline=None, max_examples=60)
@given(st.dictionaries(st.one_of(st.integers(1, 7), st.sampled_from(range(8, 65, 8))), st.integers(0, 200), max_size=12))
def test_plan_places_each_rank_once(counts):
    entries = wf.plan(counts, 64, 8)
    taken = {}
    for length, n in counts.items():
        own = entries[entries[:, 0] == length]
        for rank in range(n):
            _, first, number, base, stride = own[np.searchsorted(own[:, 1], rank, "right") - 1]
            t = rank - first
            token = base + t // number * stride + t % number * length
            assert token // 64 == (token + length - 1) // 64
            taken.setdefault(token // 64, []).append((token % 64, length))
    fills = []
    for held in taken.values():
        at = 0
        for offset, length in sorted(held):
            assert offset == at
            at += length
        fills.append(at)
    assert sum(fills) == sum(k * n for k, n in counts.items())


def test_plan_does_not_grow_with_the_counts():
    few = {n: 1 + n % 7 for n in [*range(1, 16), *range(16, 4096, 16)]}
    many = {k: v * 10**9 + v for k, v in few.items()}
    assert len(wf.plan(many)) < 4 * len(wf.plan(few)) + 2000
    alike = wf.plan({4080: 10**12})  # fits no window: each alone
    assert alike.tolist() == [[4080, 0, 1, 0, 4096]]


def test_query(spark):
    docs = {r.doc_id: r.text or "" for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").collect()}
    plain = Tokenizer.from_file(PATH)
    rows = op12_nnls_packing(spark, "/root/testdata/sf0.01").collect()
    fills = check(rows, 4096)
    by = {}
    for r in rows:
        by.setdefault(r.doc_id, []).append(r)
    assert by.keys() == docs.keys()
    total = 0
    for doc_id, own in by.items():
        ids = np.array([*plain.encode(docs[doc_id], add_special_tokens=False).ids, 2], "<u4")
        total += len(ids)
        at = 0
        for r in sorted(own, key=lambda r: r.start):
            assert r.start == at and r.doc_tokens == len(ids) and r.ids_crc32 == zlib.crc32(ids[at : at + r.length].tobytes())
            at += r.length
        assert at == len(ids)
    assert len(fills) == -(-total // 4096)
    assert wf.padding({n: list(fills.values()).count(n) for n in set(fills.values())}) <= 4096


def test_edges(spark):
    rows = [(None if i % 5 == 0 else 7, ["one two three " * (i % 11), None, "x" * i, "hot"][i % 4], i) for i in range(400)]
    docs = spark.createDataFrame(rows + rows[:50], "doc_id long, text string, `length` int").repartition(7)
    pieces = wf.tokenise(docs, PATH, limit=64, unit=8)
    packed = wf.pack(pieces, limit=64, unit=8).collect()
    check(packed, 64)
    assert len(packed) == pieces.count()
    assert wf.pack(wf.tokenise(docs.limit(0), PATH)).count() == 0
    named = docs.select(F.col("text").alias("t.x"), F.col("doc_id").alias("nth"))
    assert wf.tokenise(named.withColumnRenamed("nth", "a.b"), PATH, key="a.b", text="t.x").columns[0] == "a.b"
    with pytest.raises(ValueError):
        wf.pack(pieces, limit=100)
