"""Fill-in-middle against a plain regular expression, and exact round trips."""

import hashlib
import random
import re

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from tickloom.llm import infill
from tickloom.llm.queries import op11_infill

UNIT = re.compile(r"[A-Za-z]+|[^A-Za-z]")


def expected(doc_id, text):
    text = text or ""
    units = UNIT.findall(text)
    h = hashlib.sha256(f"1:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(h[i : i + 8], 16) for i in (0, 8, 16, 24))
    if not text or "<P>" in text or "<S>" in text or "<M>" in text or h3 % 100 >= 90:
        return len(units), "plain", None, None, text
    i, j = sorted((h1 % (len(units) + 1), h2 % (len(units) + 1)))
    p, m, s = "".join(units[:i]), "".join(units[i:j]), "".join(units[j:])
    if h4 % 100 < 20:
        return len(units), "spm", len(p), len(m), "<S>" + s + "<P>" + p + "<M>" + m
    return len(units), "psm", len(p), len(m), "<P>" + p + "<S>" + s + "<M>" + m


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet="aZ é1\n🙂<", max_size=300), st.integers(2, 5))
def test_skip_list_places(text, fan):
    listed = infill.SkipList(text, fan)
    ends = np.cumsum([0] + [len(u) for u in UNIT.findall(text)]).tolist()
    assert [listed.place(k) for k in range(listed.units + 1)] == ends
    with pytest.raises(IndexError):
        listed.place(listed.units + 1)


def test_widths_add_up_on_every_lane():
    rng = random.Random(5)
    text = "".join(rng.choice(["word", " ", "é", "7", "\n"]) for _ in range(20_000))
    listed = infill.SkipList(text)
    assert 3 <= len(listed.lanes) <= 7
    ends = np.cumsum([len(u) for u in UNIT.findall(text)])
    ranks = np.arange(len(ends))
    for width, points, below in listed.lanes:
        ranks = ranks[below]
        assert (np.cumsum(width) == ranks + 1).all()
        assert (np.cumsum(points) == ends[ranks]).all()


def test_query_equals_brute_force(spark):
    docs = {r.doc_id: r.text for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").collect()}
    rows = op11_infill(spark, "/root/testdata/sf0.01").collect()
    assert len(rows) == len(docs)
    forms = set()
    for r in rows:
        n, form, prefix, middle, output = expected(r.doc_id, docs[r.doc_id])
        assert (r.n, r.form, r.prefix_chars, r.middle_chars) == (n, form, prefix, middle)
        assert r.output_sha256 == hashlib.sha256(output.encode()).hexdigest()
        assert r.restored_sha256 == hashlib.sha256((docs[r.doc_id] or "").encode()).hexdigest()
        forms.add(form)
    assert forms == {"plain", "psm", "spm"}


def test_edges(spark):
    texts = [None, "", "a", "x<P>y", "<", "<S", "S>", "<P" * 40, "é🙂\u0000b" * 30, "word " * 200_000, "b" * 300_000, "\n" * 300_000, "a<" * 50]
    rows = [(i % 40 if i % 7 else None, texts[i % len(texts)], "x", "y") for i in range(260)]
    rows += rows[:20]
    docs = spark.createDataFrame(rows, "doc_id long, text string, output string, form string")
    made = infill.fill_in_middle(docs)
    assert made.columns == ["doc_id", "n", "form", "prefix_chars", "middle_chars", "output"]
    back = made.withColumn("text", infill.restored(F.col("output"), F.col("form"))).collect()
    order = lambda t: sorted(t, key=repr)
    assert order(tuple(r)[:6] for r in back) == order((d, *expected(d, t)) for d, t, *_ in rows)
    assert order((r.doc_id, r.text) for r in back) == order((d, t or "") for d, t, *_ in rows)
    assert infill.fill_in_middle(docs.limit(0)).count() == 0
    named = docs.selectExpr("doc_id AS `a.b`", "text AS `t.x`", "text AS key")
    assert infill.fill_in_middle(named, key="a.b", text="t.x").columns[0] == "a.b"


def test_rates(spark):
    docs = spark.range(4000).select(F.col("id").alias("doc_id"), F.lit("one two three").alias("text"))
    forms = {r.form: r["count"] for r in infill.fill_in_middle(docs).groupBy("form").count().collect()}
    assert abs(forms["plain"] - 400) < 80 and abs(forms["spm"] - 720) < 110
    assert {r.form for r in infill.fill_in_middle(docs, rate=0).collect()} == {"plain"}
