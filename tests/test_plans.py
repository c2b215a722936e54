"""What the physical plans must and must not contain."""

import contextlib
import io
import re
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tickloom.operators.bars import last_n_bars
from tickloom.operators.blocks import with_blocks, with_pieces
from tickloom.operators.indicators import with_indicators
from tickloom.plans.queries import QUERIES

BATCH = sorted(n for n in QUERIES if "stream" not in n and "roundtrip" not in n and n != "catalog_scan")


def plan(df):
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        df.explain()
    return out.getvalue()


@pytest.mark.parametrize("name", BATCH)
def test_no_single_task_no_cross_join_no_python(spark, sf_dir, name):
    text = plan(QUERIES[name](spark, sf_dir))
    for unwanted in ("SinglePartition", "CartesianProduct", "BroadcastNestedLoopJoin", "Python", "InPandas", "InArrow"):
        assert unwanted not in text


@pytest.mark.parametrize(
    "name,columns",
    [
        ("vwap_sliding", {"ts", "event_type", "value", "props"}),
        ("daily_bars", {"o_orderkey", "o_totalprice", "o_orderdate", "o_orderpriority"}),
        ("measures_latest", {"ts", "event_type", "value", "props"}),
    ],
)
def test_scans_read_only_what_is_used(spark, sf_dir, name, columns):
    schemas = re.findall(r"ReadSchema: struct<([^>]*)>", plan(QUERIES[name](spark, sf_dir)))
    assert schemas
    for schema in schemas:
        assert {f.split(":")[0] for f in schema.split(",")} <= columns


def test_filters_reach_the_scan(spark, sf_dir):
    text = plan(QUERIES["vwap_latest_closed"](spark, sf_dir))
    pushed = re.search(r"PushedFilters: \[([^]]*)\]", text).group(1)
    assert "LessThan(ts," in pushed
    assert "EqualTo(event_type,purchase)" in plan(QUERIES["symbol_filter"](spark, sf_dir))


def test_indicators_sort_and_shuffle_bars_once(spark, sf_dir):
    """All window steps run on one exchange by symbol and block."""
    bars = spark.read.parquet(f"{sf_dir}/orders.parquet").select(
        F.col("o_orderpriority").alias("symbol"), F.col("o_orderdate").alias("datetime"), F.col("o_totalprice").alias("close")
    )
    text = plan(with_indicators(bars))
    assert len(re.findall(r"Exchange hashpartitioning\(symbol#\d+, _block#", text)) == 1
    assert len(re.findall(r"Sort \[symbol#\d+ ASC NULLS FIRST, _block#", text)) == 1
    assert len(re.findall(r"Window \[.*_block#", text)) == 5


def test_ticks_combine_before_the_shuffle(spark, sf_dir):
    for name in ("vwap_sliding", "bars_1h", "measures_latest"):
        text = plan(QUERIES[name](spark, sf_dir))
        assert "partial_" in text.split("Exchange hashpartitioning")[-1]


def test_blocks_are_bounded_and_lose_nothing(spark):
    start = datetime(2020, 1, 1)
    series = spark.range(20000).select(
        F.lit("HOT").alias("symbol"),
        F.expr("timestampadd(MINUTE, cast(id as int), timestamp_ntz'2020-01-01 00:00:00')").alias("datetime"),
        "id",
    )
    other = spark.createDataFrame([("COLD", start + timedelta(minutes=i), i) for i in range(5)], series.schema)
    cut = with_blocks(series.union(other), "symbol", "datetime", 60, 299).cache()
    sizes = [r["count"] for r in cut.groupBy("symbol", "_block").count().collect()]
    assert max(sizes) <= 4096 and len(sizes) >= 6
    kept = cut.filter("not _halo")
    assert kept.count() == 20005 == kept.select("symbol", "id").distinct().count()
    assert cut.filter("_halo").count() < 0.15 * 20005


def test_pieces_follow_the_rows_not_the_clock(spark):
    """A crowded quarter of an hour among quiet years is cut finely."""
    rows = spark.range(30000).select(
        F.when(F.col("id") % 3 == 0, "COLD").otherwise("HOT").alias("symbol"),
        F.expr(
            "CASE WHEN id % 3 = 0 THEN timestampadd(HOUR, cast(id as int), timestamp_ntz'2015-01-01 00:00:00')"
            " ELSE timestampadd(MILLISECOND, cast(id * 30 as int), timestamp_ntz'2020-01-01 00:00:00') END"
        ).alias("at"),
        "id",
    )
    cut = with_pieces(rows, "symbol", "at", rows=1000).cache()
    assert cut.count() == 30000 == cut.select("id").distinct().count()
    sizes = {(r.symbol, r._piece): r["count"] for r in cut.groupBy("symbol", "_piece").count().collect()}
    assert max(sizes.values()) <= 1000 + 34 and len(sizes) == 30
    bounds = cut.groupBy("symbol", "_piece").agg(F.min("at").alias("lo"), F.max("at").alias("hi"))
    ordered = [(r.symbol, r.lo, r.hi) for r in bounds.orderBy("symbol", "_piece").collect()]
    assert all(a[0] != b[0] or a[2] < b[1] for a, b in zip(ordered, ordered[1:]))


def test_pieces_cut_a_crowded_second(spark):
    """Borders lie inside a second, between rows of different time or order."""
    at = "timestampadd(MICROSECOND, cast(id % 3 as int), timestamp_ntz'2020-01-01 00:00:10')"
    crowd = spark.range(1000).select(F.lit("A").alias("symbol"), F.expr(at).alias("at"), F.expr("1000 - id").alias("seq"))
    quiet = spark.range(400).select(
        F.when(F.col("id") % 2 == 0, "A").otherwise("B").alias("symbol"),
        F.expr("timestampadd(SECOND, cast(id div 10 as int), timestamp_ntz'2020-01-01 00:00:00')").alias("at"),
        F.col("id").alias("seq"),
    )
    rows = crowd.unionByName(quiet).repartition(5)
    cut = with_pieces(rows, "symbol", "at", rows=100, order=["seq"]).cache()
    assert cut.columns == ["symbol", "at", "seq", "_piece"] and cut.count() == 1400
    sizes = {(r.symbol, r._piece): r["count"] for r in cut.groupBy("symbol", "_piece").count().collect()}
    assert max(sizes.values()) <= 200 and 11 <= len(sizes) <= 18
    ends = [F.min(F.struct("at", "seq")).alias("lo"), F.max(F.struct("at", "seq")).alias("hi")]
    ordered = [(r.symbol, r.lo, r.hi) for r in cut.groupBy("symbol", "_piece").agg(*ends).orderBy("symbol", "_piece").collect()]
    assert all(a[0] != b[0] or tuple(a[2]) < tuple(b[1]) for a, b in zip(ordered, ordered[1:]))
    whole = with_pieces(rows, "symbol", "at", rows=100).groupBy("symbol", "_piece").count().agg(F.max("count")).first()[0]
    assert whole >= 1000  # without an order the second stays whole


@pytest.mark.parametrize("name", ["indicators", "pair_asof", "pair_latest", "last_n_bars"])
def test_results_do_not_depend_on_broadcasting(spark, sf_dir, name):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    small = sf_dir.replace("sf0.01", "sf0.001")
    want = QUERIES[name](spark, small).toPandas()
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        got = QUERIES[name](spark, small)
        assert "BroadcastExchange" not in plan(got)
        got = got.toPandas()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    keys = list(want.columns)
    assert got.sort_values(keys).reset_index(drop=True).equals(want.sort_values(keys).reset_index(drop=True))


@pytest.mark.parametrize("name", ["bars_1m", "bars_1h", "bars_monthly", "bars_rollup", "bar_history", "pair_asof"])
def test_order_keys_keep_hash_aggregates(spark, sf_dir, name):
    text = plan(QUERIES[name](spark, sf_dir))
    assert "HashAggregate" in text and "SortAggregate" not in text


def test_no_number_of_bars_gathers_a_symbol_in_one_task(spark, sf_dir):
    """Rows are only ranked within a symbol's stretch of time, whatever n is."""
    bars = spark.read.parquet(f"{sf_dir}/orders.parquet").select(
        F.col("o_orderpriority").alias("symbol"), F.col("o_orderdate").alias("datetime"), F.col("o_totalprice").alias("close")
    )
    for n in (1, 1000, 1001, 10**6):
        text = plan(last_n_bars(bars, n))
        ranks = re.findall(r"row_number\(\) windowspecdefinition\(([^)]*)\)", text)
        assert ranks and all("_grain" in r for r in ranks)
