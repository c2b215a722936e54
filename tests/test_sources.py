import logging
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from tickloom.operators.bars import bar_history, last_n_bars, ohlcv, rollup_bars
from tickloom.plans.medallion import bronze_to_silver, silver_to_gold
from tickloom.schemas import BAR
from tickloom.session import scratch
from tickloom.sources import catalog, files, topics
from tickloom.sources.payloads import payload_to_bars

BARS = [
    (datetime(2023, 12, 30), "X:A", 1.0, 2.0, 0.5, 1.5, 10.0),
    (datetime(2023, 12, 31), "X:A", 1.5, 2.5, 1.0, 2.0, 11.0),
    (datetime(2024, 1, 1), "X:A", 2.0, 3.0, 1.5, 2.5, 12.25),
    (datetime(2024, 1, 1), "X:B", 7.0, 7.0, 7.0, 7.0, 1.0),
]


@pytest.fixture
def bars(spark):
    return spark.createDataFrame(BARS, BAR)


def values(df):
    return sorted(tuple(r[c] for c in BAR.fieldNames()) for r in df.collect())


def test_csv_by_year(spark, bars, tmp_path):
    path = str(tmp_path / "csv")
    files.write_csv_by_year(bars, path)
    assert sorted(p.name for p in (tmp_path / "csv").glob("year=*")) == ["year=2023", "year=2024"]
    assert values(files.read_csv(spark, path)) == sorted(BARS)


def test_landing_takes_the_year_from_the_file_name(spark, tmp_path):
    header = "datetime,symbol,open,high,low,close,volume\n"
    (tmp_path / "a_data_2023.csv").write_text(header + "2023-12-31 01:00:00,X:A,1,2,0.5,1.5,10\n")
    (tmp_path / "a_data_2024.csv").write_text(header + "2024-01-01 01:00:00,X:A,1,2,0.5,1.5,10\n")
    bronze = str(tmp_path / "bronze")
    files.land_csv(spark, str(tmp_path / "a_data_*.csv"), bronze)
    rows = spark.read.option("header", True).csv(bronze).select("year", "datetime").collect()
    assert sorted((r.year, str(r.datetime)[:4]) for r in rows) == [(2023, "2023"), (2024, "2024")]


def test_layers(spark, bars, tmp_path):
    silver_path, gold_path = str(tmp_path / "silver"), str(tmp_path / "gold")
    bronze_to_silver(files.with_year(bars).withColumn("partition_0", F.lit("x")), silver_path)
    assert "partition_0" not in files.read_parquet(spark, silver_path).columns
    silver_to_gold(spark, silver_path, gold_path, symbols=["X:A"])
    gold = files.read_parquet(spark, gold_path)
    assert gold.columns == [*BAR.fieldNames(), "SMA_200", "EMA_50", "RSI_14", "MACD", "year"]
    assert [round(r.SMA_200, 6) for r in gold.orderBy("datetime").collect()] == [1.5, 1.75, 2.0]


def test_gold_reads_text_times(spark, bars, tmp_path):
    text = files.with_year(bars).withColumn("datetime", F.col("datetime").cast("string"))
    broken = text.limit(1).withColumn("datetime", F.lit("never"))
    silver_path, gold_path = str(tmp_path / "silver"), str(tmp_path / "gold")
    bronze_to_silver(text.union(broken), silver_path)
    silver_to_gold(spark, silver_path, gold_path)
    assert files.read_parquet(spark, gold_path).count() == len(BARS)


def test_only_present_years_are_replaced(spark, bars, tmp_path):
    path = str(tmp_path / "gold")
    files.write_parquet_by_year(files.with_year(bars), path)
    newer = files.with_year(bars).filter("year = 2024").withColumn("close", F.lit(9.0))
    files.write_parquet_by_year(newer, path, only_these_years=True)
    rows = files.read_parquet(spark, path).collect()
    assert sorted((r.year, r.close) for r in rows) == [(2023, 1.5), (2023, 2.0), (2024, 9.0), (2024, 9.0)]


def test_catalog_follows_the_files(spark, bars, tmp_path, caplog):
    path = str(tmp_path / "t")
    files.write_csv_by_year(bars.filter("year(datetime) = 2023"), path)
    catalog.register_table(spark, "tests", "follow", path, location=scratch(spark, "db"))
    assert catalog.scan_table(spark, "tests", "follow").count() == 2
    files.write_csv_by_year(bars, path)
    catalog.register_table(spark, "tests", "follow", path)
    assert catalog.scan_table(spark, "tests", "follow").count() == 4
    files.write_csv_by_year(bars.drop("volume").withColumn("trades", F.lit(3)), path)
    with caplog.at_level(logging.WARNING):
        catalog.register_table(spark, "tests", "follow", path)
    table = catalog.scan_table(spark, "tests", "follow")
    assert "trades" in table.columns and "volume" not in table.columns
    assert "volume" in caplog.text and table.count() == 4
    assert {r.trades for r in table.collect()} == {3}
    files.write_csv_by_year(bars.drop("volume").withColumns({"trades": F.lit(3), "extra": F.lit("x")}), path)
    catalog.register_table(spark, "tests", "follow", path)
    rows = catalog.scan_table(spark, "tests", "follow").collect()
    assert len(rows) == 4 and {(r.trades, r.extra) for r in rows} == {(3, "x")}
    assert [t.name for t in spark.catalog.listTables("tests") if t.name.startswith("follow")] == ["follow"]


def test_landing_again_replaces_one_file(spark, tmp_path):
    header = "datetime,symbol,open,high,low,close,volume\n"
    line = "{}-06-01 01:00:00,X:A,1,2,0.5,{},10\n"
    bronze = str(tmp_path / "bronze")
    for name, year, close in (("a_2023", 2023, 1), ("b_2023", 2023, 2), ("a_2024", 2024, 3), ("a_2023", 2023, 4)):
        (tmp_path / f"{name}.csv").write_text(header + line.format(year, close))
        files.land_csv(spark, str(tmp_path / f"{name}.csv"), bronze)
    rows = files.read_landed(spark, bronze).collect()
    assert sorted((r.year, r.file, r.close) for r in rows) == [(2023, "a_2023.csv", 4.0), (2023, "b_2023.csv", 2.0), (2024, "a_2024.csv", 3.0)]
    (tmp_path / "nameless.csv").write_text(header + line.format(2025, 5))
    with pytest.raises(Exception, match="no year in the file name"):
        files.land_csv(spark, str(tmp_path / "nameless.csv"), bronze)
    assert files.read_landed(spark, bronze).count() == 3


def test_catalog_parquet(spark, bars, tmp_path):
    path = str(tmp_path / "p")
    files.write_parquet(bars, path)
    files.write_parquet(bars.withColumn("extra", F.lit(1)), path, mode="append")
    catalog.register_table(spark, "tests", "merged", path, "parquet", location=scratch(spark, "db"))
    assert catalog.scan_table(spark, "tests", "merged").filter("extra is null").count() == len(BARS)


PAYLOAD = (
    '~m~99~m~{"m":"x","p":["cs",{"s1":{"s":['
    '{"i":0,"v":[1704067200.0,1.0,2.0,0.5,1.5,10.0]},'
    '{"i":1,"v":[1704153600.0,1.5,2.5,1.0,2.0,NaN]},'
    '{"i":2,"v":[1704240000.0,2.0,3.0,1.5,2.5]},'
    '{"i":3,"v":[1704326400.0,2.5,"?",2.0,3.0,13.0]}],"ns":{}}}]}\n'
)


def test_payload(spark):
    df = spark.createDataFrame([("X:A", PAYLOAD.replace("NaN", '"none"')), ("X:B", "nothing here")], "symbol string, payload string")
    rows = payload_to_bars(df).orderBy("datetime").collect()
    assert [r.datetime for r in rows] == [datetime(2024, 1, d) for d in (1, 2, 3, 4)]
    assert [(r.open, r.high, r.close, r.volume) for r in rows] == [
        (1.0, 2.0, 1.5, 10.0),
        (1.5, 2.5, 2.0, 0.0),
        (2.0, 3.0, 2.5, 0.0),
        (2.5, 0.0, 3.0, 13.0),
    ]
    sticky = payload_to_bars(df, sticky_volume=True).orderBy("datetime").collect()
    assert [r.volume for r in sticky] == [10.0, 0.0, 0.0, 0.0]


TICKS = "symbol string, event_timestamp timestamp_ntz, price double, volume double, id long"


def tick(hour, minute, price, volume, i):
    return ("A", datetime(2024, 1, 1, hour, minute), price, volume, i)


def test_bars_and_rollup(spark):
    ticks = spark.createDataFrame(
        [tick(0, 5, 10.0, 1.0, 1), tick(0, 5, 12.0, 1.0, 2), tick(0, 50, 8.0, 2.0, 3), tick(3, 0, 9.0, 4.0, 4)], TICKS
    )
    hourly = ohlcv(ticks, "1H", order=F.struct("event_timestamp", "id"))
    assert [tuple(r)[2:] for r in hourly.orderBy("datetime").collect()] == [
        (10.0, 12.0, 8.0, 8.0, 4.0),
        (9.0, 9.0, 9.0, 9.0, 4.0),
    ]
    assert tuple(rollup_bars(hourly, "1D").first()) == (datetime(2024, 1, 1), "A", 10.0, 12.0, 8.0, 9.0, 8.0)
    named = ticks.withColumn("symbol", F.concat(F.lit("MCX:"), F.col("symbol"), F.lit("1!")))
    history = bar_history(named, "A", "MCX", "1H", 1, contract=1).collect()
    assert [(r.symbol, r.close) for r in history] == [("MCX:A1!", 9.0)]


@pytest.mark.parametrize("n", [3, 1500])
def test_last_n_bars(spark, n):
    days = spark.range(2000).select(
        F.expr("timestampadd(DAY, cast(id as int), timestamp_ntz'2015-01-01 00:00:00')").alias("datetime"),
        F.when(F.col("id") % 10 == 0, "B").otherwise("A").alias("symbol"),
        *(F.col("id").cast("double").alias(c) for c in BAR.fieldNames()[2:]),
    )
    got = {}
    for r in last_n_bars(days, n).collect():
        got.setdefault(r.symbol, []).append(int(r.close))
    a = [i for i in range(2000) if i % 10]
    assert sorted(got["A"]) == a[-n:] and sorted(got["B"]) == list(range(0, 2000, 10))[-n:]


def test_topic_as_folder(spark, tmp_path):
    messages = spark.createDataFrame([("A", "1"), ("B", "2")], "key string, value string")
    topics.write_topic(messages, str(tmp_path / "topic"), fmt="parquet")
    back = topics.read_topic(spark, str(tmp_path / "topic"), fmt="parquet", schema=messages.schema)
    assert sorted(tuple(r) for r in topics.as_text(back).collect()) == [("A", "1"), ("B", "2")]


def test_connection_options():
    options = topics.sasl_options("host:1", "me", "word")
    assert options["kafka.bootstrap.servers"] == "host:1" and 'username="me"' in options["kafka.sasl.jaas.config"]


def test_scratch_refuses_a_cluster_without_a_shared_folder(spark, monkeypatch):
    class Conf:
        def get(self, *_):
            return None

    class Context:
        master = "yarn"

        def getCheckpointDir(self):
            return None

    class Session:
        conf, sparkContext = Conf(), Context()

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        scratch(Session(), "x")
