"""CSV and Parquet tables, plain or partitioned by year."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from tickloom.schemas import BAR

_CSV = {"header": True, "timestampNTZFormat": "yyyy-MM-dd HH:mm:ss[.SSSSSS]"}


def read_csv(spark: SparkSession, path: str, schema: T.StructType = BAR) -> DataFrame:
    """Typed CSV with a header, one path or a folder of ``year=`` folders."""
    return spark.read.schema(schema).options(**_CSV).csv(path)


def with_year(df: DataFrame, time: str = "datetime") -> DataFrame:
    return df.withColumn("year", F.year(time))


def write_csv_by_year(df: DataFrame, path: str, time: str = "datetime") -> None:
    """One folder per year. Rebalancing keeps files few and splits an outsized year."""
    table = with_year(df, time).hint("rebalance", F.col("year"))
    table.write.mode("overwrite").options(**_CSV).partitionBy("year").csv(path)


def name_by_year(spark: SparkSession, source: str, target: str) -> list[str]:
    """Move the files of ``year=`` folders into one folder, the year at the end of each name; returns the years."""
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    path = jvm.org.apache.hadoop.fs.Path
    system = path(source).getFileSystem(conf)
    system.mkdirs(path(target))
    years = []
    for folder in system.globStatus(path(f"{source}/year=*")):
        years.append(folder.getPath().getName().removeprefix("year="))
        for n, file in enumerate(system.globStatus(path(f"{folder.getPath()}/*.csv"))):
            system.rename(file.getPath(), path(f"{target}/bars_{n}_{years[-1]}.csv"))
    return sorted(years)


def land_csv(spark: SparkSession, files: str, path: str, schema: T.StructType = BAR) -> None:
    """Land CSV files under ``year=/file=``, the year taken from the file name (``…_2024.csv``).

    A file landed again replaces its own rows; other files and other years stay. A name
    without a year is an error, and then nothing is landed.
    """
    name = F.col("_metadata.file_name")
    year = F.regexp_extract(name, r"_(\d{4})\.csv$", 1)
    nameless = F.raise_error(F.concat(F.lit("no year in the file name "), name)).cast("string")
    rows = read_csv(spark, files, schema).withColumns({"year": F.when(year == "", nameless).otherwise(year), "file": name})
    writer = rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").options(**_CSV)
    writer.partitionBy("year", "file").csv(path)


def read_landed(spark: SparkSession, path: str, schema: T.StructType = BAR) -> DataFrame:
    """Landed rows with their ``year`` and ``file``."""
    found = T.StructType([*schema.fields, T.StructField("year", T.IntegerType()), T.StructField("file", T.StringType())])
    return read_csv(spark, path, found)


def write_parquet(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    df.write.mode(mode).parquet(path)


def write_parquet_by_year(df: DataFrame, path: str, only_these_years: bool = False) -> None:
    """Overwrite a table partitioned by its ``year`` column, or only the years present."""
    writer = df.hint("rebalance", F.col("year")).write.mode("overwrite").partitionBy("year")
    if only_these_years:
        writer = writer.option("partitionOverwriteMode", "dynamic")
    writer.parquet(path)


def read_parquet(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)
