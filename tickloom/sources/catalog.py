"""Catalog tables over files, with schema inference and partition discovery."""

from __future__ import annotations

import logging

from pyspark.sql import DataFrame, SparkSession, types as T

log = logging.getLogger(__name__)


def _quoted(*names: str) -> str:
    return ".".join(f"`{n}`" for n in names)


def register_table(
    spark: SparkSession, database: str, table: str, path: str, fmt: str = "csv", location: str | None = None, **options: str
) -> None:
    """Create or refresh an external table whose schema is inferred from the files.

    The schema is inferred once. Columns new at the end are added to a known table. Any
    other change makes a new table beside the old one, which takes its place when it is
    complete (the old one is put back if that fails); columns that have gone are logged.
    Files are never touched. ``location`` is where a new database keeps its own tables
    (default: the session's warehouse).
    """
    where = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {_quoted(database)}{where}")
    if fmt == "csv":
        options = {"header": "true", "inferSchema": "true", **options}
    elif fmt == "parquet":
        options = {"mergeSchema": "true", **options}
    name = _quoted(database, table)
    found = spark.read.format(fmt).options(**options).load(path).schema
    folders = _partitions(spark, path)

    def create(under: str) -> None:
        given = ", ".join(f"'{k}' '{v}'" for k, v in options.items())
        by = f" PARTITIONED BY ({', '.join(map(_quoted, folders))})" if folders else ""
        spark.sql(f"CREATE TABLE {under} ({_columns(found)}) USING {fmt} OPTIONS ({given}){by} LOCATION '{path}'")

    if not spark.catalog.tableExists(name):
        create(name)
    else:
        known = spark.table(name).schema
        for gone in sorted(set(known.names) - set(found.names)):
            log.warning("column %s of %s.%s is no longer in the files", gone, database, table)
        own = lambda schema: [(f.name, f.dataType) for f in schema if f.name not in folders]
        old, new = own(known), own(found)
        if new[: len(old)] != old or known.names[len(old) :] != found.names[len(new) :]:
            spare, retired = (_quoted(database, f"{table}_{part}") for part in ("new", "old"))
            create(spare)
            spark.sql(f"ALTER TABLE {name} RENAME TO {retired}")
            try:
                spark.sql(f"ALTER TABLE {spare} RENAME TO {name}")
            except Exception:
                spark.sql(f"ALTER TABLE {retired} RENAME TO {name}")
                raise
            spark.sql(f"DROP TABLE {retired}")
        elif len(new) > len(old):
            spark.sql(f"ALTER TABLE {name} ADD COLUMNS ({_columns(T.StructType([T.StructField(*f) for f in new[len(old) :]]))})")
    _discover(spark, name)


def _columns(schema: T.StructType) -> str:
    return ", ".join(f"{_quoted(f.name)} {f.dataType.simpleString()}" for f in schema)


def _partitions(spark: SparkSession, path: str) -> list[str]:
    """Names of the ``name=value`` folders that lead down from ``path``."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    system, names = folder.getFileSystem(spark._jsc.hadoopConfiguration()), []
    while True:
        below = [s.getPath() for s in system.globStatus(spark._jvm.org.apache.hadoop.fs.Path(folder, "*=*")) if s.isDirectory()]
        if not below:
            return names
        names.append(below[0].getName().split("=")[0])
        folder = below[0]


def _discover(spark: SparkSession, name: str) -> None:
    """Pick up new partition folders and files."""
    if any(c.isPartition for c in spark.catalog.listColumns(name)):
        spark.catalog.recoverPartitions(name)
    spark.catalog.refreshTable(name)


def scan_table(spark: SparkSession, database: str, table: str) -> DataFrame:
    return spark.table(_quoted(database, table))
