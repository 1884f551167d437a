"""Copying a set of tables and publishing a new version of it.

A copy writes all tables aside and then registers them under the target's
names: the old tables stand until every new one does.

Two ways to publish, as Spark can neither rename a database nor move a table
between databases:

* :func:`publish` points the views of a *live* database at the tables of a
  version database, one view after the other, and drops the previous version;
* :func:`stage_version` and :func:`switch_version` keep all versions of a table
  as partitions of one table. Live views resolve their version through a
  manifest, so one row appended to it switches all of them; a query over
  several views reads the manifest once and sees one whole version.
"""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.operators.attributes import quote_name
from ledgerloom.session import partition_overwrite, unique_name
from ledgerloom.sources.catalog import copyable_tables

# Fixed value: how many tables are copied at the same time by default.
DEFAULT_PARALLEL_COPIES = 4
_VERSION_KEY = "ledgerloom.version"


def create_database(spark: SparkSession, name: str, location: str, replace: bool = False) -> None:
    """Make a database; ``replace`` drops one of that name with its tables first."""
    if replace:
        spark.sql(f"DROP DATABASE IF EXISTS {name} CASCADE")
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {name} LOCATION '{location}'")


def table_shape(spark: SparkSession, table: str) -> tuple[list[str], list[str], int, list[str]]:
    """(partition columns, bucket columns, number of buckets, sort columns)."""
    columns = spark.catalog.listColumns(table)
    partitions = [c.name for c in columns if c.isPartition]
    buckets = [c.name for c in columns if c.isBucket]
    said = {r[0]: r[1] or "" for r in spark.sql(f"DESCRIBE TABLE EXTENDED {table}").collect()}
    sorts = [x.strip().strip("`") for x in said.get("Sort Columns", "").strip("[]").split(",") if x.strip()]
    return partitions, buckets, int(said.get("Num Buckets") or 0), sorts


def _remove_folder(spark: SparkSession, path: str) -> None:
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)


def _table_location(spark: SparkSession, table: str) -> str | None:
    for r in spark.sql(f"DESCRIBE TABLE EXTENDED {table}").collect():
        if r[0] == "Location":
            return r[1]
    return None


def copy_database(spark: SparkSession, source: str, target: str, location: str,
                  parallel: int = DEFAULT_PARALLEL_COPIES, tables: list[str] | None = None) -> list[str]:
    """Make ``target`` a copy of ``source``: every table with its partition,
    bucket and sort columns; tables that ``target`` had before go.

    Views are not copied (only tables hold rows). Each table copy is one
    distributed job; up to ``parallel`` of them run at once, which keeps the
    cluster busy when many small tables are copied. All copies are written
    beside the old tables, into fresh folders below ``location``; only when the
    last one is complete are they registered in ``target`` and the old tables
    dropped. A copy that fails leaves ``target`` as it was.
    """
    if source.strip("`").lower() == target.strip("`").lower():
        raise ValueError("source and target are the same database")
    names = tables if tables is not None else copyable_tables(spark, source)
    staging = unique_name("copy")
    create_database(spark, staging, f"{location}/_{staging}")

    def copy(t: str) -> str:
        partitions, buckets, count, sorts = table_shape(spark, f"{source}.{t}")
        df = spark.table(f"{source}.{t}")
        if partitions:
            df = df.hint("rebalance", *[F.col(quote_name(c)) for c in partitions])
        writer = df.write.format("parquet").mode("overwrite").option("path", f"{location}/{t}-{staging}")
        if partitions:
            writer = writer.partitionBy(*partitions)
        if buckets:
            writer = writer.bucketBy(count, *buckets)
            writer = writer.sortBy(*sorts) if sorts else writer
        writer.saveAsTable(f"{staging}.{t}")
        return t

    try:
        with ThreadPoolExecutor(max_workers=max(1, parallel)) as pool:
            done = list(pool.map(copy, names))
        create_database(spark, target, location)
        for t in copyable_tables(spark, target):
            if t not in names:
                _replace_table(spark, None, f"{target}.{t}")
        for t in done:
            _replace_table(spark, f"{staging}.{t}", f"{target}.{t}")
    finally:
        spark.sql(f"DROP DATABASE IF EXISTS {staging} CASCADE")
    return done


def _replace_table(spark: SparkSession, staged: str | None, table: str) -> None:
    """Register the files of ``staged`` as ``table``; what it was goes, files
    too. Only metadata is written."""
    old = _table_location(spark, table) if spark.catalog.tableExists(table) else None
    ddl = None if staged is None else spark.sql(f"SHOW CREATE TABLE {staged}").first()[0]
    spark.sql(f"DROP TABLE IF EXISTS {table}")
    if ddl is not None:
        head, columns = ddl.split(" (", 1)
        spark.sql(f"CREATE TABLE {table} ({columns}")
        if table_shape(spark, table)[0]:
            spark.sql(f"ALTER TABLE {table} RECOVER PARTITIONS")
    if old is not None:
        _remove_folder(spark, old)


def current_version(spark: SparkSession, live: str) -> str | None:
    if not spark.catalog.databaseExists(live):
        return None
    for r in spark.sql(f"DESCRIBE DATABASE EXTENDED {live}").collect():
        if r[0] == "Properties" and _VERSION_KEY in (r[1] or ""):
            text = r[1]
            start = text.index(_VERSION_KEY) + len(_VERSION_KEY) + 1
            return text[start:].split(")")[0].split(",")[0].strip()
    return None


def publish(spark: SparkSession, live: str, version: str, live_location: str,
            drop_previous: bool = True) -> str | None:
    """Point the views of ``live`` at the tables of ``version``; views of tables
    the new version lacks are dropped, then the previous version is dropped.
    Returns the previous version's name.

    Queries still reading the previous version fail once its files are gone;
    pass ``drop_previous=False`` and drop it later when readers run long. A
    version without tables is refused rather than emptying the live views."""
    names = copyable_tables(spark, version)
    if not names:
        raise ValueError(f"{version} holds no tables; refusing to publish it")
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {live} LOCATION '{live_location}'")
    previous = current_version(spark, live)
    for t in names:
        spark.sql(f"CREATE OR REPLACE VIEW {live}.{t} AS SELECT * FROM {version}.{t}")
    for v in spark.catalog.listTables(live):
        if (v.tableType or "").upper() == "VIEW" and not v.isTemporary and v.name not in names:
            spark.sql(f"DROP VIEW IF EXISTS {live}.{v.name}")
    spark.sql(f"ALTER DATABASE {live} SET DBPROPERTIES ('{_VERSION_KEY}' = '{version}')")
    if drop_previous and previous and previous != version:
        spark.sql(f"DROP DATABASE IF EXISTS {previous} CASCADE")
    return previous


# The column that holds a row's version, and the manifest's name.
VERSION_COLUMN = "_version"
MANIFEST = "_manifest"


def _store_of(live: str) -> str:
    return f"{live}_versions"


def stage_version(spark: SparkSession, live: str, location: str, version: str, tables: dict[str, DataFrame]) -> None:
    """Write ``tables`` as ``version`` of the live database; readers see
    nothing of it yet.

    Each table is a partition of ``<live>_versions.<name>``. Columns that a
    version adds are added to the table, and to its live view when the version
    is switched to; a version that lacks a column has nulls there."""
    if not tables:
        raise ValueError("a version needs tables")
    store = _store_of(live)
    create_database(spark, store, f"{location}/{store}")
    for name, df in tables.items():
        if VERSION_COLUMN in df.columns:
            raise ValueError(f"{name} has a column {VERSION_COLUMN}")
        table = f"{store}.{name}"
        rows = df.withColumn(VERSION_COLUMN, F.lit(version))
        if not spark.catalog.tableExists(table):
            (spark.createDataFrame([], rows.schema).write.format("parquet").partitionBy(VERSION_COLUMN)
             .option("path", f"{location}/{store}/{name}").saveAsTable(table))
        have = spark.table(table).columns
        fresh = [f for f in df.schema.fields if f.name not in have]
        if fresh:
            spark.sql(f"ALTER TABLE {table} ADD COLUMNS (" + ", ".join(
                f"{quote_name(f.name)} {f.dataType.simpleString()}" for f in fresh) + ")")
        types = spark.table(table).schema
        out = rows.select(*[(F.col(quote_name(f.name)) if f.name in rows.columns else F.lit(None).cast(f.dataType)).alias(f.name)
                            for f in types.fields])
        with partition_overwrite(spark, "dynamic"):  # staging a version again replaces it
            out.write.mode("overwrite").insertInto(table)


def _manifest(spark: SparkSession, live: str) -> DataFrame:
    return spark.table(f"{_store_of(live)}.{MANIFEST}")


def live_version(spark: SparkSession, live: str) -> str | None:
    """The version that readers of ``live`` see."""
    if not spark.catalog.tableExists(f"{_store_of(live)}.{MANIFEST}"):
        return None
    row = _manifest(spark, live).agg(F.max_by("version", "seq").alias("v")).first()
    return row["v"]


def switch_version(spark: SparkSession, live: str, location: str, version: str) -> str | None:
    """Let all views of ``live`` show ``version``, by one row appended to the
    manifest; returns the version shown before. One publisher at a time.

    Views are made beforehand, for tables that have none or gained columns;
    until the row stands they show the old version. A table that the version
    lacks shows no rows."""
    store = _store_of(live)
    names = [t for t in copyable_tables(spark, store) if t != MANIFEST]
    if not any(spark.table(f"{store}.{t}").where(F.col(VERSION_COLUMN) == version).limit(1).count() for t in names):
        raise ValueError(f"{version} holds no rows; refusing to switch to it")
    manifest = f"{store}.{MANIFEST}"
    if not spark.catalog.tableExists(manifest):
        (spark.createDataFrame([], "seq long, version string").write.format("parquet")
         .option("path", f"{location}/{store}/{MANIFEST}").saveAsTable(manifest))
    create_database(spark, live, f"{location}/{live}")
    views = {t.name: set(spark.table(f"{live}.{t.name}").columns) for t in spark.catalog.listTables(live) if not t.isTemporary}
    for t in names:
        columns = [c for c in spark.table(f"{store}.{t}").columns if c != VERSION_COLUMN]
        if views.get(t) != set(columns):
            spark.sql(f"CREATE OR REPLACE VIEW {live}.{quote_name(t)} AS SELECT {', '.join(map(quote_name, columns))} "
                      f"FROM {store}.{quote_name(t)} WHERE {VERSION_COLUMN} = (SELECT max_by(version, seq) FROM {manifest})")
    before = live_version(spark, live)
    last = _manifest(spark, live).agg(F.coalesce(F.max("seq"), F.lit(0)).alias("n")).first()["n"]
    spark.createDataFrame([(last + 1, version)], "seq long, version string").coalesce(1).write.insertInto(manifest)
    return before


def drop_version(spark: SparkSession, live: str, version: str) -> None:
    """Remove a version's rows. The version that readers see is refused."""
    if live_version(spark, live) == version:
        raise ValueError(f"{version} is the live version")
    store = _store_of(live)
    for t in copyable_tables(spark, store):
        if t == MANIFEST:
            continue
        table = f"{store}.{t}"
        where = _table_location(spark, table)
        escaped = version.replace("\\", "\\\\").replace("'", "\\'")
        spark.sql(f"ALTER TABLE {table} DROP IF EXISTS PARTITION ({VERSION_COLUMN} = '{escaped}')")
        _remove_folder(spark, f"{where}/{VERSION_COLUMN}={version}")
