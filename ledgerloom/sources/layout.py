"""Table layouts: what indexes, partitions and columnar storage gave the
original toolkit, expressed as how Parquet files are written.

- btree / brin index, clustering  -> range-partition + sort on the columns;
  Parquet min/max per row group then skips most of the file on a filter.
- index on every foreign key      -> sort on a space-filling key of all of them.
- hash index                      -> Parquet bloom filters on the columns, sized
  by a distinct sketch of each.
- unique index                    -> a uniqueness check before writing.
- partial index                   -> a filtered copy.
- list partitions                 -> ``partitionBy(key)``, dynamic overwrite.
- hash partitions                 -> ``bucketBy(n, key)``, n from the table's bytes.
- columnar table                  -> Parquet with zstd.
- ANALYZE                         -> ``ANALYZE TABLE ... COMPUTE STATISTICS``.
"""

from __future__ import annotations

import math
from itertools import islice

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerloom.operators.attributes import quote_name
from ledgerloom.operators.checks import check_unique, enforce
from ledgerloom.session import partition_overwrite
from ledgerloom.sources.catalog import columns_like

# Index methods the original toolkit accepts.
METHODS = ("btree", "brin", "hash")
# Partitions registered per ALTER TABLE statement.
PARTITIONS_PER_STATEMENT = 500


def create_columnar_table(spark: SparkSession, view: str, table: str, path: str,
                          compression: str = "zstd", load: bool = False) -> DataFrame:
    """A Parquet table with the view's columns in order; empty unless ``load``."""
    src = spark.table(view)
    data = src if load else spark.createDataFrame([], src.schema)
    (data.write.format("parquet").option("compression", compression)
     .option("path", path).mode("overwrite").saveAsTable(table))
    return spark.table(table)


def append_rows(df: DataFrame, table: str) -> None:
    """INSERT INTO ... SELECT: append by column position of the table."""
    spark = df.sparkSession
    df.select(*spark.table(table).columns).write.insertInto(table)


def create_partitioned_table(spark: SparkSession, like: DataFrame, table: str, path: str,
                             key: str, compression: str = "zstd") -> DataFrame:
    """An empty Parquet table partitioned by ``key`` with ``like``'s schema."""
    with partition_overwrite(spark, "static"):  # re-creating over old files empties them
        (spark.createDataFrame([], like.schema).write.format("parquet").option("compression", compression)
         .partitionBy(key).option("path", path).mode("overwrite").saveAsTable(table))
    return spark.table(table)


def write_partition(df: DataFrame, table: str) -> None:
    """Replace the partitions present in ``df`` and leave every other
    partition as it is (dynamic partition overwrite)."""
    spark = df.sparkSession
    with partition_overwrite(spark, "dynamic"):
        # rebalanced by the partition columns: about one file per partition, hot ones split by size
        keys = [c.name for c in spark.catalog.listColumns(table) if c.isPartition]
        out = df.select(*[quote_name(c) for c in spark.table(table).columns])
        out = out.hint("rebalance", *[F.col(quote_name(k)) for k in keys]) if keys else out
        out.write.mode("overwrite").insertInto(table)


def clustered_by(df: DataFrame, key: str) -> DataFrame:
    """Rebalance by ``key`` before a partitioned write.

    Without it every task writes a file for every key it holds (tasks x keys
    files); with ``repartition(key)`` a key holding a third of the data lands
    in one task. The hint gathers small keys and splits large ones by measured
    size, reading its input once."""
    return df.hint("rebalance", F.col(quote_name(key)))


def write_list_partitions(df: DataFrame, path: str, key: str, cluster: bool = True) -> None:
    """One folder per key value; folders of keys not in ``df`` are untouched.
    ``cluster`` rebalances first (see :func:`clustered_by`)."""
    out = clustered_by(df, key) if cluster else df
    out.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(key).parquet(path)


def _sql_text(value: str) -> str:
    """A value for a single-quoted Spark SQL literal."""
    return value.replace("\\", "\\\\").replace("'", "\\'")


def add_partitions(spark: SparkSession, table: str, key: str, keys: DataFrame) -> list:
    """Register an (empty) partition for every key from ``keys`` the table
    lacks (an anti join finds them)."""
    # normalise through the partition column's type ('01' and '1' are one int key)
    ptype = dict(spark.table(table).dtypes)[key]
    wanted = keys.select(F.col(quote_name(keys.columns[0])).cast(ptype).cast("string").alias("k")).where("k is not null").distinct()
    # partition names are path-escaped ('a/b' is listed as 'a%2Fb'); a plus sign is not
    listed = spark.sql(f"SHOW PARTITIONS {table}").select(F.substring_index("partition", "=", -1).alias("p"))
    present = listed.select(F.url_decode(F.replace("p", F.lit("+"), F.lit("%2B"))).alias("k"))
    # only the absent ones reach the driver, in order and a statement's worth at
    # a time; it has to name each (the catalog holds as many names)
    absent = (r["k"] for r in wanted.join(present, "k", "left_anti").orderBy("k").toLocalIterator())
    added: list[str] = []
    while some := list(islice(absent, PARTITIONS_PER_STATEMENT)):
        specs = " ".join(f"PARTITION (`{key}` = '{_sql_text(k)}')" for k in some)
        spark.sql(f"ALTER TABLE {table} ADD IF NOT EXISTS {specs}")
        added += some
    return added


def row_hash(df: DataFrame):
    """A hash of the row over the columns that can be hashed (MAPs cannot)."""
    fit = [f.name for f in df.schema.fields if "map<" not in f.dataType.simpleString()]
    return F.xxhash64(*[F.col(quote_name(c)) for c in fit]) if fit else F.lit(0).cast("long")


# Bytes a bucket is meant for, and the most buckets of a table.
BUCKET_BYTES = 256 * 1024 * 1024
MOST_BUCKETS = 1 << 17


def planned_bytes(df: DataFrame) -> int:
    """The size the planner expects of ``df`` (for a plain table its files')."""
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


def bucket_count(*tables: DataFrame, bucket_bytes: int = BUCKET_BYTES) -> int:
    """Buckets for tables that are joined with each other: enough for the
    largest one, a power of two so that tables of other counts still fit."""
    need = max(1, math.ceil(max(planned_bytes(t) for t in tables) / bucket_bytes))
    return min(MOST_BUCKETS, 1 << (need - 1).bit_length())


def write_hash_partitions(df: DataFrame, table: str, key: str, n: int | None, path: str) -> DataFrame:
    """``n`` buckets by hash of ``key`` (None: from the table's bytes); joins
    and aggregations on ``key`` against a table bucketed the same way need no
    shuffle (see :func:`bucket_count` for tables that belong together).

    Before writing, rows are range-partitioned on (bucket id, row hash): each
    task writes about one bucket (files stay near the task count instead of
    tasks x buckets), and a bucket holding a hot key is split over several
    tasks, each writing one file of that bucket."""
    n = bucket_count(df) if n is None else int(n)
    bucket = F.expr(f"pmod(hash({quote_name(key)}), {n})")
    (df.repartitionByRange(bucket, row_hash(df)).write.format("parquet").bucketBy(n, key).sortBy(key)
     .option("path", path).mode("overwrite").saveAsTable(table))
    return df.sparkSession.table(table)


# False positives of a bloom filter, and its bits per value at that rate.
BLOOM_FPP = 0.01
BLOOM_BITS_PER_VALUE = 10


def bloom_options(df: DataFrame, columns: list[str]) -> dict[str, str]:
    """Writer options for bloom filters on ``columns``, sized by an approximate
    distinct count of each (one aggregate over these columns)."""
    if not columns:
        return {}
    counts = df.agg(*[F.approx_count_distinct(F.col(quote_name(c))).alias(f"n{i}") for i, c in enumerate(columns)]).first()
    options, most = {}, 1
    for i, c in enumerate(columns):
        most = max(most, counts[f"n{i}"])
        options[f"parquet.bloom.filter.enabled#{c}"] = "true"
        options[f"parquet.bloom.filter.expected.ndv#{c}"] = str(max(1, counts[f"n{i}"]))
        options[f"parquet.bloom.filter.fpp#{c}"] = str(BLOOM_FPP)
    # a row group's filter is never larger than what its 128 MB can hold of values of eight bytes
    size = min(most, 16 << 20) * BLOOM_BITS_PER_VALUE // 8
    options["parquet.bloom.filter.max.bytes"] = str(max(1 << 20, 1 << size.bit_length()))
    return options


# Bits of a column's rank, and of all ranks together.
RANK_BITS, KEY_BITS = 6, 60


def _sortable(df: DataFrame, column: str) -> Column:
    """The column as a number in the same order (of texts the first six bytes)."""
    c, kind = F.col(quote_name(column)), df.schema[column].dataType
    if isinstance(kind, T.StringType):
        head = F.rpad(F.substring(F.hex(F.encode(c, "utf-8")), 1, 12), 12, "0")
        return F.conv(head, 16, 10).cast("long")
    return c if isinstance(kind, (T.NumericType, T.DateType, T.TimestampType, T.TimestampNTZType)) else F.hash(c)


def _rank(value: Column, cuts: list, low: int = 0) -> Column:
    """How many of the sorted ``cuts`` are at most ``value``, by halving."""
    if not cuts:
        return F.lit(low)
    middle = len(cuts) // 2
    return F.when(value >= F.lit(cuts[middle]), _rank(value, cuts[middle + 1:], low + middle + 1)).otherwise(
        _rank(value, cuts[:middle], low))


def interleaved_key(df: DataFrame, columns: list[str]) -> Column:
    """A space-filling (Z-order) key: the bits of the columns' ranks in turn.

    Ranks come from approximate quantiles (one aggregate; at most 2 ** bits
    cuts a column reach the driver), so that every column gets its share of the
    key however its values are spread. Nulls rank first."""
    bits = max(1, min(RANK_BITS, KEY_BITS // max(1, len(columns))))
    steps = [i / (1 << bits) for i in range(1, 1 << bits)]
    found = df.agg(*[F.percentile_approx(_sortable(df, c), steps, 10_000).alias(f"c{i}") for i, c in enumerate(columns)]).first()
    key = F.lit(0).cast("long")
    for i, c in enumerate(columns):
        cuts = sorted(set(found[f"c{i}"] or []))
        spare = bits - len(cuts).bit_length()  # fewer ranks than bits: the leading bits count
        rank = F.shiftleft(F.coalesce(_rank(_sortable(df, c), cuts), F.lit(0)).cast("long"), max(0, spare))
        for b in range(bits):
            bit = F.shiftright(rank, b).bitwiseAND(F.lit(1).cast("long"))
            key = key.bitwiseOR(F.shiftleft(bit, (b + 1) * len(columns) - 1 - i))
    return key


def write_search_layout(df: DataFrame, path: str, column_names: list[str] | None = None,
                        expression: str | None = None, unique: bool = False, method: str = "btree",
                        partial_condition: str | None = None, replace: bool = False,
                        table: str | None = None, analyze: bool = False,
                        index_key: str = "index_key") -> None:
    """Write ``df`` laid out for fast lookups on some columns or an expression.

    btree/brin: range-partitioned and sorted on the key, so Parquet row-group
    statistics prune. hash: bloom filters on the key columns, sized by their
    distinct values. ``unique`` runs
    a uniqueness check first and raises on duplicates. ``partial_condition``
    writes only matching rows. ``replace`` overwrites, otherwise an existing
    target is left alone. ``table`` registers the files as a catalog table.
    """
    if column_names is None and expression is None:
        raise ValueError("please provide either column_names or expression")
    if method not in METHODS:
        raise ValueError(f"method must be one of {METHODS}")
    data = df if partial_condition is None else df.where(F.expr(partial_condition))
    keys = list(column_names or [])
    if analyze and table is None:
        raise ValueError("statistics belong to a catalog table: pass table as well")
    if expression is not None:
        if index_key in data.columns:
            raise ValueError(f"the table has a column {index_key} already; choose another index_key")
        data = data.withColumn(index_key, F.expr(expression))
        keys = [index_key]
    if unique:
        enforce(check_unique("unique layout key", data, keys))
    writer_df = data
    options = {}
    if method in ("btree", "brin"):
        # the row hash lets equal keys (a hot value) spread over several tasks
        sort = [F.col(quote_name(k)) for k in keys]
        writer_df = data.repartitionByRange(*sort, row_hash(data)).sortWithinPartitions(*sort)
    else:
        options = bloom_options(data, keys)
        writer_df = data.sortWithinPartitions(*[F.col(quote_name(k)) for k in keys])
    writer = writer_df.write.format("parquet").options(**options).mode("overwrite" if replace else "ignore")
    if table is None:
        writer.save(path)
    else:
        writer.option("path", path).saveAsTable(table)
        if analyze:
            analyze_table(df.sparkSession, table)


def write_foreign_key_layout(df: DataFrame, path: str, excluded: list[str] | None = None,
                             replace: bool = True, method: str = "brin", files: int | None = None) -> list[str]:
    """Lay out for lookups on every ``*_fk`` column; returns these columns.

    btree/brin: rows sorted by a space-filling key of all of them, so that row
    groups have narrow ranges of each, not of the first alone (``files`` sets
    into how many). hash: sized bloom filters on each. As in the original
    toolkit the pattern is LIKE ``'%_fk'``, whose underscore matches any
    character."""
    if method not in METHODS:
        raise ValueError(f"method must be one of {METHODS}")
    fks = [c for c in columns_like(df, "%_fk") if c not in set(excluded or [])]
    out, options = df, {}
    if method == "hash":
        options = bloom_options(df, fks)
    elif fks:
        place = "_place"
        while place in df.columns:
            place += "_"
        key = interleaved_key(df, fks) if len(fks) > 1 else F.col(quote_name(fks[0]))
        keyed = df.withColumn(place, key)
        parts = [files] if files else []
        sort = [F.col(quote_name(c)) for c in fks]
        out = keyed.repartitionByRange(*parts, place, row_hash(df)).sortWithinPartitions(place, *sort).drop(place)
    out.write.format("parquet").options(**options).mode("overwrite" if replace else "ignore").save(path)
    return fks


def analyze_table(spark: SparkSession, table: str, columns: list[str] | None = None) -> DataFrame:
    """Compute table and column statistics; returns ``(column_name,
    null_count)`` per column plus ``row_count`` for the table."""
    if columns is None:
        # column statistics exist for atomic types only
        atomic = (T.ArrayType, T.MapType, T.StructType)
        cols = [f.name for f in spark.table(table).schema.fields if not isinstance(f.dataType, atomic)]
    else:
        cols = list(columns)
    quoted = ", ".join(f"`{c}`" for c in cols)
    spark.sql(f"ANALYZE TABLE {table} COMPUTE STATISTICS FOR COLUMNS {quoted}")
    rows = []
    total = None
    for r in spark.sql(f"DESCRIBE TABLE EXTENDED {table}").collect():
        if r[0] == "Statistics" and r[1] and "rows" in r[1]:
            total = int(r[1].split(",")[1].strip().split(" ")[0])
    for c in cols:
        info = {r[0]: r[1] for r in spark.sql(f"DESCRIBE TABLE EXTENDED {table} `{c}`").collect()}
        nulls = info.get("num_nulls")
        rows.append((c, int(nulls) if nulls not in (None, "NULL") else None, total))
    return spark.createDataFrame(rows, "column_name string, null_count bigint, row_count bigint")
