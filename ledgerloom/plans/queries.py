"""The named queries the driver runs, each with its DuckDB twin.

Every query reads the driver's tables (``table(spark, sf_dir, name)``) over
their whole extent. Queries that exercise a writer write below the shared
checkpoint folder and read their output back.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.functions.chunking import chunk_of_bigint, chunk_of_text
from ledgerloom.operators import asof
from ledgerloom.operators import attributes as attr
from ledgerloom.operators import checks as ck
from ledgerloom.operators import chunks as chk
from ledgerloom.operators import enums as en
from ledgerloom.operators import gram_index as gi
from ledgerloom.operators import series as ser
from ledgerloom.operators import sketches as sk
from ledgerloom.operators import timedim as td
from ledgerloom.plans import sql_snippets as S
from ledgerloom.plans.tables import table
from ledgerloom.session import scratch_path, unique_name
from ledgerloom.sources import layout as lay
from ledgerloom.sources import publish as pub
from ledgerloom.sources import rates_csv as rc
from ledgerloom.sources import scans

QueryFn = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, QueryFn] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn: QueryFn) -> QueryFn:
        REGISTRY[name] = fn
        if sql is not None:
            ORACLE[name] = sql.strip()
        return fn
    return deco


# ---------------------------------------------------------------- attributes

PART_ATTRS_SQL = """
SELECT attribute, value, count(*) AS row_count FROM (
  SELECT 'p_name' AS attribute, p_name AS value FROM part
  UNION ALL SELECT 'p_brand', p_brand FROM part
  UNION ALL SELECT 'p_type', p_type FROM part)
WHERE value IS NOT NULL GROUP BY attribute, value
"""


@register("attributes_table", PART_ATTRS_SQL)
def attributes_table(spark, sf):
    return attr.attribute_counts(table(spark, sf, "part"))


@register("attributes_documents", """
SELECT attribute, value, count(*) AS row_count FROM (
  SELECT 'text' AS attribute, text AS value FROM documents
  UNION ALL SELECT 'lang', lang FROM documents
  UNION ALL SELECT 'source', source FROM documents)
WHERE value IS NOT NULL GROUP BY attribute, value
""")
def attributes_documents(spark, sf):
    """The attribute table of a text-heavy table: whole document texts are
    values too, so exact copies show up with a row count above one."""
    return attr.attribute_counts(table(spark, sf, "documents"))


@register("attributes_sink", PART_ATTRS_SQL)
def attributes_sink(spark, sf):
    """The attribute table written one folder per attribute, read back."""
    path = scratch_path(spark, "part_attributes")
    attr.write_attributes(attr.attribute_counts(table(spark, sf, "part")), path)
    return spark.read.parquet(path).select("attribute", "value", "row_count")


@register("attributes_catalog_table", PART_ATTRS_SQL)
def attributes_catalog_table(spark, sf):
    """``<table>_attributes`` made from a catalog table, one partition per text
    column, rebuilt over an older one."""
    db = unique_name("attrs")
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {db} LOCATION '{scratch_path(spark, db)}'")
    part = table(spark, sf, "part")
    part.where("p_size > 25").write.saveAsTable(f"{db}.part")
    attr.create_attributes_table(spark, f"{db}.part")
    part.write.mode("overwrite").saveAsTable(f"{db}.part")
    return spark.table(attr.create_attributes_table(spark, f"{db}.part")).select("attribute", "value", "row_count")


AUTOCOMPLETE_SQL = """
SELECT value, row_count FROM ({attrs}) a
WHERE attribute = '{attribute}' AND lower(value) LIKE '{pattern}'
ORDER BY row_count DESC, value LIMIT 10
"""


@register("attribute_autocomplete", AUTOCOMPLETE_SQL.format(attrs=PART_ATTRS_SQL, attribute="p_name", pattern="%re%"))
def attribute_autocomplete(spark, sf):
    return attr.autocomplete(attr.attribute_counts(table(spark, sf, "part"), ["p_name"]), "p_name", "Re", k=10)


SIMILARITY_SQL = f"""
SELECT value, row_count, similarity FROM (
  SELECT value, row_count, round(sim, 6) AS similarity, sim FROM (
    SELECT value, row_count,
      CASE WHEN len(g) + len(t) - len(list_intersect(g, t)) > 0
           THEN len(list_intersect(g, t)) / (len(g) + len(t) - len(list_intersect(g, t)))
           ELSE 0.0 END AS sim
    FROM (SELECT value, row_count, {S.trigram_sql('value')} AS g, {S.trigram_sql("'small gear'")} AS t
          FROM ({PART_ATTRS_SQL}) a WHERE attribute = 'p_name') x) y
  WHERE sim >= 0.3
  ORDER BY sim DESC, row_count DESC, value LIMIT 10)
"""


@register("attribute_similarity", SIMILARITY_SQL)
def attribute_similarity(spark, sf):
    return attr.similar_values(attr.attribute_counts(table(spark, sf, "part"), ["p_name"]), "p_name", "small gear", k=10)


def _part_index(spark, sf) -> str:
    path = scratch_path(spark, "part_grams")
    gi.write_gram_index(attr.attribute_counts(table(spark, sf, "part")), path)
    return path


def _lookups_sql(asked: list[tuple[str, str]]) -> str:
    return " UNION ALL ".join(
        f"SELECT '{typed}' AS typed, * FROM (" + AUTOCOMPLETE_SQL.format(
            attrs=PART_ATTRS_SQL, attribute="p_name",
            pattern=("" if mode == "prefix" else "%") + typed.lower() + "%") + ")" for typed, mode in asked)


_ASKED = [("Re", "substring"), ("gear", "substring"), ("sma", "prefix"), ("l ri", "substring"), ("zzzz", "substring")]


@register("gram_autocomplete", _lookups_sql(_ASKED))
def gram_autocomplete(spark, sf):
    """Lookups in the stored postings: lists of the most frequent values for
    short texts, the rarest part's postings for longer ones."""
    path = _part_index(spark, sf)
    return ck.report(*[gi.indexed_autocomplete(spark, path, "p_name", typed, mode=mode).select(
        F.lit(typed).alias("typed"), "value", "row_count") for typed, mode in _ASKED])


@register("gram_similarity", SIMILARITY_SQL)
def gram_similarity(spark, sf):
    """Similarity lookup in the stored postings, prefix and count filters first."""
    return gi.indexed_similar_values(spark, _part_index(spark, sf), "p_name", "small gear", k=10)


# ---------------------------------------------------------- time dimensions

DAY_SQL = S.ORDER_DAYS + f"SELECT {S.DAY_SELECT} FROM days"


def _order_bounds(spark, sf):
    return td.bounds_of(table(spark, sf, "orders"), "o_orderdate")


@register("time_day", DAY_SQL)
def time_day(spark, sf):
    return td.day_dimension(_order_bounds(spark, sf))


@register("time_day_incremental", DAY_SQL)
def time_day_incremental(spark, sf):
    """Build the first half of the range, store it, then extend to the full
    range: only absent days are added."""
    full = _order_bounds(spark, sf)
    half = full.select("start", F.date_add("start", (F.datediff("end", "start") / 2).cast("int")).alias("end"))
    path = scratch_path(spark, "time_day")
    td.day_dimension(half).write.mode("overwrite").parquet(path)
    existing = spark.read.parquet(path)
    td.add_absent_days(existing, full).write.mode("append").parquet(path)
    return spark.read.parquet(path)


@register("time_duration", S.duration_sql(
    "SELECT CAST(min(o_orderdate) AS DATE) AS s, CAST(max(o_orderdate) AS DATE) AS a FROM orders"))
def time_duration(spark, sf):
    b = td.bounds_of(table(spark, sf, "orders"), "o_orderdate", names=("start", "as_of"))
    return td.extend_durations(None, b)


@register("time_duration_extended", S.duration_sql(
    "SELECT CAST(min(o_orderdate) AS DATE) AS s, CAST(max(o_orderdate) AS DATE) AS a FROM orders"))
def time_duration_extended(spark, sf):
    """Durations up to the middle of the range stored first, then extended to
    all of it: ids that are there add nothing."""
    full = td.bounds_of(table(spark, sf, "orders"), "o_orderdate", names=("start", "as_of"))
    half = full.select("start", F.date_add("start", (F.datediff("as_of", "start") / 2).cast("int")).alias("as_of"))
    path = scratch_path(spark, "time_duration")
    td.extend_durations(None, half).write.parquet(path)
    td.insert_if_absent(spark.read.parquet(path), td.duration_dimension(full), ["duration_id"]).write.mode("append").parquet(path)
    return spark.read.parquet(path)


@register("time_tables_written", DAY_SQL)
def time_tables_written(spark, sf):
    """All three time tables as catalog tables, their dates found at run time,
    created for a part of the range and extended to all of it; the day table."""
    first, last = td.bounds_of(table(spark, sf, "orders"), "o_orderdate").first()
    db = unique_name("times")
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {db} LOCATION '{scratch_path(spark, db)}'")
    td.write_time_dimensions(spark, db, first, first + (last - first) / 2)
    return spark.table(td.write_time_dimensions(spark, db, first, last)["day"])


@register("hour_of_day", """
SELECT CAST(h AS SMALLINT) AS hour_of_day_id, CAST(h AS VARCHAR) || '-' || CAST(h + 1 AS VARCHAR) AS hour_of_day_name
FROM (SELECT DISTINCT hour(ts) AS h FROM events WHERE ts IS NOT NULL)
""")
def hour_of_day(spark, sf):
    return td.hours_of(table(spark, sf, "events"), "ts")


# ------------------------------------------------------------- rate series

@register("rates_melt", """
SELECT substr(o_orderpriority, 3, 3) AS currency, min(o_totalprice) AS exchange_rate,
       CAST(o_orderdate AS DATE) AS date
FROM orders WHERE o_totalprice IS NOT NULL AND o_orderdate IS NOT NULL AND o_orderpriority IS NOT NULL
  AND length(trim(substr(o_orderpriority, 3, 3))) = 3   -- only three-letter codes are rate columns
GROUP BY 1, 3
""")
def rates_melt(spark, sf):
    """Lay orders out as a wide rate file (one column per 3-letter priority
    code, N/A where a day has no order of that priority), then load it."""
    return rc.load_rates(spark, _wide_rate_file(spark, sf))


def _wide_rate_file(spark, sf) -> str:
    o = table(spark, sf, "orders")
    wide = (
        o.where("o_totalprice IS NOT NULL AND o_orderdate IS NOT NULL AND o_orderpriority IS NOT NULL")
        .select(F.date_format("o_orderdate", "yyyy-MM-dd").alias("Date"),
                F.substring("o_orderpriority", 3, 3).alias("code"), "o_totalprice")
        .groupBy("Date").pivot("code").agg(F.min("o_totalprice"))
    )
    codes = [c for c in wide.columns if c != "Date"]
    text = wide.select("Date", *[F.coalesce(F.col(c).cast("string"), F.lit(rc.MISSING)).alias(c) for c in codes])
    path = scratch_path(spark, "rates_csv")
    text.write.option("header", True).mode("overwrite").csv(path)
    return path


@register("rate_table_written", """
WITH q AS (SELECT substr(o_orderpriority, 3, 3) AS currency, min(o_totalprice) AS exchange_rate, CAST(o_orderdate AS DATE) AS date
           FROM orders WHERE o_totalprice IS NOT NULL AND o_orderdate IS NOT NULL AND o_orderpriority IS NOT NULL
             AND length(trim(substr(o_orderpriority, 3, 3))) = 3
           GROUP BY 1, 3),
cal AS (SELECT currency, CAST(unnest(generate_series(min(date), (SELECT max(date) FROM q), INTERVAL 1 DAY)) AS DATE) AS date
        FROM q GROUP BY currency)
SELECT cal.currency, q.exchange_rate, cal.date FROM cal ASOF JOIN q ON cal.currency = q.currency AND cal.date >= q.date
UNION ALL SELECT 'EUR', 1.0::DOUBLE, date FROM (SELECT DISTINCT date FROM cal)
""")
def rate_table_written(spark, sf):
    """The whole rate table from a wide file (quotes, filled days, base rows),
    stored laid out for lookups by currency and date, read back."""
    path = scratch_path(spark, "rate_table")
    rc.write_rate_table(rc.build_rate_table(spark, _wide_rate_file(spark, sf)), path)
    return spark.read.parquet(path)


# Fixed value: rows that one task of the tables below takes, whatever their number or compression.
ROWS_PER_TASK = 1 << 19


def _dealt(df: DataFrame, tasks: int, *columns: str) -> DataFrame:
    """``df`` dealt by ``columns`` to a number of tasks that adaptive execution
    keeps: it gathers small partitions by compressed bytes, of which a task's
    hash tables and sorts take many times as much memory."""
    return df.repartition(tasks, *columns)


def _tasks_for(df: DataFrame) -> int:
    """Tasks of ``ROWS_PER_TASK`` rows; counting reads no column."""
    return max(df.sparkSession.sparkContext.defaultParallelism, -(-df.count() // ROWS_PER_TASK))


def _line_quotes(spark, sf, text_key: bool = True) -> DataFrame:
    """The quote table: one (smallest) unit price per supplier and ship day.

    Aggregated on the bigint supplier key (cheaper to hash than its text),
    which becomes the text ``currency`` column on the aggregated rows unless
    ``text_key`` is false. Hardly any two lines share supplier and day, so lines
    are dealt first: a scan task's own partial table would be as large as its split."""
    li = table(spark, sf, "lineitem")
    q = li.select(
        "l_suppkey",
        # a zero quantity gives no price rather than an error
        F.try_divide(F.col("l_extendedprice"), F.col("l_quantity")).alias("exchange_rate"),
        F.col("l_shipdate").cast("date").alias("date"),
    ).where("l_suppkey IS NOT NULL AND date IS NOT NULL AND exchange_rate IS NOT NULL")
    daily = _dealt(q, _tasks_for(li), "l_suppkey", "date").groupBy("l_suppkey", "date").agg(
        F.min("exchange_rate").alias("exchange_rate"))
    if not text_key:
        return daily
    return daily.select(F.col("l_suppkey").cast("string").alias("currency"), "exchange_rate", "date")


def _filled(spark, sf, windowed: bool = False) -> DataFrame:
    fill = ser.gap_fill_windowed if windowed else ser.gap_fill
    return fill(_line_quotes(spark, sf), one_per_day=True)


GAP_FILL_SQL = "WITH " + S.GAP_FILL + "SELECT currency, exchange_rate, date FROM filled"


@register("rates_gap_fill", GAP_FILL_SQL)
def rates_gap_fill(spark, sf):
    return _filled(spark, sf)


@register("rates_gap_fill_window", GAP_FILL_SQL)
def rates_gap_fill_window(spark, sf):
    return _filled(spark, sf, windowed=True)


@register("rates_with_base", "WITH " + S.GAP_FILL + """
SELECT currency, max(exchange_rate) AS exchange_rate, date
FROM (FROM filled SELECT currency, exchange_rate, date
      UNION ALL SELECT 'EUR', 1.0::DOUBLE, date FROM filled)
GROUP BY currency, date
""")
def rates_with_base(spark, sf):
    # the base rows' dates come from the sparse quotes: the filled rows are made once
    quotes = _line_quotes(spark, sf)
    return ser.gap_fill(quotes, one_per_day=True).unionByName(ser.base_rows(quotes))


@register("rates_gap_fill_ranges", GAP_FILL_SQL)
def rates_gap_fill_ranges(spark, sf):
    """Carried forward within date ranges of a key, with a boundary table."""
    return asof.gap_fill_in_ranges(_line_quotes(spark, sf), one_per_day=True)


CONVERSION_SQL = "WITH " + S.GAP_FILL + """,
r AS (SELECT currency, date, min(exchange_rate) AS exchange_rate FROM filled GROUP BY 1, 2)
SELECT l.l_orderkey, l.l_linenumber, r.currency, r.date, l.l_extendedprice, r.exchange_rate,
       l.l_extendedprice * r.exchange_rate AS converted_amount
FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey
JOIN r ON r.currency = CAST(l.l_suppkey AS VARCHAR) AND r.date = CAST(o.o_orderdate AS DATE)
"""


def _converted(joined: DataFrame) -> DataFrame:
    return joined.select(
        "l_orderkey", "l_linenumber", F.col("l_suppkey").cast("string").alias("currency"),
        F.col("order_date").alias("date"), "l_extendedprice", "exchange_rate",
        (F.col("l_extendedprice") * F.col("exchange_rate")).alias("converted_amount"))


def _ordered_lines(spark, sf) -> DataFrame:
    li = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_suppkey", "l_extendedprice")
    o = table(spark, sf, "orders").select("o_orderkey", F.col("o_orderdate").cast("date").alias("order_date"))
    # dealt alike, and merged: a broadcast of orders, whose estimate follows their compressed bytes, would be held by each task
    tasks = _tasks_for(li)
    return _dealt(li, tasks, "l_orderkey").join(_dealt(o, tasks, "o_orderkey").hint("merge"), li.l_orderkey == o.o_orderkey)


@register("rate_conversion_as_of", CONVERSION_SQL)
def rate_conversion_as_of(spark, sf):
    """The same conversion on the sparse quotes: no key x day row is made."""
    quotes = _line_quotes(spark, sf, text_key=False)
    return _converted(asof.as_of_join(_ordered_lines(spark, sf), quotes, "l_suppkey", "order_date", key="l_suppkey", end="last",
                                     one_per_day=True))


@register("rate_conversion", CONVERSION_SQL)
def rate_conversion(spark, sf):
    """Each line converted at its supplier's rate on the day the order was placed."""
    # The series keeps the bigint supplier key here: the 2.5 M-row join side
    # hashes and sorts a bigint, and only the joined rows get the text key.
    rates = ser.gap_fill(_line_quotes(spark, sf, text_key=False), key="l_suppkey", one_per_day=True)
    # one quote per supplier and day, so the filled series is unique per (supplier, day)
    return _converted(ser.attach_rate(_ordered_lines(spark, sf), rates, "l_suppkey", "order_date", key="l_suppkey", rates_unique=True))


# ------------------------------------------------------------------ chunks

TEXT_CHUNK_SQL = """CAST(coalesce(abs(CASE WHEN h >= 2147483648 THEN h - 4294967296 ELSE h END) % 7, 0) AS SMALLINT)"""


@register("chunk_bigint", """
SELECT o_orderkey, CAST(coalesce(abs(o_orderkey) % 7, 0) AS SMALLINT) AS chunk FROM orders
""")
def chunk_bigint(spark, sf):
    o = table(spark, sf, "orders")
    return o.select("o_orderkey", chunk_of_bigint("o_orderkey").alias("chunk"))


@register("chunk_text", f"""
SELECT doc_id, {TEXT_CHUNK_SQL} AS chunk
FROM (SELECT doc_id, CAST('0x' || substr(md5(text), 1, 8) AS BIGINT) AS h FROM documents)
""")
def chunk_text(spark, sf):
    d = table(spark, sf, "documents")
    return d.select("doc_id", chunk_of_text("text").alias("chunk"))


@register("chunk_ids", """
SELECT c.chunk, coalesce(n.row_count, 0) AS row_count
FROM (SELECT CAST(range AS INTEGER) AS chunk FROM range(7)) c
LEFT JOIN (SELECT CAST(coalesce(abs(o_orderkey) % 7, 0) AS INTEGER) AS chunk, count(*) AS row_count
           FROM orders GROUP BY 1) n USING (chunk)
""")
def chunk_ids(spark, sf):
    return chk.chunk_sizes(table(spark, sf, "orders"), "o_orderkey")


@register("chunk_select", f"""
SELECT CAST({TEXT_CHUNK_SQL} AS INTEGER) AS chunk, count(*) AS documents, CAST(sum(n_chars) AS BIGINT) AS total_chars,
       min(doc_id) AS first_doc, max(doc_id) AS last_doc
FROM (SELECT doc_id, n_chars, CAST('0x' || substr(md5(text), 1, 8) AS BIGINT) AS h FROM documents)
GROUP BY 1
""")
def chunk_select(spark, sf):
    """Documents laid out one folder per text chunk, then every chunk read
    back on its own (partition pruning) and summarised."""
    path = scratch_path(spark, "chunks")
    chk.write_by_chunk(table(spark, sf, "documents"), "text", path)
    laid = spark.read.parquet(path)
    parts = [
        chk.select_chunk(laid, "text", k, layout_column="chunk").groupBy("chunk").agg(
            F.count(F.lit(1)).alias("documents"), F.sum("n_chars").alias("total_chars"),
            F.min("doc_id").alias("first_doc"), F.max("doc_id").alias("last_doc"))
        for k in range(7)
    ]
    return ck.report(*parts)


# ------------------------------------------------------------------ checks

def _t(spark, sf, name):
    return table(spark, sf, name)


NULL_D = "CAST(NULL AS DOUBLE)"


@register("check_assert", f"""
SELECT 'order_totals_positive' AS check_name, min(o_totalprice) > 0 AS passed,
       {NULL_D} AS left_value, {NULL_D} AS right_value, 'every order total is positive' AS detail
FROM orders
""")
def check_assert(spark, sf):
    o = _t(spark, sf, "orders")
    return ck.check_true("order_totals_positive", o.agg(F.min("o_totalprice") > 0),
                         "every order total is positive")


def _relation_sql(name, left, right, op, detail=None):
    det = detail or f"left {op} right"
    return f"""
SELECT '{name}' AS check_name, CASE WHEN l IS NULL OR r IS NULL THEN false ELSE l {op} r END AS passed,
       CAST(l AS DOUBLE) AS left_value, CAST(r AS DOUBLE) AS right_value,
       CASE WHEN l IS NULL OR r IS NULL THEN 'NULL operand: {det}' ELSE '{det}' END AS detail
FROM (SELECT ({left}) AS l, ({right}) AS r)
"""


@register("check_relation", _relation_sql(
    "lines_at_least_orders", "SELECT count(*) FROM lineitem", "SELECT count(*) FROM orders", ">="))
def check_relation(spark, sf):
    return ck.check_relation("lines_at_least_orders", _t(spark, sf, "lineitem").agg(F.count(F.lit(1))),
                             _t(spark, sf, "orders").agg(F.count(F.lit(1))), ">=")


@register("check_equal", _relation_sql(
    "order_keys_distinct", "SELECT count(*) FROM orders", "SELECT count(DISTINCT o_orderkey) FROM orders", "="))
def check_equal(spark, sf):
    o = _t(spark, sf, "orders")
    return ck.check_equal("order_keys_distinct", o.agg(F.count(F.lit(1))), o.agg(F.count_distinct("o_orderkey")))


@register("check_not_equal", _relation_sql(
    "orders_with_lines", "SELECT count(DISTINCT l_orderkey) FROM lineitem", "SELECT count(*) FROM orders", "!="))
def check_not_equal(spark, sf):
    return ck.check_not_equal("orders_with_lines", _t(spark, sf, "lineitem").agg(F.count_distinct("l_orderkey")),
                              _t(spark, sf, "orders").agg(F.count(F.lit(1))))


@register("check_le", _relation_sql(
    "discount_at_most_tenth", "SELECT max(l_discount) FROM lineitem", "SELECT CAST(0.1 AS DOUBLE)", "<="))
def check_le(spark, sf):
    li = _t(spark, sf, "lineitem")
    return ck.check_at_most("discount_at_most_tenth", li.agg(F.max("l_discount")),
                            li.agg(F.lit(0.1).cast("double")))


@register("check_ge", _relation_sql(
    "customers_cover_buyers", "SELECT count(*) FROM customer", "SELECT count(DISTINCT o_custkey) FROM orders", ">="))
def check_ge(spark, sf):
    return ck.check_at_least("customers_cover_buyers", _t(spark, sf, "customer").agg(F.count(F.lit(1))),
                             _t(spark, sf, "orders").agg(F.count_distinct("o_custkey")))


@register("check_almost_equal", """
SELECT 'net_close_to_gross' AS check_name,
       CASE WHEN l IS NULL OR r IS NULL THEN false
            ELSE coalesce(abs((r - l) / nullif(l, 0)), 0) < 0.1 END AS passed,
       CAST(l AS DOUBLE) AS left_value, CAST(r AS DOUBLE) AS right_value,
       CASE WHEN l IS NULL OR r IS NULL THEN 'NULL operand: relative difference < 0.1'
            ELSE 'relative difference < 0.1' END AS detail
FROM (SELECT (SELECT sum(CAST(l_extendedprice AS DECIMAL(18, 2))) FROM lineitem) AS l,
             (SELECT sum(CAST(l_extendedprice AS DECIMAL(18, 2)) * (1 - CAST(l_discount AS DECIMAL(4, 2))))
              FROM lineitem) AS r)
""")
def check_almost_equal(spark, sf):
    li = _t(spark, sf, "lineitem")
    gross = F.col("l_extendedprice").cast("decimal(18,2)")
    net = gross * (F.lit(1) - F.col("l_discount").cast("decimal(4,2)"))
    return ck.check_almost_equal("net_close_to_gross", 0.1, li.agg(F.sum(gross)), li.agg(F.sum(net)))


_NF_COLS = ["l_orderkey", "l_linenumber", "l_returnflag", "l_linestatus"]


@register("check_not_found", """
WITH f AS (SELECT l_orderkey, l_linenumber, l_returnflag, l_linestatus FROM lineitem WHERE l_discount > 0.09),
top AS (SELECT * FROM f ORDER BY l_orderkey NULLS FIRST, l_linenumber NULLS FIRST,
                                 l_returnflag NULLS FIRST, l_linestatus NULLS FIRST LIMIT 20),
n AS (SELECT count(*) AS n FROM f)
SELECT 'discount_at_most_9pct' AS check_name, n = 0 AS passed, CAST(n AS DOUBLE) AS left_value,
       CAST(0 AS DOUBLE) AS right_value,
       CASE WHEN n > 0 THEN (SELECT string_agg(
           'l_orderkey = ' || coalesce(CAST(l_orderkey AS VARCHAR), 'null')
           || ', l_linenumber = ' || coalesce(CAST(l_linenumber AS VARCHAR), 'null')
           || ', l_returnflag = ' || coalesce(l_returnflag, 'null')
           || ', l_linestatus = ' || coalesce(l_linestatus, 'null'), chr(10)
           ORDER BY l_orderkey NULLS FIRST, l_linenumber NULLS FIRST, l_returnflag NULLS FIRST,
                    l_linestatus NULLS FIRST) FROM top) END AS detail
FROM n
""")
def check_not_found(spark, sf):
    li = _t(spark, sf, "lineitem")
    return ck.check_not_found("discount_at_most_9pct", li.where("l_discount > 0.09").select(*_NF_COLS))


def _avg_by_line(li: DataFrame) -> DataFrame:
    per_line = li.groupBy("l_linenumber").agg(F.avg("l_quantity").alias("q"))
    return per_line.agg(F.transform(F.sort_array(F.collect_list(F.struct("l_linenumber", "q"))),
                                    lambda s: s["q"]).alias("a"))


@register("check_array", """
WITH a AS (SELECT coalesce(list(q ORDER BY l_linenumber NULLS FIRST), []) AS v FROM
             (SELECT l_linenumber, avg(l_quantity) AS q FROM lineitem GROUP BY 1)),
b AS (SELECT coalesce(list(q ORDER BY l_linenumber NULLS FIRST), []) AS v FROM
             (SELECT l_linenumber, avg(l_quantity) AS q FROM lineitem WHERE l_tax < 0.02 GROUP BY 1)),
p AS (SELECT (SELECT v FROM a) AS av, (SELECT v FROM b) AS bv),
d AS (SELECT len(list_filter(list_transform(range(1, greatest(len(av), len(bv)) + 1),
                                            lambda i: av[i] - bv[i]),
                             lambda x: abs(x) > 0.3)) AS n FROM p)
SELECT 'quantity_by_line_stable' AS check_name, n = 0 AS passed, CAST(n AS DOUBLE) AS left_value,
       CAST(0.3 AS DOUBLE) AS right_value, CAST(NULL AS VARCHAR) AS detail FROM d
""")
def check_array(spark, sf):
    li = _t(spark, sf, "lineitem")
    return ck.check_almost_equal_array("quantity_by_line_stable", _avg_by_line(li),
                                       _avg_by_line(li.where("l_tax < 0.02")), 0.3)


@register("check_pk", """
SELECT 'orders_pk' AS check_name, n = 0 AS passed, CAST(n AS DOUBLE) AS left_value, CAST(0 AS DOUBLE) AS right_value,
       'primary key (o_orderkey)' AS detail
FROM (SELECT count(*) AS n FROM (SELECT o_orderkey, count(*) AS c FROM orders GROUP BY 1)
      WHERE c > 1 OR o_orderkey IS NULL)
UNION ALL
SELECT 'lineitem_pk', n = 0, CAST(n AS DOUBLE), CAST(0 AS DOUBLE), 'primary key (l_orderkey, l_linenumber)'
FROM (SELECT count(*) AS n FROM (SELECT l_orderkey, l_linenumber, count(*) AS c FROM lineitem GROUP BY 1, 2)
      WHERE c > 1 OR l_orderkey IS NULL OR l_linenumber IS NULL)
""")
def check_pk(spark, sf):
    return ck.report(
        ck.check_primary_key("orders_pk", _t(spark, sf, "orders"), columns=["o_orderkey"]),
        ck.check_primary_key("lineitem_pk", _t(spark, sf, "lineitem"), columns=["l_orderkey", "l_linenumber"]),
    )


def _fk_sql(name, child, col, parent, pcol, where="TRUE"):
    return f"""
SELECT '{name}' AS check_name, coalesce(sum(c), 0) = 0 AS passed, CAST(coalesce(sum(c), 0) AS DOUBLE) AS left_value,
       CAST(count(*) AS DOUBLE) AS right_value, '{col} -> {pcol}' AS detail
FROM (SELECT {col} AS k, count(*) AS c FROM {child} WHERE {col} IS NOT NULL GROUP BY 1) ch
WHERE NOT EXISTS (SELECT 1 FROM {parent} p WHERE p.{pcol} = ch.k AND ({where}))
"""


@register("check_fk", _fk_sql("orders_customer_fk", "orders", "o_custkey", "customer", "c_custkey")
          + " UNION ALL " + _fk_sql("orders_creditor_fk", "orders", "o_custkey", "customer", "c_custkey",
                                    "p.c_acctbal > 0"))
def check_fk(spark, sf):
    o, c = _t(spark, sf, "orders"), _t(spark, sf, "customer")
    return ck.report(
        ck.check_foreign_key("orders_customer_fk", o, "o_custkey", c, "c_custkey"),
        # customers in credit only: orders of the others are orphans
        ck.check_foreign_key("orders_creditor_fk", o, "o_custkey", c.where("c_acctbal > 0"), "c_custkey"),
    )


@register("check_fk_convention",
          _fk_sql("orders_customer_fk", "(SELECT o_custkey AS customer_fk FROM orders)", "customer_fk",
                  "(SELECT c_custkey AS customer_id FROM customer)", "customer_id")
          + " UNION ALL "
          + _fk_sql("lines_funded_supplier_fk", "(SELECT l_suppkey AS supplier_fk FROM lineitem)", "supplier_fk",
                    "(SELECT s_suppkey AS supplier_id, s_acctbal FROM supplier)", "supplier_id",
                    "p.s_acctbal > 0"))
def check_fk_convention(spark, sf):
    orders = _t(spark, sf, "orders").select(F.col("o_custkey").alias("customer_fk"))
    customer = _t(spark, sf, "customer").select(F.col("c_custkey").alias("customer_id"))
    lines = _t(spark, sf, "lineitem").select(F.col("l_suppkey").alias("supplier_fk"))
    supplier = _t(spark, sf, "supplier").where("s_acctbal > 0").select(F.col("s_suppkey").alias("supplier_id"))
    return ck.report(
        ck.check_foreign_key_by_name("orders_customer_fk", orders, customer, "customer"),
        ck.check_foreign_key_by_name("lines_funded_supplier_fk", lines, supplier, "supplier"),
    )


_EXPR_CHECKS = {
    "quantity_positive": "l_quantity > 0",
    "discount_in_range": "l_discount BETWEEN 0 AND 0.1",
    "tax_not_above_discount": "l_tax <= l_discount",
}


@register("check_expression", " UNION ALL ".join(
    f"SELECT '{k}' AS check_name, count_if(NOT ({v})) = 0 AS passed, CAST(count_if(NOT ({v})) AS DOUBLE) AS left_value,"
    f" CAST(0 AS DOUBLE) AS right_value, '{v}' AS detail FROM lineitem"
    for k, v in _EXPR_CHECKS.items()))
def check_expression(spark, sf):
    return ck.check_expressions(_t(spark, sf, "lineitem"), _EXPR_CHECKS)


@register("check_table_scalars", """
SELECT 'quantity_positive' AS check_name, min(l_quantity) > 0 AS passed, CAST(NULL AS DOUBLE) AS left_value,
       CAST(NULL AS DOUBLE) AS right_value, CAST(NULL AS VARCHAR) AS detail FROM lineitem
UNION ALL
SELECT 'tax_below_discount_cap',
       CASE WHEN max(l_tax) IS NULL OR max(l_discount) IS NULL THEN false ELSE max(l_tax) <= max(l_discount) END,
       CAST(max(l_tax) AS DOUBLE),
       CAST(max(l_discount) AS DOUBLE), 'left <= right' FROM lineitem
UNION ALL
SELECT 'net_close_to_gross',
       CASE WHEN l IS NULL OR r IS NULL THEN false ELSE coalesce(abs((r - l) / nullif(l, 0)), 0) < 0.1 END,
       CAST(l AS DOUBLE), CAST(r AS DOUBLE),
       'relative difference < 0.1'
FROM (SELECT sum(CAST(l_extendedprice AS DECIMAL(18, 2))) AS l,
             sum(CAST(l_extendedprice AS DECIMAL(18, 2)) * (1 - CAST(l_discount AS DECIMAL(4, 2)))) AS r
      FROM lineitem)
""")
def check_table_scalars(spark, sf):
    """Boolean, relation and almost-equal checks of one table in one scan."""
    li = _t(spark, sf, "lineitem")
    gross = F.col("l_extendedprice").cast("decimal(18,2)")
    net = gross * (F.lit(1) - F.col("l_discount").cast("decimal(4,2)"))
    return ck.check_aggregates(li, {
        "quantity_positive": F.min("l_quantity") > 0,
        "tax_below_discount_cap": (F.max("l_tax"), "<=", F.max("l_discount")),
        "net_close_to_gross": ("almost", 0.1, F.sum(gross), F.sum(net)),
    })


@register("check_unique_partial", """
SELECT 'large_part_brand_unique' AS check_name, n = 0 AS passed, CAST(n AS DOUBLE) AS left_value,
       CAST(0 AS DOUBLE) AS right_value, 'unique' AS detail
FROM (SELECT count(*) AS n FROM (SELECT lower(p_brand) AS k, count(*) AS c FROM part
                                 WHERE p_size > 40 AND lower(p_brand) IS NOT NULL GROUP BY 1) WHERE c > 1)
""")
def check_unique_partial(spark, sf):
    return ck.check_unique("large_part_brand_unique", _t(spark, sf, "part"), ["lower(p_brand)"], where="p_size > 40")


@register("check_unique_wide", """
SELECT 'texts_unique' AS check_name, n = 0 AS passed, CAST(n AS DOUBLE) AS left_value, CAST(0 AS DOUBLE) AS right_value,
       'unique' AS detail
FROM (SELECT count(*) AS n FROM (SELECT text FROM documents WHERE text IS NOT NULL GROUP BY text HAVING count(*) > 1))
UNION ALL
SELECT 'documents_pk', n = 0, CAST(n AS DOUBLE), CAST(0 AS DOUBLE), 'primary key (text, doc_id)'
FROM (SELECT count(*) AS n FROM (SELECT text, doc_id, count(*) AS c FROM documents GROUP BY 1, 2)
      WHERE c > 1 OR text IS NULL OR doc_id IS NULL)
""")
def check_unique_wide(spark, sf):
    """Whole texts as keys: their hashes are counted first, and only texts
    whose hash occurs twice are exchanged."""
    d = _t(spark, sf, "documents")
    return ck.report(ck.check_unique("texts_unique", d, ["text"]),
                     ck.check_primary_key("documents_pk", d, columns=["text", "doc_id"]))


# ------------------------------------------------------------------- enums

PRIORITY_ENUM_SQL = """
SELECT value, CAST(row_number() OVER (ORDER BY value) AS INTEGER) AS ordinal
FROM (SELECT DISTINCT o_orderpriority AS value FROM orders WHERE o_orderpriority IS NOT NULL)
"""


@register("enum_from_query", PRIORITY_ENUM_SQL)
def enum_from_query(spark, sf):
    return en.create_enum(_t(spark, sf, "orders"), "o_orderpriority")


@register("enum_append", f"""
WITH e AS ({PRIORITY_ENUM_SQL}),
fresh AS (SELECT DISTINCT p_type AS value FROM part
          WHERE p_type IS NOT NULL AND p_type NOT IN (SELECT value FROM e))
SELECT value, ordinal FROM e
UNION ALL
SELECT value, CAST((SELECT coalesce(max(ordinal), 0) FROM e) + row_number() OVER (ORDER BY value) AS INTEGER)
FROM fresh
""")
def enum_append(spark, sf):
    e = en.create_enum(_t(spark, sf, "orders"), "o_orderpriority")
    # appending the priorities again adds nothing; part types are new
    e = en.add_enum_values(e, _t(spark, sf, "orders"), "o_orderpriority")
    return en.add_enum_values(e, _t(spark, sf, "part"), "p_type")


@register("enum_sort", f"""
WITH e AS ({PRIORITY_ENUM_SQL})
SELECT o_orderkey, o_orderpriority, e.ordinal AS o_orderpriority_ordinal
FROM orders LEFT JOIN e ON orders.o_orderpriority = e.value
""")
def enum_sort(spark, sf):
    o = _t(spark, sf, "orders")
    e = en.create_enum(o, "o_orderpriority")
    return en.with_ordinal(o.select("o_orderkey", "o_orderpriority"), "o_orderpriority", e) \
        .orderBy("o_orderpriority_ordinal", "o_orderkey")


@register("enum_outside", """
SELECT p_partkey, p_name FROM part
WHERE p_name IS NOT NULL AND p_name NOT IN (SELECT p_name FROM part WHERE p_size > 49 AND p_name IS NOT NULL)
""")
def enum_outside(spark, sf):
    """Parts whose name is not in the enum of the largest parts' names."""
    part = _t(spark, sf, "part")
    return en.outside_enum(part, "p_name", en.create_enum(part.where("p_size > 49"), "p_name")).select("p_partkey", "p_name")


@register("long_labels", """
SELECT DISTINCT text AS value, CAST(length(text) AS INTEGER) AS chars FROM documents WHERE length(text) > 63
""")
def long_labels(spark, sf):
    """Labels over 63 characters with their length."""
    return en.long_labels(_t(spark, sf, "documents"), "text")


# ---------------------------------------------------------------- sketches

def _supplier_sketches(spark, sf):
    li = _t(spark, sf, "lineitem")
    detail = sk.hll_sketches(li.withColumn("ship_month", F.date_trunc("month", "l_shipdate")),
                             ["l_suppkey", "ship_month"], "l_partkey")
    return li, sk.hll_rollup(detail, ["l_suppkey"])


@register("hll_rollup", """
SELECT l_suppkey, true AS within_tolerance FROM lineitem WHERE l_partkey IS NOT NULL GROUP BY l_suppkey
""")
def hll_rollup(spark, sf):
    """Per supplier: the rolled-up sketch estimate is within 5 % of the exact
    distinct count of parts."""
    li, est = _supplier_sketches(spark, sf)
    exact = li.where("l_partkey IS NOT NULL").groupBy("l_suppkey").agg(
        F.count_distinct("l_partkey").alias("exact"))
    # null-safe: rows without a supplier form their own group on both sides
    joined = est.join(exact, est.l_suppkey.eqNullSafe(exact.l_suppkey)).select(
        est.l_suppkey, "distinct_estimate", "exact")
    return joined.select(
        "l_suppkey", (F.abs(F.col("distinct_estimate") - F.col("exact")) <= 0.05 * F.col("exact"))
        .alias("within_tolerance"))


@register("hll_estimate")
def hll_estimate(spark, sf):
    """Raw rolled-up estimates (approximate: rows-only comparison)."""
    return _supplier_sketches(spark, sf)[1]


@register("hll_stored", """
SELECT l_suppkey, count(DISTINCT l_partkey) AS distinct_estimate FROM lineitem GROUP BY l_suppkey
""")
def hll_stored(spark, sf):
    """Estimates from the stored sketch table after three loads, the last of
    which brings rows of a month that is there already. Up to some thousand
    values a sketch of this size keeps every hash, so the estimates are exact."""
    li = _t(spark, sf, "lineitem").withColumn("ship_month", F.date_format("l_shipdate", "yyyy-MM"))
    day = F.unix_date(F.col("l_shipdate").cast("date"))
    middle = li.agg(F.percentile_approx(day, 0.5)).scalar()
    path = scratch_path(spark, "sketches")
    for load in (li.where(day < middle), li.where((day > middle) | day.isNull()), li.where(day == middle)):
        sk.load_sketches(load, path, ["l_suppkey"], "l_partkey", "ship_month", lg_k=16)
    return sk.hll_rollup(spark.read.parquet(path), ["l_suppkey"])


# ------------------------------------------------------------------ layouts

@register("list_partition_write", """
SELECT CAST(strftime(ts, '%Y%m%d') AS INTEGER) AS day_key, count(*) AS row_count
FROM events GROUP BY 1
""")
def list_partition_write(spark, sf):
    """Events in one folder per day key, written in two runs: the second run
    replaces only the days it holds."""
    ev = _t(spark, sf, "events").withColumn("day_key", F.date_format("ts", "yyyyMMdd").cast("int"))
    path = scratch_path(spark, "events_by_day")
    middle = ev.agg(F.percentile_approx("day_key", 0.5)).scalar()
    lay.write_list_partitions(ev.where(F.col("day_key") <= middle), path, "day_key")
    # the second run also carries rows without a timestamp (the NULL key folder)
    lay.write_list_partitions(ev.where((F.col("day_key") >= middle) | F.col("day_key").isNull()), path, "day_key")
    back = spark.read.parquet(path)
    return back.groupBy("day_key").agg(F.count(F.lit(1)).alias("row_count"))


@register("list_partitions_from_keys", """
SELECT DISTINCT CAST(strftime(ts, '%Y%m%d') AS INTEGER) AS day_key FROM events WHERE ts IS NOT NULL
""")
def list_partitions_from_keys(spark, sf):
    """A partition for every key a key query returns, made only if absent:
    the first days are loaded, then every day key of the events is
    registered; the table's partition list is read back."""
    db = unique_name("keyparts")
    root = scratch_path(spark, db)
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {db} LOCATION '{root}'")
    ev = _t(spark, sf, "events").withColumn("day_key", F.date_format("ts", "yyyyMMdd").cast("int"))
    lay.create_partitioned_table(spark, ev, f"{db}.events_p", f"{root}/events_p", "day_key")
    middle = ev.agg(F.percentile_approx("day_key", 0.5)).scalar()
    lay.write_partition(ev.where(F.col("day_key") <= middle), f"{db}.events_p")
    lay.add_partitions(spark, f"{db}.events_p", "day_key", ev.select("day_key").where("day_key IS NOT NULL"))
    listing = spark.sql(f"SHOW PARTITIONS {db}.events_p")
    return listing.select(F.split(F.col("partition"), "=").getItem(1).cast("int").alias("day_key"))


@register("hash_partition_write", """
SELECT count(*) AS total_rows, count(DISTINCT o_orderkey) AS distinct_keys, true AS colocated FROM orders
""")
def hash_partition_write(spark, sf):
    db = unique_name("hashpart")
    root = scratch_path(spark, db)
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {db} LOCATION '{root}'")
    tbl = lay.write_hash_partitions(_t(spark, sf, "orders"), f"{db}.orders_b", "o_orderkey", 8, f"{root}/orders_b")
    tagged = tbl.select("o_orderkey", F.regexp_extract(F.input_file_name(), r"_(\d{5})[.-]", 1).alias("bucket"))
    per_key = tagged.groupBy("o_orderkey").agg(F.count(F.lit(1)).alias("n"), F.count_distinct("bucket").alias("b"))
    return per_key.agg(
        F.coalesce(F.sum("n"), F.lit(0)).cast("bigint").alias("total_rows"),
        F.count("o_orderkey").alias("distinct_keys"),  # the NULL key group is not a key
        F.coalesce(F.max(F.when(F.col("o_orderkey").isNotNull(), F.col("b"))) <= 1, F.lit(True)).alias("colocated"))


@register("bucketed_join", """
SELECT o.o_orderkey, o.o_custkey, l.l_linenumber, l.l_extendedprice
FROM orders o JOIN lineitem l ON l.l_orderkey = o.o_orderkey
""")
def bucketed_join(spark, sf):
    """Orders and lines in buckets of their order key, as many as the larger
    table's bytes ask for, joined without an exchange."""
    o, li = _t(spark, sf, "orders"), _t(spark, sf, "lineitem")
    db = unique_name("cobucket")
    root = scratch_path(spark, db)
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {db} LOCATION '{root}'")
    n = lay.bucket_count(o, li, bucket_bytes=1 << 20)  # small buckets: these tables are small
    orders = lay.write_hash_partitions(o, f"{db}.orders_b", "o_orderkey", n, f"{root}/orders_b")
    lines = lay.write_hash_partitions(li, f"{db}.lines_b", "l_orderkey", n, f"{root}/lines_b")
    return orders.join(lines.hint("merge"), orders["o_orderkey"] == lines["l_orderkey"]).select(
        "o_orderkey", "o_custkey", "l_linenumber", "l_extendedprice")


@register("list_partition_pruned_join", """
SELECT CAST(strftime(ts, '%Y%m%d') AS INTEGER) AS day_key, count(*) AS row_count
FROM events WHERE isodow(ts) = 1 GROUP BY 1
""")
def list_partition_pruned_join(spark, sf):
    """Events of Mondays: a filter on the day table prunes the events' day
    folders while the query runs."""
    ev = _t(spark, sf, "events").withColumn("day_key", F.date_format("ts", "yyyyMMdd").cast("int"))
    path, days_path = scratch_path(spark, "events_by_day"), scratch_path(spark, "days")
    lay.write_list_partitions(ev.where("day_key IS NOT NULL"), path, "day_key")
    td.day_dimension(td.bounds_of(ev, "ts")).write.parquet(days_path)
    events, days = spark.read.parquet(path), spark.read.parquet(days_path)
    mondays = days.where("day_of_week_id = 1").select(F.col("day_id").alias("day_key"))
    return events.join(mondays, "day_key").groupBy("day_key").agg(F.count(F.lit(1)).alias("row_count"))


@register("columnar_from_view", "SELECT * FROM orders")
def columnar_from_view(spark, sf):
    """An empty columnar table shaped like a view, then loaded from it."""
    db = unique_name("columnar")
    root = scratch_path(spark, db)
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {db} LOCATION '{root}'")
    view = f"orders_view_{db}"
    _t(spark, sf, "orders").createOrReplaceTempView(view)
    lay.create_columnar_table(spark, view, f"{db}.orders_c", f"{root}/orders_c")
    lay.append_rows(spark.table(view), f"{db}.orders_c")
    return spark.table(f"{db}.orders_c")


@register("columnar_partition", "SELECT * FROM orders")
def columnar_partition(spark, sf):
    """A columnar table partitioned by order status, loaded in two runs; each
    run replaces only the partitions it writes."""
    db = unique_name("colpart")
    root = scratch_path(spark, db)
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {db} LOCATION '{root}'")
    o = _t(spark, sf, "orders")
    lay.create_partitioned_table(spark, o, f"{db}.orders_p", f"{root}/orders_p", "o_orderstatus")
    first = F.col("o_orderstatus") == F.lit("F")
    lay.write_partition(o.where(first), f"{db}.orders_p")
    # the second load replaces only the partitions it holds
    lay.write_partition(o.where(~first | F.col("o_orderstatus").isNull()), f"{db}.orders_p")
    return spark.table(f"{db}.orders_p").select(*o.columns)


@register("clustered_layout", "SELECT * FROM lineitem")
def clustered_layout(spark, sf):
    path = scratch_path(spark, "lineitem_by_shipdate")
    lay.write_search_layout(_t(spark, sf, "lineitem"), path, column_names=["l_shipdate"], replace=True)
    return spark.read.parquet(path)


@register("fk_layout", """
SELECT l_orderkey AS order_fk, l_partkey AS part_fk, l_suppkey AS supplier_fk, l_linenumber, l_quantity,
       l_extendedprice, l_discount, l_tax, l_returnflag, l_linestatus, l_shipdate FROM lineitem
""")
def fk_layout(spark, sf):
    li = _t(spark, sf, "lineitem").withColumnsRenamed(
        {"l_orderkey": "order_fk", "l_partkey": "part_fk", "l_suppkey": "supplier_fk"})
    path = scratch_path(spark, "lineitem_fk_layout")
    lay.write_foreign_key_layout(li, path)
    return spark.read.parquet(path)


_FKS = {"order_fk": "l_orderkey", "part_fk": "l_partkey", "supplier_fk": "l_suppkey"}


@register("fk_layout_skips", " UNION ALL ".join(
    f"SELECT '{fk}' AS foreign_key, count(DISTINCT {c}) AS keys, true AS most_files_skipped FROM lineitem"
    for fk, c in _FKS.items()))
def fk_layout_skips(spark, sf):
    """For each of three foreign keys: over all of its values, the files whose
    range holds the value are fewer than six in ten."""
    li = _t(spark, sf, "lineitem").withColumnsRenamed({c: fk for fk, c in _FKS.items()})
    path = scratch_path(spark, "lineitem_fk_files")
    lay.write_foreign_key_layout(li, path, files=64)
    back = spark.read.parquet(path)
    ranges = back.groupBy(F.col("_metadata.file_path").alias("file")).agg(*[
        agg(fk).alias(f"{fk}_{end}") for fk in _FKS for end, agg in (("low", F.min), ("high", F.max))])
    spans = ranges.select(F.explode(F.array(*[F.struct(
        F.lit(fk).alias("foreign_key"), F.col(f"{fk}_low").alias("low"), F.col(f"{fk}_high").alias("high")) for fk in _FKS])).alias("s")).select("s.*")
    keys = back.select(F.explode(F.array(*[F.struct(F.lit(fk).alias("foreign_key"), F.col(fk).alias("key")) for fk in _FKS])).alias("k")) \
        .select("k.*").where("key IS NOT NULL").distinct()
    # one span per key and file written: 192 rows at any size of the table
    held = (keys.join(F.broadcast(spans), "foreign_key").where("key BETWEEN low AND high")
            .groupBy("foreign_key").agg(F.count(F.lit(1)).alias("met")))
    held = keys.groupBy("foreign_key").agg(F.count(F.lit(1)).alias("keys")).join(held, "foreign_key").withColumn(
        "files", F.col("met") / F.col("keys"))
    total = ranges.agg(F.count(F.lit(1))).scalar()
    return held.select("foreign_key", "keys", (F.col("files") < 0.6 * total).alias("most_files_skipped"))


@register("hash_layout_lookup", """
SELECT 'present' AS asked, count(*) AS rows_found, true AS read_as_expected FROM documents
WHERE text = (SELECT min(text) FROM documents)
UNION ALL SELECT 'absent', 0, true
""")
def hash_layout_lookup(spark, sf):
    """Bloom filters on whole texts: a lookup of a text that is there reads the
    row groups that have it, of one that is not (though within the range) none."""
    path = scratch_path(spark, "documents_by_text")
    lay.write_search_layout(_t(spark, sf, "documents"), path, column_names=["text"], method="hash", replace=True)
    back = spark.read.parquet(path)
    there = back.agg(F.min("text")).first()[0]
    rows = []
    for asked, text in (("present", there), ("absent", (there or "") + " not there")):
        found = back.where(F.col("text") == text)
        read, n = scans.rows_read(found.select("doc_id", "text")), found.count()
        rows.append((asked, n, read >= n if asked == "present" else read == 0))
    return spark.createDataFrame(rows, "asked string, rows_found long, read_as_expected boolean")


def _layout_copy(spark, sf, name: str, **options) -> DataFrame:
    path = scratch_path(spark, name)
    lay.write_search_layout(_t(spark, sf, "orders"), path, replace=True, **options)
    return spark.read.parquet(path)


@register("brin_layout", "SELECT * FROM orders WHERE o_totalprice BETWEEN 1000 AND 50000")
def brin_layout(spark, sf):
    """Block ranges on the price: the range filter is pushed into the scan."""
    return _layout_copy(spark, sf, "orders_brin", column_names=["o_totalprice"], method="brin").where(
        "o_totalprice BETWEEN 1000 AND 50000")


@register("expression_layout", "SELECT *, year(o_orderdate) AS order_year FROM orders WHERE year(o_orderdate) = 1997")
def expression_layout(spark, sf):
    """Sorted by a derived key, which lookups filter on."""
    return _layout_copy(spark, sf, "orders_by_year", expression="cast(year(o_orderdate) as bigint)", index_key="order_year").where(
        "order_year = 1997")


@register("unique_layout", """
SELECT 'o_orderkey' AS layout_key, count(*) = count(DISTINCT o_orderkey) AS written FROM orders
UNION ALL SELECT 'o_custkey', count(o_custkey) = count(DISTINCT o_custkey) FROM orders
""")
def unique_layout(spark, sf):
    """A unique layout is written only where the key is unique."""
    rows = []
    for key in ("o_orderkey", "o_custkey"):
        try:
            written = _layout_copy(spark, sf, f"unique_{key}", column_names=[key], unique=True).columns != []
        except ck.CheckFailed:
            written = False
        rows.append((key, written))
    return spark.createDataFrame(rows, "layout_key string, written boolean")


@register("partial_layout", "SELECT * FROM orders WHERE o_orderstatus = 'F'")
def partial_layout(spark, sf):
    """A smaller copy that holds finished orders only."""
    return _layout_copy(spark, sf, "orders_finished", column_names=["o_custkey"], partial_condition="o_orderstatus = 'F'")


@register("analyzed_layout", """
SELECT 'o_custkey' AS column_name, count(*) - count(o_custkey) AS null_count, count(*) AS row_count FROM orders
""")
def analyzed_layout(spark, sf):
    """Statistics computed after the write, read back from the catalog."""
    db = unique_name("analyzed")
    root = scratch_path(spark, db)
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {db} LOCATION '{root}'")
    lay.write_search_layout(_t(spark, sf, "orders"), f"{root}/orders", column_names=["o_custkey"], replace=True,
                            table=f"{db}.orders", analyze=True)
    return lay.analyze_table(spark, f"{db}.orders", ["o_custkey"])


@register("table_stats", " UNION ALL ".join(
    f"SELECT '{c}' AS column_name, count(*) - count({c}) AS null_count, count(*) AS row_count FROM lineitem"
    for c in ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice",
              "l_discount", "l_tax", "l_returnflag", "l_linestatus", "l_shipdate"]))
def table_stats(spark, sf):
    db = unique_name("stats")
    root = scratch_path(spark, db)
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {db} LOCATION '{root}'")
    _t(spark, sf, "lineitem").write.format("parquet").option("path", f"{root}/lineitem").saveAsTable(f"{db}.lineitem")
    return lay.analyze_table(spark, f"{db}.lineitem")


# ---------------------------------------------------------- copy / publish

STAR_SQL = """
SELECT c.c_custkey, c.c_name, n.n_name, r.r_name
FROM customer c JOIN nation n ON c.c_nationkey = n.n_nationkey JOIN region r ON n.n_regionkey = r.r_regionkey
"""


def _star(spark, db):
    c, n, r = spark.table(f"{db}.customer"), spark.table(f"{db}.nation"), spark.table(f"{db}.region")
    return (c.join(n, c.c_nationkey == n.n_nationkey).join(r, n.n_regionkey == r.r_regionkey)
            .select("c_custkey", "c_name", "n_name", "r_name"))


def _load_star(spark, sf, db, root):
    pub.create_database(spark, db, root)
    for t in ("region", "nation", "customer"):
        _t(spark, sf, t).write.format("parquet").option("path", f"{root}/{t}").saveAsTable(f"{db}.{t}")


@register("copy_schema", STAR_SQL)
def copy_schema(spark, sf):
    src, dst = unique_name("etl"), unique_name("frontend")
    _load_star(spark, sf, src, scratch_path(spark, src))
    pub.copy_database(spark, src, dst, scratch_path(spark, dst))
    return _star(spark, dst)


@register("publish_schema", STAR_SQL)
def publish_schema(spark, sf):
    live = unique_name("live")
    live_root = scratch_path(spark, live)
    for _ in range(2):
        version = unique_name("next")
        _load_star(spark, sf, version, scratch_path(spark, version))
        pub.publish(spark, live, version, live_root)
    return _star(spark, live)


@register("copy_schema_layouts", """
SELECT 'orders_p' AS table_name, count(*) AS row_count, 'o_orderstatus' AS partitions, 0 AS buckets FROM orders
UNION ALL SELECT 'orders_b', count(*), '', 8 FROM orders
""")
def copy_schema_layouts(spark, sf):
    """A partitioned and a bucketed table copied over an older copy; the
    copies have the rows and the layout of their sources."""
    src, dst = unique_name("etl"), unique_name("frontend")
    root, target = scratch_path(spark, src), scratch_path(spark, dst)
    pub.create_database(spark, src, root)
    o = _t(spark, sf, "orders")
    lay.create_partitioned_table(spark, o, f"{src}.orders_p", f"{root}/orders_p", "o_orderstatus")
    lay.write_partition(o.where("o_orderkey % 2 = 0"), f"{src}.orders_p")
    lay.write_hash_partitions(o, f"{src}.orders_b", "o_orderkey", 8, f"{root}/orders_b")
    pub.copy_database(spark, src, dst, target)
    lay.write_partition(o, f"{src}.orders_p")
    pub.copy_database(spark, src, dst, target)
    rows = []
    for t in ("orders_p", "orders_b"):
        partitions, _, buckets, _ = pub.table_shape(spark, f"{dst}.{t}")
        rows.append(spark.table(f"{dst}.{t}").agg(F.lit(t).alias("table_name"), F.count(F.lit(1)).alias("row_count"),
                                                  F.lit(",".join(partitions)).alias("partitions"), F.lit(buckets).alias("buckets")))
    return ck.report(*rows)


@register("publish_manifest", """
SELECT 'first' AS shown, (SELECT count(*) FROM customer WHERE c_acctbal > 0) AS customers, (SELECT count(*) FROM nation WHERE n_regionkey = 1) AS nations
UNION ALL SELECT 'staged', (SELECT count(*) FROM customer WHERE c_acctbal > 0), (SELECT count(*) FROM nation WHERE n_regionkey = 1)
UNION ALL SELECT 'switched', (SELECT count(*) FROM customer), (SELECT count(*) FROM nation)
""")
def publish_manifest(spark, sf):
    """Two different versions; readers before, between and after the switch see
    one whole version each."""
    live = unique_name("shown")
    root = scratch_path(spark, live)
    customer, nation = _t(spark, sf, "customer"), _t(spark, sf, "nation")
    pub.stage_version(spark, live, root, "v1", {"customer": customer.where("c_acctbal > 0"), "nation": nation.where("n_regionkey = 1")})
    pub.switch_version(spark, live, root, "v1")

    def seen(step: str) -> tuple:
        c, n = spark.table(f"{live}.customer"), spark.table(f"{live}.nation")
        pair = c.agg(F.count(F.lit(1)).alias("c")).crossJoin(n.agg(F.count(F.lit(1)).alias("n"))).first()
        return step, pair["c"], pair["n"]
    rows = [seen("first")]
    pub.stage_version(spark, live, root, "v2", {"customer": customer, "nation": nation})
    rows.append(seen("staged"))
    pub.switch_version(spark, live, root, "v2")
    rows.append(seen("switched"))
    pub.drop_version(spark, live, "v1")
    return spark.createDataFrame(rows, "shown string, customers long, nations long")


@register("enum_long_labels", """
SELECT value, CAST(row_number() OVER (ORDER BY value) AS INTEGER) AS ordinal
FROM (SELECT DISTINCT text AS value FROM documents WHERE text IS NOT NULL)
""")
def enum_long_labels(spark, sf):
    """Labels far longer than 63 characters, some sharing long prefixes, stay whole and apart."""
    return en.create_enum(table(spark, sf, "documents"), "text")


@register("hour_of_day_events", """
SELECT CAST(h AS INTEGER) AS hour, count(e.ts) AS n_events
FROM (SELECT unnest(range(24)) AS h) LEFT JOIN (SELECT ts FROM events) e ON extract(hour FROM e.ts) = h
GROUP BY 1
""")
def hour_of_day_events(spark, sf):
    """Events per hour over all 24 rows of the hour dimension."""
    hours = td.hour_of_day(spark)
    key = hours.columns[0]
    events = table(spark, sf, "events").groupBy(F.hour("ts").alias("_h")).agg(F.count("*").alias("n"))
    return hours.join(events, F.col(key) == F.col("_h"), "left").select(
        F.col(key).cast("int").alias("hour"), F.coalesce("n", F.lit(0)).alias("n_events"))


@register("time_day_wide", """
SELECT count(*) AS days, min(d) AS first_day, max(d) AS last_day
FROM (SELECT CAST(unnest(generate_series((SELECT min(o_orderdate) FROM orders) - INTERVAL '100 years' - INTERVAL 1 DAY,
                                         (SELECT max(o_orderdate) FROM orders), INTERVAL 1 DAY)) AS DATE) AS d)
""")
def time_day_wide(spark, sf):
    """A day table of well over 30,000 days: bounds of ``orders``, a century longer."""
    span = td.bounds_of(table(spark, sf, "orders"), "o_orderdate").withColumn("start", F.add_months("start", -1200))
    return td.day_dimension(span).agg(F.count("*").alias("days"), F.min("_date").alias("first_day"),
                                      F.max("_date").alias("last_day"))
