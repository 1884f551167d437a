"""Data checks as set-based Spark plans.

Every check returns a one-row DataFrame with the common report schema
``(check_name, passed, left_value, right_value, detail)``; several checks are
combined with :func:`report` and turned into an exception by :func:`enforce`.
Queries passed to a check are DataFrames or SQL texts (run in the active
session; the text is then part of ``detail``). Scalar ones are read through
scalar subqueries, which fail when a query yields more than one row and give
NULL when it yields none.

Cost at scale: expression checks of one table share a single aggregate pass
(:func:`check_expressions`); key checks need one shuffle each (of hashes
first where the key is wide), failing rows are counted and sampled in one pass
(:func:`check_not_found`, which therefore runs when called), and foreign keys
pre-aggregate the child's key column before joining, so a key that
holds a third of all rows travels as one row per task.
"""

from __future__ import annotations

import operator

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerloom.functions.text import row_text
from ledgerloom.operators.attributes import quote_name

REPORT_SCHEMA = T.StructType([
    T.StructField("check_name", T.StringType(), False),
    T.StructField("passed", T.BooleanType(), True),
    T.StructField("left_value", T.DoubleType(), True),
    T.StructField("right_value", T.DoubleType(), True),
    T.StructField("detail", T.StringType(), True),
])

# The comparison operators a relation check accepts.
RELATIONS = {
    "=": operator.eq, "!=": operator.ne, "<>": operator.ne,
    "<": operator.lt, "<=": operator.le, ">": operator.gt, ">=": operator.ge,
}
# Fixed value: how many failing rows a not-found message shows.
FAILING_ROWS_SHOWN = 20


class CheckFailed(AssertionError):
    """Raised by :func:`enforce` with the failing report rows."""


def _frame(query: DataFrame | str) -> DataFrame:
    """A query given as SQL text, or the DataFrame itself."""
    return SparkSession.active().sql(query) if isinstance(query, str) else query


def _with_texts(text: str | None, **queries: DataFrame | str) -> str | None:
    """``text`` followed by a line for each query given as SQL text."""
    lines = [f"{name}: {q.strip()}" for name, q in queries.items() if isinstance(q, str)]
    return "\n".join(([text] if text else []) + lines) or None


def _scalar(query: DataFrame) -> Column:
    if len(query.columns) != 1:
        query = query.select(query.columns[0])
    return query.scalar()


def _row(spark: SparkSession, name: str, passed: Column, left: Column | None = None,
         right: Column | None = None, detail: Column | str | None = None) -> DataFrame:
    none = F.lit(None).cast("double")
    det = F.lit(detail) if isinstance(detail, str) or detail is None else detail
    return spark.range(1).select(
        F.lit(name).alias("check_name"),
        passed.cast("boolean").alias("passed"),
        (none if left is None else left.cast("double")).alias("left_value"),
        (none if right is None else right.cast("double")).alias("right_value"),
        det.cast("string").alias("detail"),
    )


def check_true(name: str, query: DataFrame | str, description: str | None = None) -> DataFrame:
    """Passes when the one-value query is true; NULL (or no row) stays NULL and
    does not fail, as in the original toolkit."""
    asked = _frame(query)
    return _row(asked.sparkSession, name, _scalar(asked), detail=_with_texts(description, query=query))


def check_relation(name: str, left: DataFrame | str, right: DataFrame | str, relation: str,
                   description: str | None = None) -> DataFrame:
    """``left <relation> right`` for two one-value queries. A NULL operand fails."""
    if relation not in RELATIONS:
        raise ValueError(f"relation must be one of {sorted(RELATIONS)}")
    text = _with_texts(description or f"left {relation} right", left=left, right=right)
    left, right = _frame(left), _frame(right)
    pair = left.sparkSession.range(1).select(_scalar(left).alias("l"), _scalar(right).alias("r"))
    l, r = F.col("l"), F.col("r")
    null = l.isNull() | r.isNull()
    return pair.select(
        F.lit(name).alias("check_name"),
        F.when(null, F.lit(False)).otherwise(RELATIONS[relation](l, r)).alias("passed"),
        l.cast("double").alias("left_value"),
        r.cast("double").alias("right_value"),
        F.when(null, F.lit(f"NULL operand: {text}")).otherwise(F.lit(text)).alias("detail"),
    )


def check_equal(name: str, left: DataFrame | str, right: DataFrame | str, description: str | None = None) -> DataFrame:
    return check_relation(name, left, right, "=", description)


def check_not_equal(name: str, left: DataFrame | str, right: DataFrame | str, description: str | None = None) -> DataFrame:
    return check_relation(name, left, right, "!=", description)


def check_at_most(name: str, left: DataFrame | str, right: DataFrame | str, description: str | None = None) -> DataFrame:
    """left <= right"""
    return check_relation(name, left, right, "<=", description)


def check_at_least(name: str, left: DataFrame | str, right: DataFrame | str, description: str | None = None) -> DataFrame:
    """left >= right"""
    return check_relation(name, left, right, ">=", description)


def check_almost_equal(name: str, fraction: float, left: DataFrame | str, right: DataFrame | str,
                       description: str | None = None) -> DataFrame:
    """``|right - left| / |left| < fraction`` (strict); a zero ``left`` passes
    for any positive fraction; a NULL operand fails. Pass decimals for money:
    double sums depend on summation order."""
    text = _with_texts(description or f"relative difference < {fraction}", left=left, right=right)
    left, right = _frame(left), _frame(right)
    pair = left.sparkSession.range(1).select(_scalar(left).alias("l"), _scalar(right).alias("r"))
    l, r = F.col("l"), F.col("r")
    null = l.isNull() | r.isNull()
    rel = F.coalesce(F.abs((r - l) / F.nullif(l, F.lit(0))), F.lit(0))
    return pair.select(
        F.lit(name).alias("check_name"),
        F.when(null, F.lit(False)).otherwise(rel < F.lit(fraction)).alias("passed"),
        l.cast("double").alias("left_value"),
        r.cast("double").alias("right_value"),
        F.when(null, F.lit(f"NULL operand: {text}")).otherwise(F.lit(text)).alias("detail"),
    )


def failing_rows(failing: DataFrame, order_by: list[str] | None = None,
                 shown: int = FAILING_ROWS_SHOWN) -> tuple[int, list[str]]:
    """``(number of rows, the first of them as text)``, in one pass.

    An observation counts the rows on their way into a bounded top-k, so the
    rows are read once, and each task hands on at most ``shown`` of them."""
    # map columns cannot be ordered; the others still fix which rows are shown
    orderable = [f.name for f in failing.schema.fields if not isinstance(f.dataType, T.MapType)]
    if order_by or orderable:
        order = [F.col(quote_name(c)).asc_nulls_first() for c in (order_by or orderable)]
    else:  # nothing orderable: order by the printed row
        order = [row_text(failing.columns).asc_nulls_first()]
    seen = Observation()
    counted = failing.observe(seen, F.count(F.lit(1)).alias("n"))
    lines = [r["line"] for r in counted.orderBy(*order).limit(shown).select(row_text(failing.columns).alias("line")).collect()]
    return (seen.get["n"] if lines else 0), lines


def check_not_found(name: str, failing: DataFrame | str, order_by: list[str] | None = None,
                    shown: int = FAILING_ROWS_SHOWN) -> DataFrame:
    """Passes when ``failing`` is empty. ``left_value`` counts the failing
    rows; ``detail`` lists the first ``shown`` of them (ordered by
    ``order_by``, default all columns, NULLs first) as ``k = v, k = v`` lines.

    The check runs when it is called (see :func:`failing_rows`); the report
    row it returns holds the outcome."""
    asked, failing = _with_texts(None, query=failing), _frame(failing)
    n, lines = failing_rows(failing, order_by, shown)
    detail = "\n".join(([asked] if asked else []) + lines) if n else None
    return failing.sparkSession.createDataFrame([(name, n == 0, float(n), 0.0, detail)], REPORT_SCHEMA)


def check_almost_equal_array(name: str, left: DataFrame | str, right: DataFrame | str, delta: float,
                             description: str | None = None) -> DataFrame:
    """Arrays compared element by element: an element fails when
    ``|left - right| > delta``. Positions beyond the shorter array are not
    counted. ``left_value`` = failing elements, ``right_value`` = delta."""
    description = _with_texts(description, left=left, right=right)
    left, right = _frame(left), _frame(right)
    pair = left.sparkSession.range(1).select(
        _scalar(left).cast("array<double>").alias("a"), _scalar(right).cast("array<double>").alias("b"))
    diffs = F.zip_with(F.col("a"), F.col("b"), lambda x, y: x - y)
    n_err = F.size(F.filter(diffs, lambda d: F.abs(d) > F.lit(delta)))
    null = F.col("a").isNull() | F.col("b").isNull()
    return pair.select(
        F.lit(name).alias("check_name"),
        F.when(null, F.lit(False)).otherwise(n_err == 0).alias("passed"),
        F.when(null, F.lit(None)).otherwise(n_err).cast("double").alias("left_value"),
        F.lit(float(delta)).alias("right_value"),
        F.lit(description).cast("string").alias("detail"),
    )


#: Bits of the map that tells which keys' hashes occur twice, and of one of its words.
SUSPECT_BITS, WORD_BITS = 1 << 20, 64


def _wide(df: DataFrame) -> bool:
    """Whether a key of these columns is larger than its 64-bit hash by much."""
    sizes = {"tinyint": 1, "smallint": 2, "int": 4, "date": 4, "float": 4, "boolean": 1}
    fixed = {"bigint": 8, "double": 8, "timestamp": 8, "timestamp_ntz": 8}
    known = [{**sizes, **fixed}.get(f.dataType.simpleString()) for f in df.schema.fields]
    return None in known or sum(known) > 16


def _repeated(keyed: DataFrame, two_pass: bool | None, null_too: bool) -> DataFrame:
    """The distinct keys (all columns of ``keyed``) that occur twice or more
    or, with ``null_too``, hold a null.

    In two passes: hashes are counted first, eight bytes a key and task. Those
    counted twice set bits of a map of ``SUSPECT_BITS``, and only rows whose
    hash meets a set bit exchange their key, which is then counted exactly. A
    key without repeats moves its hashes alone."""
    cols = [quote_name(c) for c in keyed.columns]
    null = F.lit(False)
    for c in cols:
        null = null | F.col(c).isNull()
    counted = lambda df: df.groupBy(*cols).agg(F.count(F.lit(1)).alias("_n")).where(
        (F.col("_n") > 1) | null if null_too else F.col("_n") > 1)
    if not (_wide(keyed) if two_pass is None else two_pass):
        return counted(keyed)
    h = F.xxhash64(*cols)
    hashes = keyed.groupBy(h.alias("_h")).agg(F.count(F.lit(1)).alias("_n"), F.max(null).alias("_null"))
    place = F.pmod(F.col("_h"), F.lit(SUSPECT_BITS)).cast("int")
    words = hashes.where((F.col("_n") > 1) | F.col("_null") if null_too else F.col("_n") > 1).select(
        (place / WORD_BITS).cast("int").alias("w"),
        F.call_function("shiftleft", F.lit(1).cast("long"), F.pmod(place, F.lit(WORD_BITS))).alias("bits"))
    # every word of the map, those without a suspect as zero, in order
    empty = keyed.sparkSession.range(SUSPECT_BITS // WORD_BITS).select(F.col("id").cast("int").alias("w"), F.lit(0).cast("long").alias("bits"))
    dense = words.groupBy("w").agg(F.bit_or("bits").alias("bits")).unionByName(empty).groupBy("w").agg(F.bit_or("bits").alias("bits"))
    suspects = dense.agg(F.array_sort(F.collect_list(F.struct("w", "bits"))).getField("bits").alias("a")).scalar()
    mine = F.pmod(h, F.lit(SUSPECT_BITS)).cast("int")
    word = F.get(suspects, (mine / WORD_BITS).cast("int"))
    return counted(keyed.where(F.getbit(word, F.pmod(mine, F.lit(WORD_BITS))) == 1))


def check_primary_key(name: str, df: DataFrame, table: str | None = None,
                      columns: list[str] | None = None, two_pass: bool | None = None) -> DataFrame:
    """Key columns (default ``<table>_id``) are never NULL and unique.
    ``left_value`` = number of offending keys (duplicated or NULL). Wide keys
    are checked in two passes, hashes first (``two_pass`` overrides)."""
    if columns is None:
        if table is None:
            raise ValueError("give the key columns or the table name")
        columns = [f"{table}_id"]
    offending = _repeated(df.select(*[F.col(quote_name(c)) for c in columns]), two_pass, null_too=True)
    n = offending.agg(F.count(F.lit(1))).scalar()
    return _row(df.sparkSession, name, n == 0, n, F.lit(0), f"primary key ({', '.join(columns)})")


def check_foreign_key(name: str, child: DataFrame, column: str, parent: DataFrame,
                      parent_column: str) -> DataFrame:
    """Every non-NULL ``child.column`` exists in ``parent.parent_column``.
    ``left_value`` = orphan rows, ``right_value`` = distinct orphan keys."""
    keys = (
        child.where(F.col(column).isNotNull())
        .groupBy(F.col(column).alias("_k")).agg(F.count(F.lit(1)).alias("_rows"))
    )
    # distinct (combined map-side): a parent key that repeats is one row
    parents = parent.select(F.col(parent_column).alias("_p")).where(F.col("_p").isNotNull()).distinct()
    # A left outer join + IS NULL rather than a left anti join: the optimizer
    # pushes an anti join below the aggregate, which would shuffle every child
    # row for the join instead of one row per key and task.
    orphans = keys.join(parents, F.col("_k") == F.col("_p"), "left").where(F.col("_p").isNull())
    stats = orphans.agg(F.struct(F.coalesce(F.sum("_rows"), F.lit(0)).alias("rows"),
                                 F.count(F.lit(1)).alias("keys"))).scalar()
    spark = child.sparkSession
    pair = spark.range(1).select(stats.alias("s"))
    rows, nkeys = F.col("s.rows"), F.col("s.keys")
    return pair.select(
        F.lit(name).alias("check_name"),
        (rows == 0).alias("passed"),
        rows.cast("double").alias("left_value"),
        nkeys.cast("double").alias("right_value"),
        F.lit(f"{column} -> {parent_column}").alias("detail"),
    )


def check_foreign_key_by_name(name: str, child: DataFrame, parent: DataFrame, target: str) -> DataFrame:
    """Naming convention: ``<target>_fk`` in the child refers to ``<target>_id``."""
    return check_foreign_key(name, child, f"{target}_fk", parent, f"{target}_id")


def check_expressions(df: DataFrame, checks: dict[str, Column | str]) -> DataFrame:
    """Named boolean expressions over one table, all in a single scan.

    A row violates a check when the expression is false; NULL passes, as in
    a SQL CHECK constraint. ``left_value`` = violating rows."""
    names = list(checks)
    if not names:
        return df.sparkSession.createDataFrame([], REPORT_SCHEMA)
    exprs = [F.expr(e) if isinstance(e, str) else e for e in checks.values()]
    counts = df.agg(*[F.count_if(~e).alias(f"_c{i}") for i, e in enumerate(exprs)])
    rows = F.array(*[
        F.struct(F.lit(nm).alias("check_name"), F.col(f"_c{i}").alias("n"),
                 F.lit(str(checks[nm])).alias("detail"))
        for i, nm in enumerate(names)
    ])
    return counts.select(F.inline(rows)).select(
        "check_name", (F.col("n") == 0).alias("passed"), F.col("n").cast("double").alias("left_value"),
        F.lit(0.0).alias("right_value"), "detail")


def check_aggregates(df: DataFrame, checks: dict[str, Column | tuple]) -> DataFrame:
    """Scalar checks over one table in a single aggregate pass.

    Each check is either a boolean aggregate (``F.min('x') > 0``; NULL does
    not fail, as in :func:`check_true`) or a ``(left, relation, right)``
    tuple of aggregates (as in :func:`check_relation`: a NULL operand fails),
    or ``("almost", fraction, left, right)`` (as :func:`check_almost_equal`).
    Running ten checks against one table reads it once instead of ten times.
    """
    names = list(checks)
    if not names:
        return df.sparkSession.createDataFrame([], REPORT_SCHEMA)
    aggs, rows = [], []
    for i, nm in enumerate(names):
        c = checks[nm]
        if isinstance(c, tuple) and len(c) == 4 and c[0] == "almost":
            _, frac, left, right = c
            aggs += [left.alias(f"_l{i}"), right.alias(f"_r{i}")]
            l, r = F.col(f"_l{i}"), F.col(f"_r{i}")
            rel = F.coalesce(F.abs((r - l) / F.nullif(l, F.lit(0))), F.lit(0))
            passed = F.when(l.isNull() | r.isNull(), F.lit(False)).otherwise(rel < F.lit(frac))
            rows.append((nm, passed, l, r, f"relative difference < {frac}"))
        elif isinstance(c, tuple):
            left, relation, right = c
            if relation not in RELATIONS:
                raise ValueError(f"relation must be one of {sorted(RELATIONS)}")
            aggs += [left.alias(f"_l{i}"), right.alias(f"_r{i}")]
            l, r = F.col(f"_l{i}"), F.col(f"_r{i}")
            passed = F.when(l.isNull() | r.isNull(), F.lit(False)).otherwise(RELATIONS[relation](l, r))
            rows.append((nm, passed, l, r, f"left {relation} right"))
        else:
            aggs.append(c.alias(f"_b{i}"))
            rows.append((nm, F.col(f"_b{i}"), None, None, None))
    none = F.lit(None).cast("double")
    structs = [
        F.struct(F.lit(nm).alias("check_name"), p.cast("boolean").alias("passed"),
                 (none if l is None else l.cast("double")).alias("left_value"),
                 (none if r is None else r.cast("double")).alias("right_value"),
                 F.lit(d).cast("string").alias("detail"))
        for nm, p, l, r, d in rows
    ]
    return df.agg(*aggs).select(F.inline(F.array(*structs)))


def check_unique(name: str, df: DataFrame, keys: list[Column | str], where: Column | str | None = None,
                 two_pass: bool | None = None) -> DataFrame:
    """Uniqueness of key columns or expressions, optionally among rows matching
    ``where``. A text key that names a column is that column, else an
    expression. Rows with a NULL key part are exempt, as in a unique index.
    ``left_value`` = duplicated keys. Wide keys are checked in two passes."""
    d = df if where is None else df.where(F.expr(where) if isinstance(where, str) else where)
    key = lambda k: k if not isinstance(k, str) else F.col(quote_name(k)) if k in df.columns else F.expr(k)
    keyed = d.select(*[key(k).alias(f"_k{i}") for i, k in enumerate(keys)])
    for i in range(len(keys)):
        keyed = keyed.where(F.col(f"_k{i}").isNotNull())
    n = _repeated(keyed, two_pass, null_too=False).agg(F.count(F.lit(1))).scalar()
    return _row(df.sparkSession, name, n == 0, n, F.lit(0), "unique")


def report(*results: DataFrame) -> DataFrame:
    """All check rows in one DataFrame."""
    if not results:
        raise ValueError("report() needs at least one check result")
    out = results[0]
    for r in results[1:]:
        out = out.unionByName(r)
    return out


def enforce(results: DataFrame, strict: bool = False) -> DataFrame:
    """Raise :class:`CheckFailed` when a check failed (or, if ``strict``, is
    NULL). The report holds one row per check, so collecting it is cheap."""
    rows = results.collect()
    bad = [r for r in rows if r["passed"] is False or (strict and r["passed"] is None)]
    if bad:
        lines = [f"{r['check_name']}: left={r['left_value']} right={r['right_value']}"
                 + (f"\n{r['detail']}" if r["detail"] else "") for r in bad]
        raise CheckFailed("checks failed:\n" + "\n".join(lines))
    return results
