"""What the scans of a query read, from the metrics of its own plan."""

from contextlib import contextmanager

from ledgerloom.sources.scans import rows_read  # noqa: F401


@contextmanager
def plain_plans(spark):
    """Plans as they are made: adaptive execution wraps them."""
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        yield
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")


def _nodes(plan):
    stack = [plan]
    while stack:
        node = stack.pop()
        yield node
        for some in (node.children(), node.subqueries()):
            stack += [some.apply(i) for i in range(some.size())]


def bytes_exchanged(df) -> int:
    """Bytes that the exchanges of ``df``, subqueries included, hand on."""
    df._jdf.collectToPython()
    total = 0
    for node in _nodes(df._jdf.queryExecution().executedPlan()):
        if node.nodeName() == "Exchange":
            total += node.metrics().get("shuffleBytesWritten").get().value()
    return total
