"""What a query's file scans read, from the metrics of its own plan."""

from __future__ import annotations

from pyspark.sql import DataFrame


def rows_read(df: DataFrame) -> int:
    """Run ``df`` and count the rows that its file scans hand on: those of row
    groups that statistics and bloom filters could not rule out. For queries
    without an exchange (adaptive execution wraps the others)."""
    df._jdf.collectToPython()
    leaves = df._jdf.queryExecution().executedPlan().collectLeaves()
    total = 0
    for i in range(leaves.size()):
        metric = leaves.apply(i).metrics().get("numOutputRows")
        total += metric.get().value() if metric.isDefined() else 0
    return total
