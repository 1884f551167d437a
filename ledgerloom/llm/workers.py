"""Makes this package importable in Spark's Python workers, and holds what they keep."""

from __future__ import annotations

import os
import shutil
import tempfile
from collections.abc import Callable, Hashable
from typing import Any

from pyspark.sql import DataFrame

import ledgerloom

_DONE: set[str] = set()
_KEPT: dict[Hashable, Any] = {}


def ready(df: DataFrame) -> DataFrame:
    """Ship the package's source with the application, once; returns ``df``."""
    sc = df.sparkSession.sparkContext
    if sc.applicationId not in _DONE:
        package = os.path.dirname(os.path.abspath(ledgerloom.__file__))
        folder = tempfile.mkdtemp(prefix="ledgerloom-")
        made = shutil.make_archive(os.path.join(folder, "ledgerloom_src"), "zip",
                                   os.path.dirname(package), os.path.basename(package))
        sc.addPyFile(made)
        _DONE.add(sc.applicationId)
    return df


def kept(key: Hashable, make: Callable[[], Any]) -> Any:
    """What ``make`` made for ``key`` earlier in this worker process. A process
    keeps one such thing: what another operator has left there goes first."""
    if key not in _KEPT:
        release()
        _KEPT[key] = make()
    return _KEPT[key]


def release() -> None:
    """Drop what operators have left in this worker process, before a task that needs much memory itself."""
    _KEPT.clear()
