"""Tables that are replaced as a whole (SNK3, SNK7).

A refresh writes a folder of its own below the table's path. Only when that is complete, one empty file
whose name carries a number and the folder makes it the current one, and creating a file is a single step
on every store. A reader sees the old table or the new one, never a part, a job that dies leaves the old
one in force, and a frame planned before a refresh goes on reading what it was planned on.
"""

from __future__ import annotations

import os
import re
import time
import uuid
from collections.abc import Callable

from pyspark.sql import SparkSession

MARKS = "_current"
MARK = re.compile(r"(\d+)-([0-9a-f]{32})")
FOLDER = "version-"

#: Folder and column of a stored graph's folded links.
BANDS = "bands"
WIDTH = "_width"


def _place(spark: SparkSession, path: str):
    context = spark.sparkContext
    place = context._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(context._jsc.hadoopConfiguration()), place


def _listed(spark: SparkSession, path: str) -> list:
    files, place = _place(spark, path)
    return list(files.listStatus(place)) if files.exists(place) else []


def listed(spark: SparkSession, path: str) -> list[str]:
    """Names in a folder; none where there is no such folder."""
    return sorted(s.getPath().getName() for s in _listed(spark, path))


def versions(spark: SparkSession, path: str) -> list[tuple[int, str]]:
    """Number and name of the complete versions below ``path``, oldest first."""
    found = [MARK.fullmatch(s.getPath().getName()) for s in _listed(spark, os.path.join(path, MARKS))]
    return sorted((int(m[1]), m[2]) for m in found if m)


def current_path(spark: SparkSession, path: str) -> str:
    """The folder of the current version; ``path`` itself where nothing was ever refreshed."""
    known = versions(spark, path)
    return os.path.join(path, FOLDER + known[-1][1]) if known else path


def replace(spark: SparkSession, path: str, write: Callable[[str], None]) -> str:
    """Let ``write`` fill a new folder, then make it the current version.

    What ``write`` raises goes to the caller and the version before stays in force. Of two refreshes that
    end at the same time one becomes current, whole.
    """
    name = uuid.uuid4().hex
    folder = os.path.join(path, FOLDER + name)
    write(folder)
    known = versions(spark, path)
    number = known[-1][0] + 1 if known else 0
    files, mark = _place(spark, os.path.join(path, MARKS, f"{number:012d}-{name}"))
    if not files.createNewFile(mark):
        raise FileExistsError(mark.toString())
    return folder


def prune(spark: SparkSession, path: str, keep: int = 1, idle_hours: float = 24.0) -> list[str]:
    """Delete all but the last ``keep`` versions, and folders of failed refreshes that nothing has touched
    for ``idle_hours``. For the owner of the table to call once no reader plans on an old version."""
    if keep < 1:
        raise ValueError("the current version stays")
    known = versions(spark, path)
    old = known[:-keep]
    complete = {FOLDER + name for _, name in known}
    limit = (time.time() - 3600 * idle_hours) * 1000
    dead = [
        s.getPath().getName()
        for s in _listed(spark, path)
        if s.getPath().getName().startswith(FOLDER) and s.getPath().getName() not in complete and s.getModificationTime() < limit
    ]
    for number, name in old:
        files, mark = _place(spark, os.path.join(path, MARKS, f"{number:012d}-{name}"))
        files.delete(mark, False)
    gone = [FOLDER + name for _, name in old] + dead
    for name in gone:
        files, folder = _place(spark, os.path.join(path, name))
        files.delete(folder, True)
    return gone
