"""Versions of a set of tables, of which one small file names the current one.

A refresh writes all tables into a folder of its own and publishes it last, by a commit file that can
be created only once. A reader looks up the latest commit once and reads that folder throughout; a
refresh that dies before its commit leaves the version before it as it was. A commit file without
text was cut off while written and counts as none.
"""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession

from millwright.session import create_file, names_in, remove

COMMITS, VERSIONS = "commits", "versions"


def new_version(folder: str) -> str:
    """A path for the tables of a refresh; nothing reads it until it is published."""
    return f"{folder}/{VERSIONS}/{uuid.uuid4().hex}"


def _commits(spark: SparkSession, folder: str) -> list[tuple[int, str]]:
    """(number, version name) of the commits, oldest first."""
    numbers = [name for name in names_in(spark, f"{folder}/{COMMITS}") if name.isdigit()]
    if not numbers:
        return []
    # one line a commit; expired commits are deleted with their versions
    rows = spark.read.text([f"{folder}/{COMMITS}/{name}" for name in numbers]).selectExpr("value", "_metadata.file_name AS name").collect()
    return sorted((int(r["name"]), r["value"]) for r in rows if r["value"])


def current(spark: SparkSession, folder: str) -> str | None:
    """The folder of the version published last."""
    found = _commits(spark, folder)
    return f"{folder}/{VERSIONS}/{found[-1][1]}" if found else None


def publish(spark: SparkSession, folder: str, version: str, keep: int = 2) -> None:
    """Make ``version`` the current one, and delete all but the last ``keep``.

    Of two refreshes that publish at the same time one fails. Readers of an expired version fail
    with missing files, so ``keep`` should cover the longest reader.
    """
    taken = [int(name) for name in names_in(spark, f"{folder}/{COMMITS}") if name.isdigit()]
    create_file(spark, f"{folder}/{COMMITS}/{max(taken, default=0) + 1:012d}", version.rsplit("/", 1)[1])
    for number, name in _commits(spark, folder)[:-keep]:
        remove(spark, f"{folder}/{COMMITS}/{number:012d}")
        remove(spark, f"{folder}/{VERSIONS}/{name}")
