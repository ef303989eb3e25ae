"""Small files that make publishing safe: numbered commits, and lists of what was replaced."""

from __future__ import annotations

import time
import uuid
from collections.abc import Sequence

from pyspark.sql import SparkSession

from ..scratch import create_new, entries, read_text, remove_dir, write_text

# Seconds that a replaced directory stays for queries that were planned before.
GRACE = 24 * 3600.0


def committed(spark: SparkSession, log: str) -> list[str]:
    """The lines of a log folder in their order, without those that are being written."""
    lines = [read_text(spark, f"{log}/{name}") for name in sorted(entries(spark, log)) if name.isdigit()]
    return [line for line in lines if line]


def commit(spark: SparkSession, log: str, entry: str) -> int:
    """Append a line of text to a log folder as its next numbered file; gives the number.

    A number belongs to whoever creates its file first. The loser takes the next one, so
    entries of writers at the same time are all kept, in one order that everybody sees.
    """
    while True:
        number = max((int(n) for n in entries(spark, log) if n.isdigit()), default=0) + 1
        path = f"{log}/{number:020d}"
        if create_new(spark, path):
            write_text(spark, path, entry)
            return number


def retire(spark: SparkSession, root: str, paths: Sequence[str]) -> None:
    """Note that directories have been replaced just now."""
    if paths:
        now = int(time.time() * 1000)
        write_text(spark, f"{root.rstrip('/')}/retired/{now}-{uuid.uuid4().hex}", "\n".join(paths))


def clean_up(spark: SparkSession, root: str, grace: float = GRACE) -> list[str]:
    """Delete what was replaced more than ``grace`` seconds ago; gives the directories."""
    folder, gone = f"{root.rstrip('/')}/retired", []
    limit = time.time() * 1000 - grace * 1000
    for name in entries(spark, folder):
        if name[0].isdigit() and int(name.partition("-")[0]) <= limit:
            paths = read_text(spark, f"{folder}/{name}").splitlines()
            for path in paths:
                remove_dir(spark, path)
            remove_dir(spark, f"{folder}/{name}")
            gone += paths
    return gone
