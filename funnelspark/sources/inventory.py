"""Folders of many files, parsed once: a file is read again only if its size or time of change is another.

The listing names every file without opening one; it is held against the signatures of the last scan, which are committed
together with what was parsed. New and changed files are parsed, what went is dropped, the rest is kept as parsed.
"""

from __future__ import annotations

from collections.abc import Callable
from itertools import batched

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from funnelspark.sources.folders import cut
from funnelspark.sources.snapshots import Snapshots

SIGNATURE = ["path", "modificationTime", "length"]
#: Files whose paths go into one read.
CHUNK = 10_000


def listing(spark: SparkSession, folder: str, glob: str = "*") -> DataFrame:
    """path, modificationTime, length of all files below a folder; their contents aren't read."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", glob).load(folder)
    return files.select(*SIGNATURE)


def scan(store: Snapshots, folder: str, parse: Callable[[DataFrame], DataFrame], glob: str = "*") -> dict[str, int]:
    """Brings the tables ``files`` and ``parsed`` of a store up to date with a folder; how many files were read, kept and dropped.

    parse makes rows, with the column path among them, of a frame (path, content): a file may give any number of rows."""
    spark = store.spark
    now = cut(listing(spark, folder, glob), "listing")
    known = store.read("files")
    if known is None:
        changed, gone = now, None
    else:
        changed = cut(now.join(known, SIGNATURE, "left_anti"), "changed")
        gone = known.join(now.select("path"), "path", "left_anti")
    fresh = None
    for some in batched((r.path for r in changed.select("path").toLocalIterator()), CHUNK):
        rows = parse(spark.read.format("binaryFile").load(list(some)).select("path", "content"))
        rows = cut(rows, "parsed")
        fresh = rows if fresh is None else fresh.unionByName(rows)
    counts = {"read": changed.count(), "dropped": gone.count() if gone is not None else 0}
    counts["kept"] = now.count() - counts["read"]
    if counts["read"] or counts["dropped"]:
        before = store.read("parsed")
        if before is not None:
            before = before.join(now.join(changed.select("path"), "path", "left_anti").select("path"), "path", "left_semi")
        both = [x for x in (before, fresh) if x is not None]
        store.commit({"files": now, "parsed": both[0] if len(both) == 1 else both[0].unionByName(both[1])})
    return counts
