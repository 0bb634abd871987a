"""Trees of many small files on a file system that every worker mounts (``file:``): tasks list, read and write them.

Spark's own listing, lists of paths and writers by partition keep every file on the driver and cost it or a task milliseconds
each, which is what a tree of hundreds of thousands of small files is made of. Here folders, paths and rows are dealt over the
tasks, and the driver sees counts only. Other file systems go through Spark's readers and writers (trees.py, campaign.py).
"""

from __future__ import annotations

import os
from collections import deque
from collections.abc import Callable, Iterator
from urllib.parse import quote

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from funnelspark.sources.folders import cut

#: Entries that one folder's task lists below it before it hands on the folders that are left.
WALK = 10_000
#: Files or folders a task, about.
DEALT = 2_000
#: Bytes of a batch of contents, or one file.
BATCH = 1 << 22
_LISTED = pa.schema([("path", pa.string()), ("length", pa.int64()), ("modificationTime", pa.timestamp("us", "UTC")), ("open", pa.bool_())])


def local(spark: SparkSession, path: str) -> str | None:
    """The path on the workers' mounts, or None where it is elsewhere or a pattern."""
    if path.startswith("/") and (spark.sparkContext._jsc.hadoopConfiguration().get("fs.defaultFS") or "file:").startswith("file:"):
        path = f"file:{path}"
    plain = "/" + path.removeprefix("file:").strip("/")
    return plain if path.startswith("file:/") and not set("*?[{") & set(plain) else None


def _dealt(rows: DataFrame, n: int) -> DataFrame:
    return rows.repartition(max(rows.sparkSession.sparkContext.defaultParallelism, -(-n // DEALT)))


def _hidden(name: str) -> bool:
    """As Spark's listing has it."""
    return name.startswith(".") or name.startswith("_") and "=" not in name or name.endswith("._COPYING_")


def _list(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for top in batch.column(0).to_pylist():
            rows, left = [], deque([top.removeprefix("file:")])
            while left and len(rows) < WALK:
                with os.scandir(left.popleft()) as entries:
                    for e in entries:
                        if _hidden(e.name):
                            continue
                        if e.is_dir():
                            left.append(e.path)
                        else:
                            try:
                                s = e.stat()
                            except FileNotFoundError:  # a link to nowhere
                                continue
                            rows.append((f"file:{e.path}", s.st_size, s.st_mtime_ns // 1_000_000 * 1000, False))
                        if len(rows) > 2 * WALK:  # one wide folder
                            yield _batch(rows)
                            rows = []
                if len(left) > WALK:
                    break
            yield _batch(rows + [(f"file:{d}", None, None, True) for d in left])


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) or [[]] * len(_LISTED)
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, _LISTED, strict=True)], schema=_LISTED)


def listed(spark: SparkSession, folder: str) -> DataFrame:
    """path, length, modificationTime of every file below a mounted folder, in rounds over the folders still open."""
    level, n, out = spark.createDataFrame([(f"file:{folder}",)], "path string"), 1, None
    while n:
        found = cut(_dealt(level, n).mapInArrow(_list, "path string, length long, modificationTime timestamp, open boolean"), "listing")
        files, level = found.filter("not open").drop("open"), found.filter("open").select("path")
        out = files if out is None else out.unionByName(files)
        n = level.count()
    return out


def _reader(at: int) -> Callable:
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            first, held, size = 0, [], 0
            for i, path in enumerate(batch.column(at).to_pylist()):
                with open(path.removeprefix("file:"), "rb") as f:
                    held.append(f.read())
                size += len(held[-1])
                if size >= BATCH or i + 1 == batch.num_rows:
                    part = batch.slice(first, i + 1 - first)
                    yield pa.RecordBatch.from_arrays([*part.columns, pa.array(held, pa.binary())], [*part.schema.names, "content"])
                    first, held, size = i + 1, [], 0

    return read


def contents(files: DataFrame) -> DataFrame:
    """files (mounted, by ``path``) with ``content``, read by the tasks that the rows are dealt over."""
    files = cut(files, "files")
    fields = ", ".join(f"`{c}` {kind}" for c, kind in files.dtypes)
    return _dealt(files, files.count()).mapInArrow(_reader(files.columns.index("path")), f"{fields}, content binary")


def write_text(rows: DataFrame, folder: str, parts: list[str], value: str) -> None:
    """A text file a row in the folder that its parts name (``part=value/``, no two rows in one), under a mounted folder.

    A file gets its name when it is whole, so a task that runs again writes the same."""

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n = 0
        for batch in batches:
            *keys, texts = batch.columns
            for i, text in enumerate(texts.to_pylist()):
                values = ("__HIVE_DEFAULT_PARTITION__" if (v := k[i].as_py()) is None else quote(str(v), safe=" +,-.@") for k in keys)
                at = os.path.join(folder, *(f"{p}={v}" for p, v in zip(parts, values, strict=True)))
                os.makedirs(at, exist_ok=True)
                own = f"{at}/.{os.getpid()}"
                with open(own, "w", encoding="utf-8") as f:
                    f.write(f"{text}\n")
                os.replace(own, f"{at}/part-0.txt")
            n += batch.num_rows
        yield pa.RecordBatch.from_arrays([pa.array([n], pa.int64())], ["n"])

    os.makedirs(folder, exist_ok=True)
    rows = rows.select(*parts, F.col(value).cast("string"))
    _dealt(rows, rows.count()).mapInArrow(write, "n long").agg(F.sum("n")).collect()
