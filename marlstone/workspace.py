"""Shared folder for written intermediates, table snapshots and stream state.

The folder is the one the cluster names in ``spark.checkpoint.dir``: every
executor sees it and it outlives an executor. A private folder is made only for
a local master with that setting absent, as in tests.
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

_local_folders: dict[str, str] = {}
#: Paths of each application: first those made outside any scope, then those of the open scopes, the innermost last.
_paths: dict[str, list[list[str]]] = {}
#: Paths of what ``stored`` has made, per application and key.
_stored: dict[tuple, str] = {}


def shared_folder(spark: SparkSession) -> str:
    context = spark.sparkContext
    named = spark.conf.get("spark.checkpoint.dir", None) or context.getConf().get("spark.checkpoint.dir")
    if named:
        return named.rstrip("/")
    if not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that every executor can reach")
    app = context.applicationId
    if app not in _local_folders:
        _local_folders[app] = tempfile.mkdtemp(prefix="marlstone-")
    return _local_folders[app]


def scratch(spark: SparkSession, label: str) -> str:
    """A new, unused path below the shared folder. It belongs to the innermost open scope."""
    path = f"{shared_folder(spark)}/{label}-{uuid.uuid4().hex}"
    _paths.setdefault(spark.sparkContext.applicationId, [[]])[-1].append(path)
    return path


def state_of(spark: SparkSession, path: str) -> str:
    """Names, sizes and times of the files at ``path``, as one string: it changes when the data there do."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    files = target.getFileSystem(spark._jsc.hadoopConfiguration()).listStatus(target)
    return ";".join(sorted(f"{f.getPath().getName()}:{f.getLen()}:{f.getModificationTime()}" for f in files))


def stored(spark: SparkSession, key: tuple, label: str, make: Callable[[str], object]) -> str:
    """The path where ``make(path)`` has stored something for ``key``. It is made again when the key is new, or the scope that owned it has ended."""
    app = spark.sparkContext.applicationId
    if (app, key) not in _stored:
        path = scratch(spark, label)
        make(path)
        _stored[app, key] = path
    return _stored[app, key]


def _delete(spark: SparkSession, paths: list[str]) -> int:
    for key in [k for k, path in _stored.items() if path in paths]:
        del _stored[key]
    hadoop = spark._jvm.org.apache.hadoop.fs
    for path in paths:
        target = hadoop.Path(path)
        target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)
    return len(paths)


@contextmanager
def scope(spark: SparkSession) -> Iterator[None]:
    """Own every path made inside: intermediates, table snapshots and stream folders go when the block ends.

    Store or collect results inside it. Paths of other callers stay.
    """
    stack = _paths.setdefault(spark.sparkContext.applicationId, [[]])
    own: list[str] = []
    stack.append(own)
    try:
        yield
    finally:
        stack[:] = [paths for paths in stack if paths is not own]
        _delete(spark, own)


def temp_view(df: DataFrame, label: str) -> str:
    """Register ``df`` under a name no other caller has, and return the name."""
    name = f"{label}_{uuid.uuid4().hex}"
    df.createOrReplaceTempView(name)
    return name


def written(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` once and read it back: cuts lineage, survives executor loss."""
    spark = df.sparkSession
    path = scratch(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def drop_intermediates(spark: SparkSession) -> int:
    """Delete the paths made outside any scope. Call it when the results that read from them are stored or collected."""
    stack = _paths.setdefault(spark.sparkContext.applicationId, [[]])
    paths, stack[0] = stack[0], []
    return _delete(spark, paths)
