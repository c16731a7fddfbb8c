"""Commit marks of micro-batches, and what readers and hooks get from them.

A batch counts when its mark ``<path>/_commits/<batch id>`` exists.  A batch that
is run again after its mark (a restart) neither writes nor calls its hook again;
one that died before its mark overwrites its own folders.
"""

from __future__ import annotations

import json
from typing import Callable, Optional

from pyspark.sql import DataFrame, SparkSession

Batch = Callable[[DataFrame, int], None]


def _files(spark: SparkSession, path: str):
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()), target


def exists(spark: SparkSession, path: str) -> bool:
    files, target = _files(spark, path)
    return files.exists(target)


def children(spark: SparkSession, path: str) -> list[str]:
    """Names in a folder, none where there is no such folder."""
    files, target = _files(spark, path)
    return sorted(s.getPath().getName() for s in files.listStatus(target)) if files.exists(target) else []


def delete(spark: SparkSession, path: str) -> None:
    files, target = _files(spark, path)
    files.delete(target, True)


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """A small file that appears whole or not at all: written aside, then renamed."""
    files, aside = _files(spark, f"{path}.tmp")
    out = files.create(aside, True)
    out.write(bytearray(text.encode()))
    out.close()
    _, target = _files(spark, path)
    files.delete(target, False)
    if not files.rename(aside, target):
        raise OSError(f"could not write {path}")


def read_text(spark: SparkSession, path: str) -> Optional[str]:
    files, target = _files(spark, path)
    if not files.exists(target):
        return None
    stream = files.open(target)
    try:
        return bytes(stream.readAllBytes()).decode()
    finally:
        stream.close()


def with_commits(path: str, write: Batch, hook: Optional[Batch] = None) -> Batch:
    """A foreachBatch function that writes, marks and then calls ``hook`` once per batch id.

    Errors of the batch stop the stream; those of the hook (X5) do not.
    """
    root = path.rstrip("/")

    def run(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        mark = f"{root}/_commits/{batch_id}"
        if exists(spark, mark):
            return
        write(batch, batch_id)
        write_text(spark, mark, json.dumps({"batch_id": batch_id}))
        if hook is not None:
            try:
                hook(batch, batch_id)
            except Exception:  # noqa: BLE001 - hook errors must not stop the stream
                pass

    return run


def committed_ids(spark: SparkSession, path: str) -> list[int]:
    return sorted(int(n) for n in children(spark, f"{path.rstrip('/')}/_commits") if n.isdigit())


def committed(spark: SparkSession, path: str, part: str = "") -> Optional[DataFrame]:
    """The rows of all committed batches under ``<path>/<part>/batch_id=N`` (None without any)."""
    root = f"{path.rstrip('/')}/{part}".rstrip("/")
    folders = [f"{root}/batch_id={i}" for i in committed_ids(spark, path)]
    return spark.read.option("basePath", root).parquet(*folders) if folders else None
