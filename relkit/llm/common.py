"""Helpers shared by the corpus operators."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from relkit.session import ensure_checkpoint_dir


def pinned(df: DataFrame) -> DataFrame:
    """``df`` written to the session's shared checkpoint folder: computed
    once, with its lineage cut, and readable after an executor is lost."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def released(*pins: DataFrame) -> None:
    """Removes the files of pinned tables that nothing reads any more,
    whatever the session's settings for spent checkpoints are."""
    for df in pins:
        file = df._jdf.queryExecution().logical().rdd().getCheckpointFile()
        if file.isDefined():
            remove_folder(df.sparkSession, file.get())


def remove_folder(spark: SparkSession, folder: str) -> None:
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def parts_for(spark: SparkSession, rows: int, each: int = 100_000) -> int:
    """Partitions for a table of small rows: never more than the session's."""
    return max(1, min(shuffle_partitions(spark), -(-rows // each)))


def slices(batches: Iterable[pa.RecordBatch], rows: int = 256) -> Iterator[pa.RecordBatch]:
    """The batches in slices of a few rows, so that only the texts of one
    slice are Python objects at a time.  Free memory goes back to the
    system after each batch: a worker lives on into later stages, beside
    others that are idle, and all count for the executor."""
    for batch in batches:
        for a in range(0, batch.num_rows, rows):
            yield batch.slice(a, rows)
        for pool in (pa.default_memory_pool(), pa.system_memory_pool()):
            pool.release_unused()


def key_runs(batches: Iterable[pd.DataFrame], keys: list[str]) -> Iterator[pd.DataFrame]:
    """The rows of each key, one frame per key, from batches sorted by
    ``keys``; a key may reach over batches.  Memory: one batch and the
    rows of one key, which the caller bounds by salting the key."""
    held: list[pd.DataFrame] = []
    for batch in batches:
        if not len(batch):
            continue
        change = np.zeros(len(batch), dtype=bool)
        for k in keys:
            v = batch[k].to_numpy()
            change[1:] |= v[1:] != v[:-1]
        starts = [0, *np.flatnonzero(change).tolist(), len(batch)]
        if held and any(held[-1][k].iloc[-1] != batch[k].iloc[0] for k in keys):
            yield pd.concat(held, ignore_index=True) if len(held) > 1 else held[0]
            held = []
        for a, b in zip(starts[:-1], starts[1:]):
            if a:
                yield pd.concat(held, ignore_index=True) if len(held) > 1 else held[0]
                held = []
            held.append(batch.iloc[a:b])
    if held:
        yield pd.concat(held, ignore_index=True) if len(held) > 1 else held[0]
