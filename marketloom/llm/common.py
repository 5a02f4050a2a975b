"""Helpers that several corpus operators share."""

from __future__ import annotations

import ctypes
import gc
import sys

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marketloom.operators.graph import components  # noqa: F401
from marketloom.session import discard, shared_folder, written  # noqa: F401

#: Rows in an Arrow batch. Texts run to 100 kB and more, so that a batch stays far below an executor's memory.
BATCH_ROWS = 512


#: Answers that a worker remembers, in each of two generations.
MEMO_WORDS = 100_000


class Memo(dict):
    """Answers of make by key, in two generations: when the younger is full, the older is forgotten."""

    def __init__(self, make, limit: int = MEMO_WORDS):
        super().__init__()
        self.make, self.limit, self.older = make, limit, {}

    def __missing__(self, key):
        if len(self) >= self.limit:
            self.older = dict(self)
            self.clear()
        if (got := self.older.get(key)) is None:
            got = self.make(key)
        self[key] = got
        return got


def tuned(spark: SparkSession) -> SparkSession:
    """Holds Arrow batches down to BATCH_ROWS rows."""
    if int(spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")) > BATCH_ROWS:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    return spark


def give_back() -> None:
    """Hands memory that is free within this worker back to the machine: workers live on between tasks and stages."""
    gc.collect()
    if sys.platform.startswith("linux"):
        ctypes.CDLL(None).malloc_trim(0)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return tuned(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def aside(docs: DataFrame, *kept: str):
    """docs with all columns but kept under names that no operator uses, and a function that gives a result the columns
    of docs back, in their order."""
    names = {c: f"own_{i}" for i, c in enumerate(docs.columns) if c not in kept}
    return docs.select(*[F.col(f"`{c}`").alias(names.get(c, c)) for c in docs.columns]), lambda df: df.select(*[F.col(names.get(c, c)).alias(c) for c in docs.columns])


def blobs(column) -> list[bytes]:
    """UTF-8 bytes of an Arrow string column; null is empty."""
    import pyarrow as pa

    return [x or b"" for x in column.cast(pa.large_binary()).to_pylist()]


def local_components(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Nodes of the edges (a, b), and of each the smallest node reachable."""
    nodes, ends = np.unique(np.concatenate([a, b]), return_inverse=True)
    x, y = ends[: len(a)], ends[len(a) :]
    label = np.arange(len(nodes))
    while len(x):
        low = np.minimum(label[x], label[y])
        np.minimum.at(label, label[x], low)
        np.minimum.at(label, label[y], low)
        while True:
            up = label[label]
            if (up == label).all():
                break
            label = up
        keep = label[x] != label[y]
        x, y = x[keep], y[keep]
    return nodes, nodes[label]
