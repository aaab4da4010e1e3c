"""Numeric columns as cached numpy blocks, for fits that pass over the same rows many times.

A pass is one small job of Python tasks without planning, so tens of passes cost little
besides their arithmetic.  Tasks add their partial sums first, and executors add those of
many tasks before the driver gets one result; a lost block is read again from the table
behind it, which should be a staged one.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark import RDD, StorageLevel
from pyspark.sql import DataFrame

#: Tasks whose partial sums go straight to the driver; those of more are added on executors first.
FLAT_TASKS = 64


def as_matrix(batch: pa.RecordBatch, first: int = 0) -> np.ndarray:
    return np.column_stack([batch.column(i).to_numpy(zero_copy_only=False) for i in range(first, batch.num_columns)]).astype(float)


def numeric_blocks(df: DataFrame, names: Sequence[str]) -> RDD:
    """The columns ``names`` (numbers without nulls) as an RDD of (rows, columns) arrays, kept in memory or on disk."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([as_matrix(batch).tobytes()], pa.binary())], names=["block"])

    width = len(names)
    packed = df.select(*names).mapInArrow(pack, "block binary")
    return packed.rdd.map(lambda r: np.frombuffer(r[0]).reshape(-1, width)).persist(StorageLevel.MEMORY_AND_DISK)


def block_sum(blocks: RDD, partial: Callable[[Iterator[np.ndarray]], np.ndarray]) -> np.ndarray:
    """The sum of ``partial(blocks of a task)`` over all tasks; its size must not depend on the rows."""
    sums = blocks.mapPartitions(lambda parts: [partial(parts)])
    return sums.treeReduce(np.add, depth=1 if blocks.getNumPartitions() <= FLAT_TASKS else 2)
