"""Counts, means and centred co-moments of vectors, by group, in one pass.

Each task turns its Arrow batches into blocks and adds their outer products to
one state for each group; states merge around their common mean (Chan, Golub
and LeVeque), so no digits are lost where means are large beside spreads. The
tasks' states are merged in a tree on the executors; one dims x dims matrix for
each group (a few) reaches the driver.
"""

from __future__ import annotations

import pickle
import sys

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame

FEW = 64  # tasks whose states the driver merges itself
State = tuple[int, np.ndarray, np.ndarray]  # rows, mean, sum of outer products of deviations


def merged(a: State | None, b: State) -> State:
    if a is None or a[0] == 0:
        return b
    n = a[0] + b[0]
    off = b[1] - a[1]
    return n, a[1] + off * (b[0] / n), a[2] + b[2] + np.outer(off, off) * (a[0] * b[0] / n)


def _block(x: np.ndarray) -> State:
    mean = x.mean(axis=0)
    c = x - mean
    return len(x), mean, c.T @ c


def _partial(dims: int):
    def batches(stream):
        states: dict[int, State] = {}
        for batch in stream:
            x = batch.column("x").flatten().to_numpy(zero_copy_only=False).reshape(-1, dims)
            group = batch.column("g").to_numpy(zero_copy_only=False)
            for g in np.unique(group):
                states[int(g)] = merged(states.get(int(g)), _block(x[group == g]))
        yield pa.RecordBatch.from_arrays([pa.array([pickle.dumps(states)], pa.binary())], ["states"])

    return batches


def comoments(df: DataFrame, x: Column, group: Column, dims: int) -> dict[int, State]:
    """group -> (rows, mean, centred co-moment matrix) of the vectors ``x``
    (array<double> of ``dims`` values, none of them missing)."""
    # the code goes with the task, so workers need only numpy and pyarrow
    from pyspark import cloudpickle

    cloudpickle.register_pickle_by_value(sys.modules[__name__])
    parts = df.select(group.cast("int").alias("g"), x.alias("x")).mapInArrow(_partial(dims), "states binary")

    def join(a: dict, b: dict) -> dict:
        return a | {g: merged(a.get(g), s) for g, s in b.items()}

    tasks = parts.rdd.map(lambda r: pickle.loads(bytes(r["states"])))
    count = tasks.getNumPartitions()
    return tasks.treeReduce(join, 1 if count <= FEW else 3) if count else {}
