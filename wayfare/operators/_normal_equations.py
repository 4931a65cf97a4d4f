"""Task-side sums and solves of implicit ALS (run inside ``mapInArrow``).

Only numpy and pyarrow are used here, and the module is pickled by value, so executors run
it without the ``wayfare`` package installed. A sum is one array: the upper triangle of
sum(c y y'), the vector sum((1 + c) y) over positive ratings, and their number.
"""

from __future__ import annotations

import sys

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle

ROWS_AT_A_TIME = 8_192
SUMS = pa.schema([("id", pa.int32()), ("sums", pa.list_(pa.float64()))])
FACTORS = pa.schema([("id", pa.int32()), ("features", pa.list_(pa.float32()))])
PARTS = pa.schema([*FACTORS, SUMS.field(1)])


def matrix_of(column: pa.Array) -> np.ndarray:
    values = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return values.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(values), -1)


def list_column(matrix: np.ndarray, kind) -> pa.Array:
    offsets = np.arange(len(matrix) + 1, dtype=np.int32) * matrix.shape[1]
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(matrix.ravel(), type=kind))


def sum_by_id(ids: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = np.argsort(ids, kind="stable")
    ids = ids[order]
    starts = np.flatnonzero(np.r_[True, ids[1:] != ids[:-1]])
    return ids[starts], np.add.reduceat(rows[order], starts, axis=0)


def _sums_of(ids: np.ndarray, rating: np.ndarray, y: np.ndarray, alpha: float) -> tuple[np.ndarray, np.ndarray]:
    """(ids ascending, one sum each) of some ratings."""
    upper = np.triu_indices(y.shape[1])
    c, liked = alpha * np.abs(rating), (rating > 0).astype(np.float64)
    order = np.argsort(ids, kind="stable")
    ids, c, liked, y = ids[order], c[order], liked[order], y[order]
    starts = np.flatnonzero(np.r_[True, ids[1:] != ids[:-1]])
    if len(ids) < 4 * len(starts):
        squares = np.add.reduceat(y[:, upper[0]] * y[:, upper[1]] * c[:, None], starts, axis=0)
    else:  # a matrix product for each id
        weighted, ends = y * c[:, None], [*starts[1:], len(ids)]
        squares = np.array([(y[a:b].T @ weighted[a:b]) for a, b in zip(starts, ends)])[:, upper[0], upper[1]]
    right = np.add.reduceat(y * ((1 + c) * liked)[:, None], starts, axis=0)
    return ids[starts], np.concatenate([squares, right, np.add.reduceat(liked, starts)[:, None]], axis=1)


def partial_sums(batches, rank: int, alpha: float):
    """One sum for each id of (id, rating, features) and task, as long as a task meets no
    more than ``ROWS_AT_A_TIME`` ids at a time: a hot id sends one row a task."""
    ids, rows = np.zeros(0, np.int32), np.zeros((0, rank * (rank + 1) // 2 + rank + 1))

    def emit():
        return pa.RecordBatch.from_arrays([pa.array(ids, pa.int32()), list_column(rows, pa.float64())], schema=SUMS)
    for batch in batches:
        for at in range(0, batch.num_rows, ROWS_AT_A_TIME):
            part = batch.slice(at, ROWS_AT_A_TIME)
            own, sums = _sums_of(part.column(0).to_numpy(), part.column(1).to_numpy().astype(np.float64), matrix_of(part.column(2)), alpha)
            ids, rows = sum_by_id(np.concatenate([ids, own]), np.concatenate([rows, sums]))
            if len(ids) > ROWS_AT_A_TIME:
                yield emit()
                ids, rows = ids[:0], rows[:0]
    if len(ids):
        yield emit()


def solved(ids: np.ndarray, rows: np.ndarray, rank: int, gram: np.ndarray, reg: float) -> pa.RecordBatch:
    """Factors of ids from their whole sums."""
    upper = np.triu_indices(rank)
    left = np.empty((len(ids), rank, rank))
    left[:, upper[0], upper[1]] = rows[:, :len(upper[0])]
    left[:, upper[1], upper[0]] = rows[:, :len(upper[0])]
    left += gram + (reg * rows[:, -1])[:, None, None] * np.eye(rank)
    # No positive rating: the answer is zero, whatever the matrix.
    empty = rows[:, -1] == 0
    left[empty] = np.eye(rank)
    found = np.linalg.solve(left, rows[:, len(upper[0]):-1, None])[:, :, 0]
    return pa.RecordBatch.from_arrays([pa.array(ids, pa.int32()), list_column(found.astype(np.float32), pa.float32())], schema=FACTORS)


def solve_sorted(batches, rank: int, alpha: float, gram: np.ndarray, reg: float):
    """(id, features, sums) from one range of (id, rating, features) sorted by id. Every id
    but the range's first and last is whole in it and solved here; those two may go on in
    other ranges and are given as sums, without features."""
    def give(ids, rows):
        ready = solved(ids, rows, rank, gram, reg)
        return pa.RecordBatch.from_arrays([*ready.columns, pa.nulls(len(ids), SUMS.field(1).type)], schema=PARTS)

    def leave(ids, rows):
        return pa.RecordBatch.from_arrays([pa.array(ids, pa.int32()), pa.nulls(len(ids), FACTORS.field(1).type),
                                           list_column(rows, pa.float64())], schema=PARTS)
    ids, rows, at_start = np.zeros(0, np.int32), np.zeros((0, rank * (rank + 1) // 2 + rank + 1)), True
    for batch in partial_sums(batches, rank, alpha):
        ids, rows = sum_by_id(np.concatenate([ids, batch.column(0).to_numpy()]), np.concatenate([rows, matrix_of(batch.column(1))]))
        if at_start and len(ids) > 1:
            yield leave(ids[:1], rows[:1])
            ids, rows, at_start = ids[1:], rows[1:], False
        if len(ids) > 1:  # the last id may go on in the next batch
            yield give(ids[:-1], rows[:-1])
            ids, rows = ids[-1:], rows[-1:]
    if len(ids):
        yield leave(ids, rows)


def gram_of(batches, rank: int):
    total = np.zeros((rank, rank))
    for batch in batches:
        y = matrix_of(batch.column(0))
        total += y.T @ y
    yield pa.RecordBatch.from_arrays([list_column(total.reshape(1, -1), pa.float64())], names=["gram"])


def first_factors(batches, rank: int, seed: int):
    """Unit vectors of non-negative normals drawn for each id, the same wherever it is drawn."""
    for batch in batches:
        ids = batch.column(0).to_numpy()
        out = np.array([np.abs(np.random.default_rng([seed, int(k)]).normal(size=rank)) for k in ids]).reshape(-1, rank)
        out /= np.maximum(np.linalg.norm(out, axis=1, keepdims=True), 1e-12)
        yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int32()), list_column(out.astype(np.float32), pa.float32())],
                                         schema=FACTORS)


cloudpickle.register_pickle_by_value(sys.modules[__name__])
