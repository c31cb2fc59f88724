"""Vectors in sorted blocks: reading arrays of numbers, principal axes, block files.

A task appends its blocks to one file in the shared folder and returns an index
row for each (file, offset, size, and whatever bounds the operator keeps), so
later jobs shuffle index rows and read only the blocks they need. A retried
task writes a file of a new name; only files in a written index count.
"""

from __future__ import annotations

import uuid

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mdq.llm.common import open_fs


def read_vectors(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """A list column as (flat float64 values, start, length, valid): valid rows
    are not null, not empty, and hold no null and no non-finite number. -0.0 is 0.0."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    length = pc.fill_null(pc.list_value_length(column), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    flat = pc.cast(column.flatten(), pa.float64())
    values = pc.fill_null(flat, float("nan")).to_numpy(zero_copy_only=False) + 0.0
    end = np.cumsum(length)
    bad = np.append(0, np.cumsum(~np.isfinite(values)))
    valid = column.is_valid().to_numpy(zero_copy_only=False) & (length > 0) & (bad[end] == bad[end - length])
    return values, end - length, length, valid


def rows_of(values: np.ndarray, start: np.ndarray, rows: np.ndarray, dim: int) -> np.ndarray:
    """The given rows, all of length ``dim``, as a matrix."""
    return values[start[rows][:, None] + np.arange(dim)]


def unit_rows(x: np.ndarray) -> np.ndarray:
    """Rows scaled to length 1, first by their largest component, so that
    neither very large nor very small numbers leave the range of a double."""
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt(np.einsum("ij,ij->i", x, x))[:, None]


def principal_axes(vectors: DataFrame, column: str, unit: bool, limit: int = 24, dim: int | None = None) -> tuple[int, np.ndarray] | None:
    """(dim, axes): the ``limit`` leading principal axes (dim x limit,
    orthonormal) of all valid vectors of the most common length, or of ``dim``.

    Every task adds up its vectors' moments; a sum for each pair of components
    is what the driver gets. None if there is no valid vector. The axes only
    choose an order and bounds; no result depends on them."""
    def moments(batches):
        total: dict[int, list] = {}
        for b in batches:
            values, start, length, valid = read_vectors(b.column(0))
            for d in np.unique(length[valid]).tolist():
                if dim is not None and d != dim:
                    continue
                x = rows_of(values, start, np.flatnonzero(valid & (length == d)), d)
                x = x[np.abs(x).max(axis=1) > 0]
                x = unit_rows(x) if unit else x
                n, s, m = total.setdefault(d, [0, np.zeros(d), np.zeros((d, d))])
                total[d] = [n + len(x), s + x.sum(0), m + x.T @ x]
            total = {d: t for d, t in total.items() if t[0]}
            if len(total) > 8:                                    # odd lengths only set their own axes; the common one counts
                total = dict(sorted(total.items(), key=lambda t: -t[1][0])[:4])
        for d, (n, s, m) in total.items():
            i, j = np.triu_indices(d)
            at = np.concatenate([[-1], i, np.arange(d)])
            to = np.concatenate([[-1], j, np.full(d, -1)])
            yield pa.record_batch([pa.array(np.full(len(at), d, np.int32)), pa.array(at.astype(np.int32)), pa.array(to.astype(np.int32)),
                                   pa.array(np.concatenate([[n], m[i, j], s]))], ["dim", "i", "j", "v"])

    sums = (vectors.select(F.col(column).cast("array<double>").alias("x")).mapInArrow(moments, "dim int, i int, j int, v double")
            .groupBy("dim", "i", "j").agg(F.sum("v").alias("v")))
    top = sums.filter("i = -1").orderBy(F.desc("v"), "dim").limit(1)
    rows = sums.join(F.broadcast(top.select("dim")), "dim").collect()
    if not rows:
        return None
    d = rows[0]["dim"]
    n, s, m = 0.0, np.zeros(d), np.zeros((d, d))
    for r in rows:
        if r["i"] < 0:
            n = r["v"]
        elif r["j"] < 0:
            s[r["i"]] = r["v"]
        else:
            m[r["i"], r["j"]] = m[r["j"], r["i"]] = r["v"]
    cov = np.nan_to_num(m / n - np.outer(s, s) / n ** 2)
    _, axes = np.linalg.eigh(cov)
    return d, np.ascontiguousarray(axes[:, ::-1][:, :limit])


class BlockWriter:
    """Appends byte blocks to one file; ``close`` makes it visible."""

    def __init__(self, root: str):
        self.name = f"{root.rstrip('/')}/{uuid.uuid4().hex}.blk"
        self.fs, self.path = open_fs(self.name)
        self.out, self.at = None, 0

    def add(self, *parts: bytes) -> tuple[int, int]:
        """(offset, size) of a new block."""
        if self.out is None:
            self.fs.create_dir(self.path.rsplit("/", 1)[0], recursive=True)
            self.out = self.fs.open_output_stream(self.path + ".tmp")
        start = self.at
        for p in parts:
            self.out.write(p)
            self.at += len(p)
        return start, self.at - start

    def close(self) -> None:
        if self.out is not None:
            self.out.close()
            self.fs.move(self.path + ".tmp", self.path)


class BlockReader:
    """Reads blocks; the last file stays open."""

    def __init__(self):
        self.name, self.f = None, None

    def read(self, name: str, offset: int, size: int) -> bytes:
        if name != self.name:
            self.close()
            fs, path = open_fs(name)
            self.f, self.name = fs.open_input_file(path), name
        self.f.seek(offset)
        return self.f.read(size)

    def close(self) -> None:
        if self.f is not None:
            self.f.close()
            self.f, self.name = None, None
