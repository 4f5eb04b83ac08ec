"""Per-task numpy helpers for the tiled form.

A tile is a dense ``b × b`` block stored as one BINARY value (row-major
float64, or int64 for BIGINT matrices).  These functions run inside Spark
tasks on Arrow batches; Spark does the partitioning and the shuffles.

Integer tiles never wrap: products and sums that leave the BIGINT range
raise.  Float tiles with infinite or NaN entries are multiplied over their
stored entries only, so padding adds no ``inf · 0``.
"""

from __future__ import annotations

import sys
from typing import Any, Iterator, Tuple

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import cloudpickle

# Ship these helpers to Python workers by value: tasks then run whether or
# not the package is installed on the executors.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Integers below this magnitude are exact in float64.
EXACT_LIMIT = float(2 ** 53)
# Products whose float64 shadow stays below this cannot leave the BIGINT range.
SAFE_LIMIT = float(2 ** 62)
BIGINT_MIN, BIGINT_MAX = -(2 ** 63), 2 ** 63 - 1
OVERFLOW = "BIGINT overflow in tile arithmetic"


def dtype_for(value_type: str):
    return np.int64 if value_type == "bigint" else np.float64


def decode(buf: bytes, b: int, dtype) -> np.ndarray:
    return np.frombuffer(buf, dtype=dtype).reshape(b, b)


def encode(tile: np.ndarray) -> bytes:
    return np.ascontiguousarray(tile).tobytes()


def densify(pos, val, b: int, dtype) -> np.ndarray:
    """Dense tile from the sparse (flat position, value) lists built in the JVM; positions are unique."""
    t = np.zeros(b * b, dtype=dtype)
    p = np.asarray(pos, dtype=np.int64)
    if p.size:
        t[p] = np.asarray(val).astype(dtype)
    return t.reshape(b, b)


def stored(pos, b: int) -> np.ndarray:
    """Which entries of a tile are stored cells."""
    m = np.zeros(b * b, dtype=bool)
    m[np.asarray(pos, dtype=np.int64)] = True
    return m.reshape(b, b)


def checked_matmul(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Tile product; integer tiles are exact and raise instead of wrapping around.

    When ``max|x|·max|y|·k < 2^53`` every partial sum is an integer that a
    double holds exactly, so the product runs on the float64 (BLAS) path and
    is converted back without loss.  Otherwise int64 arithmetic is used; an
    entry whose float64 shadow is near the limit is recomputed with unbounded
    integers, and a single product outside the range raises as well.
    """
    if x.dtype != np.int64:
        return x @ y
    if x.size == 0 or y.size == 0:
        return np.zeros((x.shape[0], y.shape[1]), dtype=np.int64)
    fx, fy = np.abs(x.astype(np.float64)), np.abs(y.astype(np.float64))
    if float(fx.max()) * float(fy.max()) * x.shape[1] < EXACT_LIMIT:
        return np.rint(x.astype(np.float64) @ y.astype(np.float64)).astype(np.int64)
    for k in np.flatnonzero(fx.max(axis=0) * fy.max(axis=1) >= SAFE_LIMIT):
        col, row = [int(v) for v in x[:, k]], [int(v) for v in y[k, :]]
        ends = [u * v for u in (min(col), max(col)) for v in (min(row), max(row))]
        if min(ends) < BIGINT_MIN or max(ends) > BIGINT_MAX:
            raise ArithmeticError(OVERFLOW)
    with np.errstate(over="ignore"):
        out = x @ y
    for i, j in np.argwhere(fx @ fy >= SAFE_LIMIT):
        exact = sum(int(u) * int(v) for u, v in zip(x[i], y[:, j]))
        if not BIGINT_MIN <= exact <= BIGINT_MAX:
            raise ArithmeticError(OVERFLOW)
    return out


def stored_matmul(x: np.ndarray, mx: np.ndarray, y: np.ndarray, my: np.ndarray) -> np.ndarray:
    """Float product over stored entries only; used where an entry is not finite."""
    out = np.zeros((x.shape[0], y.shape[1]))
    for k in range(x.shape[1]):
        i, j = np.flatnonzero(mx[:, k]), np.flatnonzero(my[k])
        if i.size and j.size:
            with np.errstate(invalid="ignore"):
                out[np.ix_(i, j)] += np.outer(x[i, k], y[k, j])
    return out


def checked_add(acc: np.ndarray, w, tile: np.ndarray) -> np.ndarray:
    """``acc + w·tile`` for ``w`` = ±1 (or any weight that is exact); BIGINT raises instead of wrapping."""
    if acc.dtype != np.int64:
        with np.errstate(invalid="ignore"):
            return acc + acc.dtype.type(w) * tile
    w = int(w)
    if w != 1 and tile.size:
        ends = [w * int(tile.min()), w * int(tile.max())]
        if min(ends) < BIGINT_MIN or max(ends) > BIGINT_MAX:
            raise ArithmeticError(OVERFLOW)
        tile = tile * np.int64(w)
    with np.errstate(over="ignore"):
        out = acc + tile
    if (((acc ^ out) & (tile ^ out)) < 0).any():
        raise ArithmeticError(OVERFLOW)
    return out


def _product(b: int, value_type: str):
    """Product of two tiles given as (dense tile, positions of its stored cells or None)."""
    dt = dtype_for(value_type)

    def product(x: np.ndarray, px, y: np.ndarray, py) -> np.ndarray:
        if dt is np.float64 and px is not None and not (np.isfinite(x).all() and np.isfinite(y).all()):
            return stored_matmul(x, stored(px, b), y, stored(py, b))
        return checked_matmul(x, y)

    return product


def _tile_reader(batch: pa.RecordBatch, b: int, dt):
    """Row number → (dense tile, stored positions or None), from ``pos``/``val`` lists or ``tile`` bytes."""
    if "tile" in batch.schema.names:
        tiles = batch.column("tile")
        return lambda r: (decode(tiles[r].as_buffer(), b, dt), None)
    pos, val = batch.column("pos"), batch.column("val")
    ends, cells, values = pos.offsets.to_numpy(), pos.values.to_numpy(), val.values.to_numpy(zero_copy_only=False)
    v0 = val.offsets.to_numpy()

    def read(r: int):
        p = cells[ends[r]:ends[r + 1]]
        return densify(p, values[v0[r]:v0[r + 1]], b, dt), p

    return read


def cell_batch(bi: int, bj: int, tile: np.ndarray, b: int, n_rows: int, n_cols: int) -> pa.RecordBatch:
    """The non-zero cells of a block, inside the true shape."""
    li, lj = np.nonzero(tile)
    rows, cols = li + bi * b, lj + bj * b
    keep = (rows < n_rows) & (cols < n_cols)
    return pa.RecordBatch.from_arrays(
        [pa.array(rows[keep].astype(np.int32)), pa.array(cols[keep].astype(np.int32)), pa.array(tile[li[keep], lj[keep]])],
        names=["row", "col", "value"])


def stationary_fn(b: int, value_type: str, shape: tuple[int, int] | None):
    """mapInArrow function over rows sorted by (group, bk, side, idx): sums of tile products per group.

    A group is one super-block of C and one slab of the inner dimension.  Its
    tiles of A and B stream by in the order of the inner block ``bk``: those of
    A (side 0) at one ``bk`` are held, each tile of B is multiplied with them
    at once and the products are added to the group's blocks of C, which stay
    in the task until the group ends.  So a task holds the blocks of one
    super-block, one column of A tiles and one B tile, however long the inner
    dimension is, and each block of C leaves it once.

    With ``shape`` the blocks leave as cells, otherwise as ``(path, bi, bj, slab, tile)``.
    """
    dt = dtype_for(value_type)
    product = _product(b, value_type)

    def leave(path: int, slab: int, blocks: dict) -> Iterator[pa.RecordBatch]:
        for (bi, bj), t in blocks.items():
            if shape is not None:
                yield cell_batch(bi, bj, t, b, *shape)
            else:
                yield pa.RecordBatch.from_arrays(
                    [pa.array([path], pa.int64()), *(pa.array([x], pa.int32()) for x in (bi, bj, slab)), pa.array([encode(t)], pa.binary())],
                    names=["path", "bi", "bj", "slab", "tile"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, inner, left, blocks = None, None, [], {}
        for batch in batches:
            if not batch.num_rows:
                continue
            read = _tile_reader(batch, b, dt)
            keys = [batch.column(c).to_pylist() for c in ("path", "si", "sj", "slab")]
            for r, (*key, bk, side, idx) in enumerate(zip(*keys, *(batch.column(c).to_pylist() for c in ("bk", "side", "idx")), strict=True)):
                if key != at:
                    if blocks:
                        yield from leave(at[0], at[3], blocks)
                    at, inner, blocks = key, None, {}
                if bk != inner:
                    inner, left = bk, []
                t, pos = read(r)
                if side == 0:
                    left.append((idx, t, pos))
                    continue
                for bi, x, px in left:
                    p = product(x, px, t, pos)
                    blocks[bi, idx] = checked_add(blocks[bi, idx], 1, p) if (bi, idx) in blocks else p
        if blocks:
            yield from leave(at[0], at[3], blocks)

    return run


def tile_cells_fn(b: int, value_type: str, shape: tuple[int, int]):
    """mapInArrow function: the cells of every ``(bi, bj, tile)`` row."""
    dt = dtype_for(value_type)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            tiles = batch.column("tile")
            for r, (bi, bj) in enumerate(zip(batch.column("bi").to_pylist(), batch.column("bj").to_pylist())):
                yield cell_batch(bi, bj, decode(tiles[r].as_buffer(), b, dt), b, *shape)

    return run


def sum_tiles_fn(b: int, value_type: str, key_names: list[str], shape: tuple[int, int] | None):
    """Grouped function: the sum of a group's tiles, as one tile row or (with ``shape``) as cells."""
    dt = dtype_for(value_type)

    def summed(key: Tuple[Any, ...], it: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        acc = np.zeros((b, b), dtype=dt)
        for pdf in it:
            for buf in pdf["tile"]:
                acc = checked_add(acc, 1, decode(buf, b, dt))
        row = dict(zip(key_names, key))
        if shape is not None:
            yield cell_batch(int(row["bi"]), int(row["bj"]), acc, b, *shape).to_pandas()
        else:
            yield pd.DataFrame({**{n: [k] for n, k in row.items()}, "tile": [encode(acc)]})

    return summed


def combine_fn(b: int, value_type: str, case: str, sums: dict[int, list[tuple[int, int]]], key_names: list[str], sparse: bool):
    """Grouped function: the tiles of a group, one or none per value of ``case``, into ``Σ w·tile`` per sum.

    Sums without any tile give no row.  ``key_names`` are repeated on every output row.
    """
    dt = dtype_for(value_type)

    def combined(key: Tuple[Any, ...], it: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        tiles: dict[int, np.ndarray] = {}
        for pdf in it:
            read = (densify(p, v, b, dt) for p, v in zip(pdf["pos"], pdf["val"])) if sparse else (decode(t, b, dt) for t in pdf["tile"])
            for c, t in zip(pdf[case], read):
                tiles[c] = checked_add(tiles[c], 1, t) if c in tiles else t
        for out, terms in sums.items():
            terms = [(c, w) for c, w in terms if c in tiles]
            if terms:
                acc = np.zeros((b, b), dtype=dt)
                for c, w in terms:
                    acc = checked_add(acc, w, tiles[c])
                yield pd.DataFrame({**{n: [k] for n, k in zip(key_names, key)}, "out": np.array([out], np.int32), "tile": [encode(acc)]})

    return combined
