"""Tiled (blocked) multiplication for dense matrices, plain and Strassen.

Cells are gathered per ``b × b`` block ``(bi, bj)`` in the JVM.  The product is
output-stationary: C is cut into super-blocks of ``side × side`` tiles, each a
partition key; the tiles of A and B that a super-block needs are shipped to it,
sorted by the inner block index, and multiplied and summed as they stream by,
so every block of C leaves its task once and is never shuffled as a partial
product.  Where C has too few super-blocks for the cluster, or one would have
to stream too many tiles, the inner dimension is cut into slabs too; their
partial blocks are added in a tree whose groups hold at most ``FAN_IN`` tiles.
:func:`plan_grid` picks the side and the slabs by the tiles shipped.

Every task is bounded, whatever the matrix: ``STATIONARY_BYTES`` of blocks of
C, one column of A tiles and one B tile in the product, ``FAN_IN`` streamed
tiles in a sum, four or seven tiles in a Strassen combination.  The tile size
bounds a record at ``8·b²`` bytes (a stored cell: 12) and Spark's own
``spark.sql.execution.arrow.maxBytesPerBatch`` bounds a batch; no session
setting is changed.  NULL values raise.

Output cells are the non-zero entries of C (the coordinate form can also
hold explicit zeros; use :func:`tessera.compact` on it to compare).
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.coefficients import ALPHA, BETA, PATH_BASE, by_product, by_result
from ..functions.tiles import combine_fn, stationary_fn, sum_tiles_fn, tile_cells_fn
from ..matrix import COL, ROW, VALUE, Matrix, as_matrix, required
from .multiply import result_type
from .strassen import halves

# Bounds of a product task and of a tree of partial sums.
STATIONARY_BYTES = 64 << 20   # blocks of C that a task holds
GROUP_TILES = 16_384          # tiles that one group streams
FAN_IN = 32                   # partial blocks summed by one group of the tree
SLAB_FLOPS = 200_000_000      # no slab is cut below this much arithmetic


@dataclass(frozen=True)
class Grid:
    """Super-blocks of ``side_m × side_n`` tiles of C, and slabs of the inner dimension."""

    side_m: int
    side_n: int
    slabs: int


def plan_grid(nb_m: int, nb_k: int, nb_n: int, tile: int, tasks: int, products: int = 1) -> Grid:
    """The grid that ships the fewest tiles among those that keep ``tasks`` busy (or come closest).

    A tile of A goes to ``ceil(nb_n/side_n)`` super-blocks, one of B to
    ``ceil(nb_m/side_m)``, and with slabs each block of C is shipped once per
    slab.  ``products`` counts independent products of this size (Strassen).
    """
    best = None
    side = 1
    while True:
        m, n = min(side, max(1, nb_m)), min(side, max(1, nb_n))
        if side > 1 and m * n * tile * tile * 8 > STATIONARY_BYTES:
            break
        across, down = -(-nb_n // n), -(-nb_m // m)
        work = m * n * nb_k * 2 * tile ** 3
        wanted = min(-(-tasks // max(1, across * down * products)), max(1, work // SLAB_FLOPS))
        slabs = max(1, min(nb_k, max(wanted, -(-(m + n) * nb_k // GROUP_TILES))))
        shipped = nb_m * nb_k * across + nb_k * nb_n * down + (nb_m * nb_n * slabs if slabs > 1 else 0)
        key = (-min(tasks, across * down * slabs * products), shipped)
        if best is None or key < best[0]:
            best = key, Grid(m, n, slabs)
        if side >= max(nb_m, nb_n):
            break
        side *= 2
    return best[1]


def to_tiles(m: Matrix, tile: int) -> DataFrame:
    """``(bi, bj, pos, val)``: the cells of each non-empty block as flat positions and values.

    Built in the JVM; the two lists of one group are filled in the same row
    order, and tiles are made dense only inside the product tasks.  A block's
    lists hold at most ``tile²`` entries: guaranteed by the producer when the
    matrix is marked ``unique``, otherwise cells are first summed per
    ``(bi, bj, pos)`` — map-side partial aggregation collapses copies of a
    coordinate before any shuffle.
    """
    cells = m.df.select(
        (F.col(ROW) / tile).cast("int").alias("bi"), (F.col(COL) / tile).cast("int").alias("bj"),
        ((F.col(ROW) % tile) * tile + (F.col(COL) % tile)).cast("int").alias("pos"), F.col(VALUE))
    if not m.unique:
        cells = cells.groupBy("bi", "bj", "pos").agg(F.sum(VALUE).cast(m.value_type).alias(VALUE))
    # One list of (position, value) pairs: two lists would drop NULLs independently and fall out of step.
    pairs = F.collect_list(F.struct(F.col("pos"), required(F.col(VALUE), m.value_type, VALUE).alias("val")))
    return cells.groupBy("bi", "bj").agg(pairs.alias("cells")).select(
        "bi", "bj", F.col("cells.pos").alias("pos"), F.col("cells.val").alias("val"))


def _stationary(ta: DataFrame, tb: DataFrame, grid: Grid, nb_m: int, nb_n: int, tile: int, vt: str,
                shape: tuple[int, int] | None, levels: int = 0) -> DataFrame:
    """Blocks of the products ``ta·tb`` per path; ``ta(path, bi, bk, …)``, ``tb(path, bk, bj, …)`` with equal tile columns.

    Returns cells when ``shape`` is given and no slabs have to be added, else ``(path, bi, bj, tile)``.
    """
    across, down = -(-nb_n // grid.side_n), -(-nb_m // grid.side_m)
    data = [c for c in ta.columns if c in ("pos", "val", "tile")]
    slab = F.pmod(F.col("bk"), F.lit(grid.slabs)).cast("int").alias("slab")

    def copies(n: int) -> F.Column:
        return F.explode(F.sequence(F.lit(0), F.lit(n - 1)))

    left = ta.select("path", (F.col("bi") / grid.side_m).cast("int").alias("si"), copies(across).alias("sj"), slab, "bk",
                     F.lit(0).alias("side"), F.col("bi").alias("idx"), *data)
    right = tb.select("path", copies(down).alias("si"), (F.col("bj") / grid.side_n).cast("int").alias("sj"), slab, "bk",
                      F.lit(1).alias("side"), F.col("bj").alias("idx"), *data)
    # groups are numbered and dealt in turn, so no task gets more than one group above another
    number = sum((F.shiftright("path", 3 * d).bitwiseAND(F.lit(PATH_BASE - 1)) - 1) * 7 ** d for d in range(levels)) if levels else F.lit(0)
    group = ((number * down + F.col("si")) * across + F.col("sj")) * grid.slabs + F.col("slab")
    groups = 7 ** levels * down * across * grid.slabs
    parts = min(groups, max(_tasks(ta.sparkSession), groups // 64))
    dealt = left.unionByName(right).repartitionById(parts, F.pmod(group, F.lit(parts)).cast("int"))
    dealt = dealt.sortWithinPartitions("path", "si", "sj", "slab", "bk", "side", "idx")
    if shape is not None and grid.slabs == 1:
        return dealt.mapInArrow(stationary_fn(tile, vt, shape), f"row int, col int, value {vt}")
    blocks = dealt.mapInArrow(stationary_fn(tile, vt, None), "path long, bi int, bj int, slab int, tile binary")
    slabs = grid.slabs
    while slabs > FAN_IN:
        blocks = blocks.withColumn("slab", (F.col("slab") / FAN_IN).cast("int")).groupBy("path", "bi", "bj", "slab").applyInPandas(
            sum_tiles_fn(tile, vt, ["path", "bi", "bj", "slab"], None), "path long, bi int, bj int, slab int, tile binary")
        slabs = -(-slabs // FAN_IN)
    if slabs == 1:
        return blocks.drop("slab")
    out = "path long, bi int, bj int, tile binary" if shape is None else f"row int, col int, value {vt}"
    return blocks.groupBy("path", "bi", "bj").applyInPandas(sum_tiles_fn(tile, vt, ["path", "bi", "bj"], shape), out)


def _tasks(spark: SparkSession) -> int:
    return 2 * spark.sparkContext.defaultParallelism


def multiply_blocked(a: Matrix | DataFrame, b: Matrix | DataFrame, *, tile: int = 512) -> Matrix:
    """``A·B`` over dense tiles, output-stationary."""
    a, b = as_matrix(a).with_shape(), as_matrix(b).with_shape()
    if a.n_cols != b.n_rows:
        raise ValueError(f"inner dimensions differ: {a.shape} · {b.shape}")
    vt = result_type(a, b)
    a, b = a.cast(vt), b.cast(vt)
    path = F.lit(0).cast("long").alias("path")
    ta = to_tiles(a, tile).select(path, "bi", F.col("bj").alias("bk"), "pos", "val")
    tb = to_tiles(b, tile).select(path, F.col("bi").alias("bk"), "bj", "pos", "val")
    nb_m, nb_k, nb_n = [-(-x // tile) for x in (a.n_rows, a.n_cols, b.n_cols)]
    grid = plan_grid(nb_m, nb_k, nb_n, tile, _tasks(a.df.sparkSession))
    cells = _stationary(ta, tb, grid, nb_m, nb_n, tile, vt, (a.n_rows, b.n_cols))
    return Matrix(cells, a.n_rows, b.n_cols, unique=True)


def _tile_down(tiles: DataFrame, table: dict, hr: list[int], hc: list[int], tile: int, vt: str) -> DataFrame:
    """Strassen operands over tiles: ``(path, bi, bj, tile)`` with ``7^L`` paths.

    Per level the (up to) four tiles at one place of the quadrants meet in a
    group, one record shuffled per tile, and leave as up to seven sums.
    """
    cur = tiles.select(F.lit(0).cast("long").alias("path"), "bi", "bj", "pos", "val")
    sums = {p: terms for p, terms in enumerate(by_product(table)) if terms}
    for lvl, (h_r, h_c) in enumerate(zip(hr, hc)):
        q = F.when(F.col("bi") >= h_r, 2).otherwise(0) + F.when(F.col("bj") >= h_c, 1).otherwise(0)
        data = ["pos", "val"] if lvl == 0 else ["tile"]
        met = cur.select("path", (F.col("bi") % h_r).cast("int").alias("bi"), (F.col("bj") % h_c).cast("int").alias("bj"), q.alias("q"), *data)
        cur = met.groupBy("path", "bi", "bj").applyInPandas(
            combine_fn(tile, vt, "q", sums, ["path", "bi", "bj"], sparse=lvl == 0), "path long, bi int, bj int, out int, tile binary") \
            .select((F.col("path") * PATH_BASE + F.col("out")).alias("path"), "bi", "bj", "tile")
    return cur


def multiply_strassen_tiled(a: Matrix | DataFrame, b: Matrix | DataFrame, *, tile: int = 512,
                            levels: int = 1) -> Matrix:
    """Strassen over tiles: operands and results are combined per level, the ``7^L`` products are output-stationary."""
    if levels == 0:
        return multiply_blocked(a, b, tile=tile)
    a, b = as_matrix(a).with_shape(), as_matrix(b).with_shape()
    if a.n_cols != b.n_rows:
        raise ValueError(f"inner dimensions differ: {a.shape} · {b.shape}")
    vt = result_type(a, b)
    a, b = a.cast(vt), b.cast(vt)
    nb_m, nb_k, nb_n = [-(-x // tile) for x in (a.n_rows, a.n_cols, b.n_cols)]
    hm, hk, hn = halves(nb_m, levels), halves(nb_k, levels), halves(nb_n, levels)

    left = _tile_down(to_tiles(a, tile), ALPHA, hm, hk, tile, vt).withColumnRenamed("bj", "bk")
    right = _tile_down(to_tiles(b, tile), BETA, hk, hn, tile, vt).withColumnRenamed("bi", "bk")
    grid = plan_grid(hm[-1], hk[-1], hn[-1], tile, _tasks(a.df.sparkSession), products=7 ** levels)
    cur = _stationary(left, right, grid, hm[-1], hn[-1], tile, vt, None, levels)

    sums = {q: terms for q, terms in enumerate(by_result())}
    for h_r, h_c in zip(reversed(hm), reversed(hn)):
        met = cur.select(F.shiftright("path", 3).alias("path"), "bi", "bj",
                         F.col("path").bitwiseAND(F.lit(PATH_BASE - 1)).cast("int").alias("p"), "tile")
        cur = met.groupBy("path", "bi", "bj").applyInPandas(
            combine_fn(tile, vt, "p", sums, ["path", "bi", "bj"], sparse=False), "path long, bi int, bj int, out int, tile binary")
        cur = cur.select("path", (F.col("bi") + F.when(F.col("out") >= 2, h_r).otherwise(0)).cast("int").alias("bi"),
                         (F.col("bj") + F.col("out") % 2 * h_c).cast("int").alias("bj"), "tile")
    cells = cur.filter((F.col("bi") < nb_m) & (F.col("bj") < nb_n)).mapInArrow(
        tile_cells_fn(tile, vt, (a.n_rows, b.n_cols)), f"row int, col int, value {vt}")
    return Matrix(cells, a.n_rows, b.n_cols, unique=True)
