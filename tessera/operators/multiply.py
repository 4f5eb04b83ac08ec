"""C = A·B in coordinate form: join on the inner index, sum the products.

Plan: ``A(i,k,u) ⋈ B(k,j,v)`` on ``k`` → ``u·v`` → ``groupBy(i, j).sum``.
Catalyst puts the product inside the join's codegen stage and splits the
sum into a map-side partial aggregate and a final one, so only one record
per distinct ``(i, j)`` per join task is shuffled.  Both sides are
projected to one ``(key, other, val)`` layout, so a self-product (``QᵀQ``)
scans, aggregates and shuffles its operand once (``ReusedExchange``).

Scale decisions, all made from facts rather than estimates:

* **Broadcast** a side only behind a proven bound: with unique coordinates a
  matrix holds at most ``n_rows·n_cols`` cells.  Nothing is counted for it; any
  other side is shuffled on ``k`` and merged, by hint: Spark's own estimate
  follows the size of the files, and operands that Strassen's levels multiply,
  or one row per key, outgrow it many times in the driver that broadcasts them.
* **Spread**: when one side is broadcast and the other is proven small too,
  the streamed side is hash-partitioned by its outer index, so the products
  use every task and the final ``groupBy(i, j)`` needs no shuffle.
* **Work-balanced keys** (``skew="route"``, the default): the number of
  products a key makes, ``left cells × right cells``, is counted in the same
  plan.  Both sides are shuffled on ``k`` once; counting per key needs no
  further shuffle, and Spark reuses that exchange for the join, so operands are
  computed once and no job runs before the product's own.  Keys with more
  products than one task's budget (fewer than tasks can have that, a proven
  bound) form a small table of routes, joined to both sides: light keys meet
  where they are, a heavy key's cells are dealt to a grid of ``a × b`` buckets
  by hashes of their outer indices, each left cell copied to ``b`` of them and
  each right cell to ``a``.  Every product is formed exactly once and no task
  gets more of a key than its budget.  ``skew="aqe"`` leaves skew to runtime
  splitting alone.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..matrix import COL, ROW, VALUE, Matrix, as_matrix

# Defaults of the size rules below.
DEFAULT_BROADCAST_CELLS = 1_000_000      # ≈ 32 MB of (k, j, v) rows
DEFAULT_PRODUCTS_PER_TASK = 20_000_000   # products one salted task should form
SPREAD_CELLS = 16_000_000                # a streamed side this small may be re-spread by row


@dataclass(frozen=True)
class HotKey:
    k: int
    left_cells: int
    right_cells: int
    left_buckets: int
    right_buckets: int

    @property
    def salts(self) -> int:
        return self.left_buckets * self.right_buckets


def _inner_dim(a: Matrix, b: Matrix) -> None:
    if a.n_cols is not None and b.n_rows is not None and a.n_cols != b.n_rows:
        raise ValueError(f"inner dimensions differ: {a.shape} · {b.shape}")


def result_type(a: Matrix, b: Matrix) -> str:
    return "bigint" if a.value_type == "bigint" and b.value_type == "bigint" else "double"


def _default_tasks(df: DataFrame) -> int:
    return 4 * df.sparkSession.sparkContext.defaultParallelism


def _product_tasks(df: DataFrame) -> int:
    """Partitions of the shuffle on the key, by number: products outgrow the cells that are shuffled.

    Left to its own, adaptive execution merges partitions by the bytes of the
    cells, down to a task a core, and one task then sums all their products.
    """
    return max(_default_tasks(df), int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))


def _key_cells(side: DataFrame, name: str) -> DataFrame:
    """Cells per key.  The checksum reads every column, so that the exchange below is the join's own and is reused."""
    return side.groupBy("key").agg(F.count(F.lit(1)).alias(name),
                                   F.bit_xor(F.xxhash64("other", "val")).alias(f"{name}_sum"))


def join_statistics(left: DataFrame, right: DataFrame) -> DataFrame:
    """Per inner key: cells on each side and the number of products ``work``.

    One row per key is as long as the operands: merged where the keys already
    lie, never broadcast, whatever the planner guesses from file sizes.
    """
    st = _key_cells(left, "left_cells").join(_key_cells(right, "right_cells").hint("merge"), "key")
    st = st.filter(F.col("left_cells_sum").isNotNull() & F.col("right_cells_sum").isNotNull())
    return st.select("key", "left_cells", "right_cells",
                     (F.col("left_cells").cast("double") * F.col("right_cells")).alias("work"))


def routes(left: DataFrame, right: DataFrame, *, min_products_per_task: int = DEFAULT_PRODUCTS_PER_TASK,
           tasks: int | None = None) -> DataFrame:
    """Heavy keys with their grids: ``key, left_cells, right_cells, left_buckets, right_buckets``; lazy.

    The budget is ``max(min_products_per_task, total/tasks)``, so fewer than
    ``tasks`` keys (default 4 × parallelism) can exceed it: their shares sum
    to one.  With ``c = sqrt(budget)`` a bucket gets about ``c`` left cells,
    and as many right cells as the budget allows beside them.
    """
    if tasks is None:
        tasks = _default_tasks(left)
    st = join_statistics(left, right)
    total = st.agg(F.coalesce(F.sum("work"), F.lit(0.0)).alias("total")).scalar()
    budget = F.greatest(F.lit(float(min_products_per_task)), total / F.lit(float(tasks)))
    heavy = st.withColumn("budget", budget).filter(F.col("work") > F.col("budget"))
    heavy = heavy.withColumn("left_buckets", F.ceil(F.col("left_cells") / F.sqrt("budget")).cast("int"))
    beside = F.col("right_cells") * F.col("left_cells") / F.col("left_buckets")
    return heavy.select("key", "left_cells", "right_cells", "left_buckets",
                        F.greatest(F.lit(1), F.ceil(beside / F.col("budget"))).cast("int").alias("right_buckets"))


def find_hot_keys(a: Matrix, b: Matrix, *, min_products_per_task: int = DEFAULT_PRODUCTS_PER_TASK,
                  tasks: int | None = None) -> list[HotKey]:
    """The heavy inner keys of ``a·b``, as a list (for inspection; :func:`multiply` joins them as a table)."""
    vt = result_type(a, b)
    got = routes(_side(a, COL, ROW, vt), _side(b, ROW, COL, vt), min_products_per_task=min_products_per_task, tasks=tasks)
    return [HotKey(*map(int, r)) for r in got.collect()]


def _dealt(side: DataFrame, heavy: DataFrame, own: str, other: str) -> DataFrame:
    """The heavy keys' cells of one side, copied to the buckets of their grids.

    A bucket is ``x·right_buckets + y``, for the hash ``x`` of the left outer index and ``y`` of the right one.
    """
    mine = F.pmod(F.hash("other"), F.col(own))
    every = F.sequence(F.lit(0), F.col(other) - 1)
    if own == "left_buckets":
        bucket = F.transform(every, lambda y: mine * F.col("right_buckets") + y)
    else:
        bucket = F.transform(every, lambda x: x * F.col("right_buckets") + mine)
    return side.join(F.broadcast(heavy), "key").select("key", "other", "val", F.explode(bucket).alias("salt"))


def _pairs(left: DataFrame, right: DataFrame, keys: list[str], upper: bool, how: str | None = None) -> DataFrame:
    """``(i, j, p)`` of the cells that meet; ``upper`` keeps ``i ≤ j``, ``how`` is a join hint."""
    l, r = left.alias("l"), right.alias("r")
    if how:
        r = r.hint(how)
    cond = [F.col(f"l.{k}") == F.col(f"r.{k}") for k in keys]
    if upper:
        cond.append(F.col("l.other") <= F.col("r.other"))
    return l.join(r, cond).select(F.col("l.other").alias("i"), F.col("r.other").alias("j"),
                                  (F.col("l.val") * F.col("r.val")).alias("p"))


def _routed_pairs(left: DataFrame, right: DataFrame, upper: bool, hot_keys: list[HotKey] | None, **opts) -> DataFrame:
    """:func:`_pairs` with light keys where the shuffle on the key put them and heavy ones dealt over their grids."""
    n = _product_tasks(left)
    left, right = left.repartition(n, "key"), right.repartition(n, "key")
    if hot_keys is None:
        heavy = routes(left, right, **opts).select("key", "left_buckets", "right_buckets")
    else:
        heavy = left.sparkSession.createDataFrame([(h.k, h.left_buckets, h.right_buckets) for h in hot_keys],
                                                  "key long, left_buckets int, right_buckets int")
    # fewer rows than tasks: bounded
    light = _pairs(left.join(F.broadcast(heavy.select("key")), "key", "left_anti"), right, ["key"], upper, "merge")
    return light.unionByName(_pairs(_dealt(left, heavy, "left_buckets", "right_buckets"),
                                    _dealt(right, heavy, "right_buckets", "left_buckets"), ["key", "salt"], upper, "merge"))


def _side(m: Matrix, key: str, other: str, vt: str) -> DataFrame:
    """Join input with one fixed column layout (``key, other, val``).

    Both operands of a self-product (``Q·Qᵀ``, ``QᵀQ``) then have the same
    canonical plan, so Spark scans, aggregates and shuffles the shared
    operand once and reuses the exchange for the other side.
    """
    return m.df.select(F.col(key).alias("key"), F.col(other).alias("other"), F.col(VALUE).cast(vt).alias("val"))


def _cell_bound(m: Matrix) -> int | None:
    """A proven upper bound on the cells of ``m``: its shape, if coordinates are unique."""
    return m.max_cells if m.unique else None


def _known_options(opts: dict) -> None:
    unknown = set(opts) - {"min_products_per_task", "tasks"}
    if unknown:
        raise TypeError(f"unknown options: {', '.join(sorted(unknown))}")


def _spread(side: DataFrame, m: Matrix, bound: int | None) -> DataFrame:
    """Hash-partition a proven-small streamed side by its outer index.

    A broadcast join runs one task per streamed partition, and a small table
    can arrive in a single partition with every product in one task.  Spread
    by the outer index, each output cell's partial sums meet in one task, so
    the final ``groupBy(i, j)`` needs no further shuffle (hash partitioning on
    ``i`` already clusters ``(i, j)``): the join output, which is larger than
    its input, is never shuffled.  Only under a proven bound, so this shuffle
    is bounded too.  (Asking the plan for its partition count is avoided on
    purpose: with adaptive execution that runs the plan.)
    """
    if bound is None or bound > SPREAD_CELLS:
        return side
    par = side.sparkSession.sparkContext.defaultParallelism
    return side.repartition(par, "other")


def _check_skew(skew: str, opts: dict) -> None:
    if skew not in ("route", "salt", "aqe"):
        raise ValueError(f"unknown skew handling {skew!r}")
    _known_options(opts)


def _summed(products: DataFrame, vt: str) -> DataFrame:
    return products.groupBy("i", "j").agg(F.sum("p").cast(vt).alias(VALUE))


def products(a: Matrix | DataFrame, b: Matrix | DataFrame, *, broadcast_cells: int = DEFAULT_BROADCAST_CELLS,
             skew: str = "route", hot_keys: list[HotKey] | None = None, **route_opts) -> DataFrame:
    """The scalar products ``(i, j, p)`` of ``A·B``, one per pair of cells that share an inner index."""
    a, b = as_matrix(a), as_matrix(b)
    _inner_dim(a, b)
    _check_skew(skew, route_opts)
    vt = result_type(a, b)
    left, right = _side(a, COL, ROW, vt), _side(b, ROW, COL, vt)
    if not hot_keys:
        bound_a, bound_b = _cell_bound(a), _cell_bound(b)
        if bound_b is not None and bound_b <= broadcast_cells:
            return _pairs(_spread(left, a, bound_a), F.broadcast(right), ["key"], False)
        if bound_a is not None and bound_a <= broadcast_cells:
            return _pairs(F.broadcast(left), _spread(right, b, bound_b), ["key"], False)
    # Heavy keys only matter when the join shuffles on k: a broadcast join has no key exchange to skew.
    if skew == "aqe" and not hot_keys:
        return _pairs(left, right, ["key"], False)
    return _routed_pairs(left, right, False, hot_keys or None, **route_opts)


def multiply(a: Matrix | DataFrame, b: Matrix | DataFrame, **opts) -> Matrix:
    """Standard multiplication ``C[i,j] = Σ_k A[i,k]·B[k,j]`` (coordinate form).

    Output cells are the ``(i, j)`` with at least one matching ``k``.  Works
    for rectangular operands and for ``A·A``.  ``opts`` are those of
    :func:`products`: ``skew`` is ``"route"`` (count and balance work per key
    in the plan, as the module says; ``"salt"`` is the same) or ``"aqe"``
    (leave runtime splitting to adaptive execution); ``hot_keys`` gives the
    heavy keys instead of counting; ``min_products_per_task`` and ``tasks`` go
    to :func:`routes`, and unknown names are refused.
    """
    a, b = as_matrix(a), as_matrix(b)
    out = _summed(products(a, b, **opts), result_type(a, b))
    return Matrix(out.select(F.col("i").alias(ROW), F.col("j").alias(COL), VALUE), a.n_rows, b.n_cols, unique=True)


def gram(m: Matrix | DataFrame, *, transpose_first: bool = False,
         broadcast_cells: int = DEFAULT_BROADCAST_CELLS, skew: str = "route", **route_opts) -> Matrix:
    """``M·Mᵀ`` (rows against rows), or ``MᵀM`` with ``transpose_first``.

    The product is symmetric, so only the pairs with ``i ≤ j`` are formed
    and summed; each off-diagonal cell is then emitted as ``(i, j)`` and
    ``(j, i)`` by a narrow explode.  Half the products, half the aggregation
    and half the final shuffle of :func:`multiply`, with the same cells and
    the same broadcast / spread / routing decisions (both join sides are one
    DataFrame, so Spark also reads and shuffles the operand only once).
    """
    m = as_matrix(m)
    vt = m.value_type
    key, outer = (ROW, COL) if transpose_first else (COL, ROW)
    n_out = m.n_cols if transpose_first else m.n_rows
    side = _side(m, key, outer, vt)
    _check_skew(skew, route_opts)
    bound = _cell_bound(m)
    if bound is not None and bound <= broadcast_cells:
        pairs = _pairs(_spread(side, m, bound), F.broadcast(side), ["key"], True)
    elif skew == "aqe":
        pairs = _pairs(side, side, ["key"], True)
    else:
        pairs = _routed_pairs(side, side, True, None, **route_opts)
    upper = _summed(pairs, vt)
    both = F.when(F.col("i") < F.col("j"),
                  F.array(F.struct(F.col("i").alias("r"), F.col("j").alias("c")),
                          F.struct(F.col("j").alias("r"), F.col("i").alias("c")))) \
        .otherwise(F.array(F.struct(F.col("i").alias("r"), F.col("j").alias("c"))))
    out = upper.select(F.explode(both).alias("rc"), VALUE) \
        .select(F.col("rc.r").alias(ROW), F.col("rc.c").alias(COL), VALUE)
    return Matrix(out, n_out, n_out, unique=True)
