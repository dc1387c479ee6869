"""ROWS windows over long ordered tables.

Rolling statistics, lags and forward fills look at neighbouring *rows* of one ordered series, and by default the
whole table is that series. ``Window.orderBy`` alone sends every row to one task, and ``partitionBy(series)`` does
the same to the rows of a hot series. ``over_rows`` therefore works in blocks: range-partition and sort by (series,
order), number the rows, cut the numbering into equal blocks, copy the few rows that a neighbour block has to see (the
halo), and run the windows per block. The range partitioner splits on the full, unique sort key, so a hot series or a hot
day spreads over many tasks.

A caller who knows every series to be short (``DAILY``) gets plain windows with the same results; then there are at most
as many tasks as series.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from tidewatch.sources.staging import stage

ROW = "__row"
BLOCK = "__block"
_HOME = "__home"
_PART = "__part"
_POSITION_BITS = 33  # monotonically_increasing_id keeps the row position in its lower 33 bits


@dataclass(frozen=True)
class Layout:
    """How ordered windows are spread over tasks.

    ``in_blocks=False`` states that every series is short (one row per day, say), so that plain windows do.
    ``block_rows``: most rows per block; smaller tables use smaller blocks so that every core gets some.
    """

    in_blocks: bool = True
    block_rows: int = 1_000_000


# One row per series and day: a century is 36,525 rows. At most as many tasks as series.
DAILY = Layout(in_blocks=False)
SPREAD = Layout()


class Frame:
    """The window vocabulary handed to a builder; the builder does not see which layout is in use."""

    def __init__(self, spec: WindowSpec, fills: dict[str, str]):
        self.order = spec
        self.layers: list[dict[str, Column]] = []
        self._fills = fills

    def rows(self, back: int, ahead: int = 0) -> WindowSpec:
        return self.order.rowsBetween(-back, ahead)

    def filled(self, name: str) -> Column:
        """Last non-missing value of a declared fill source, up to and including this row."""
        return F.col(f"`{self._fills[name]}`")

    def once(self, windowed: Column) -> Column:
        """A window expression that several results use; written in place it would be evaluated for each of them."""
        return self.at(0, windowed)

    def at(self, level: int, windowed: Column) -> Column:
        """A shared window expression over columns of lower levels."""
        while len(self.layers) <= level:
            self.layers.append({})
        name = f"__shared_{level}_{len(self.layers[level])}"
        self.layers[level][name] = windowed
        return F.col(name)


Builder = Callable[[Frame], dict[str, Column]]


def over_rows(
    df: DataFrame,
    build: Builder,
    *,
    order_by: Sequence[str],
    partition_by: Sequence[str] = (),
    lookback: int = 0,
    lookahead: int = 0,
    fill: dict[str, Column] | None = None,
    layout: Layout = Layout(),
) -> DataFrame:
    """Append the columns that ``build`` makes from row windows.

    ``order_by`` must be unique within a series; missing order keys come last. ``lookback`` and ``lookahead`` are the
    widest reach of any window in ``build``. ``fill`` declares forward-fill sources, whose reach is unlimited.
    """
    fill = fill or {}
    run = _blocked if layout.in_blocks else _plain
    return run(df, build, list(order_by), list(partition_by), lookback, lookahead, fill, layout)


def index_rows(df: DataFrame, order_by: Sequence[str], partition_by: Sequence[str] = ()) -> DataFrame:
    """Add ``__row``, the 0-based position of each row in (partition_by, order_by) order over the whole table.

    One range shuffle. The position inside a sorted partition comes from ``monotonically_increasing_id``; the number
    of rows in front of a partition from a table with one row per partition. The sorted table is staged because the
    range boundaries are drawn anew whenever the plan is run again.
    """
    return _numbered(_sorted(df, order_by, partition_by))


def _sorted(df: DataFrame, order_by: Sequence[str], partition_by: Sequence[str]) -> DataFrame:
    """The staged rows in order, ``__row`` holding the partition and the position in it."""
    keys = [F.col(f"`{k}`").asc_nulls_last() for k in [*partition_by, *order_by]]
    ranged = df.repartitionByRange(*keys).sortWithinPartitions(*keys)
    return stage(ranged.withColumn(ROW, F.monotonically_increasing_id()), "ordered")


def _numbered(staged: DataFrame) -> DataFrame:
    part = F.shiftright(F.col(ROW), _POSITION_BITS)
    position = F.col(ROW).bitwiseAND(F.lit((1 << _POSITION_BITS) - 1))
    sizes = staged.groupBy(part.alias(_PART)).count()
    before = F.sum("count").over(Window.orderBy(_PART)) - F.col("count")
    starts = sizes.select(_PART, before.alias("__start"))
    # One row per range partition, so its size is fixed by the shuffle width, not by the data.
    return (
        staged.withColumn(_PART, part)
        .join(F.broadcast(starts), _PART)
        .withColumn(ROW, F.col("__start") + position)
        .drop(_PART, "__start")
    )


def _plain(df, build, order_by, partition_by, lookback, lookahead, fill, layout) -> DataFrame:
    spec = Window.partitionBy(*partition_by).orderBy(*[F.col(f"`{k}`").asc_nulls_last() for k in order_by])
    so_far = spec.rowsBetween(Window.unboundedPreceding, 0)
    names = {name: f"__fill_{name}" for name in fill}
    filled = {names[name]: F.last(source, ignorenulls=True).over(so_far) for name, source in fill.items()}
    ready = df.withColumns(filled) if filled else df
    return _append(ready, build, Frame(spec, names)).drop(*names.values())


def _append(df: DataFrame, build: Builder, frame: Frame) -> DataFrame:
    results, ready = build(frame), df
    for layer in frame.layers:
        ready = ready.withColumns(layer) if layer else ready
    return ready.withColumns(results).drop(*[name for layer in frame.layers for name in layer])


def _blocked(df, build, order_by, partition_by, lookback, lookahead, fill, layout) -> DataFrame:
    staged = _sorted(df, order_by, partition_by)
    size = _block_size(staged, lookback + lookahead, layout)
    rows = _numbered(staged).withColumn(_HOME, F.expr(f"{ROW} div {size}"))

    # Every row goes to its own block; rows near an edge also go to the neighbour that looks at them.
    offset, nowhere = F.col(ROW) % size, F.array().cast("array<bigint>")
    targets = F.array(_HOME)
    if lookback:
        targets = F.concat(targets, F.when(offset >= size - lookback, F.array(F.col(_HOME) + 1)).otherwise(nowhere))
    if lookahead:
        targets = F.concat(targets, F.when(offset < lookahead, F.array(F.col(_HOME) - 1)).otherwise(nowhere))
    blocked = rows.withColumn(BLOCK, F.explode(targets))

    spec = Window.partitionBy(BLOCK, *partition_by).orderBy(ROW)
    names = {name: f"__fill_{name}" for name in fill}
    if fill:
        blocked = blocked.join(_carried(rows, fill, partition_by, size, lookback), BLOCK, "left")
        so_far = spec.rowsBetween(Window.unboundedPreceding, 0)
        filled = {}
        for name, source in fill.items():
            carried = F.col(f"__carry_{name}")
            same_series = F.lit(True)
            for i, key in enumerate(partition_by):
                same_series = same_series & F.col(f"`{key}`").eqNullSafe(carried[f"k{i}"])
            filled[names[name]] = F.coalesce(
                F.last(source, ignorenulls=True).over(so_far), F.when(same_series, carried["v"])
            )
        blocked = blocked.withColumns(filled)

    out = _append(blocked, build, Frame(spec, names)).where(F.col(BLOCK) == F.col(_HOME))
    return out.drop(ROW, BLOCK, _HOME, *names.values(), *[f"__carry_{name}" for name in fill])


def _block_size(staged: DataFrame, halo: int, layout: Layout) -> int:
    """Even shares for two rounds of tasks, at most ``block_rows``, and never so small that the halo dominates."""
    share = staged.count() // (2 * staged.sparkSession.sparkContext.defaultParallelism) + 1
    return max(min(share, layout.block_rows), 4 * halo, 1)


def _carried(rows: DataFrame, fill: dict[str, Column], partition_by: list[str], size: int, lookback: int) -> DataFrame:
    """Per block, the last non-missing fill value in front of the block and its halo, with the series it came from.

    Rows are numbered series by series, so the last value before a position belongs to the series at that position
    or that series has none yet; comparing the series decides. The running window sees one row per block,
    a millionth of the rows at full block size.
    """
    outside_halo = (F.col(ROW) % size) < size - lookback
    columns = []
    for name, source in fill.items():
        keys = [F.col(f"`{k}`").alias(f"k{i}") for i, k in enumerate(partition_by)]
        held = F.struct(*keys, source.alias("v"))
        known = source.isNotNull()
        columns.append(F.max_by(held, F.when(known, F.col(ROW))).alias(f"__all_{name}"))
        columns.append(F.max_by(held, F.when(known & outside_halo, F.col(ROW))).alias(f"__head_{name}"))
    per_block = rows.groupBy(F.col(_HOME).alias(BLOCK)).agg(*columns)

    in_order = Window.orderBy(BLOCK)
    older = in_order.rowsBetween(Window.unboundedPreceding, -2)
    carried = [
        F.coalesce(
            F.lag(f"__head_{name}", 1).over(in_order),
            F.last(f"__all_{name}", ignorenulls=True).over(older),
        ).alias(f"__carry_{name}")
        for name in fill
    ]
    return per_block.select(BLOCK, *carried)
