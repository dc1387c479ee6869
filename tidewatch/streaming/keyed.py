"""Features of short series on a stream, with the last rows of each series kept in Spark's state store.

A batch reads and writes the state of the series that it holds rows of, and nothing else: its cost follows its rows, however
many series there are. The state of a series is a ring buffer: as many rows as the widest feature reaches back, each with
its values and the last known values up to it.
"""

from __future__ import annotations

import math
import sys
from collections.abc import Iterator, Sequence

from pyspark import cloudpickle
from pyspark.sql import DataFrame, Row
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from tidewatch.functions.missing import is_floating

# The processor travels with its code, so executors need not have this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

STATE_STORE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def _known(x: float | None) -> float | None:
    return None if x is None or x != x else x


def _divided(top: float | None, bottom: float | None) -> float | None:
    """Float division: x/0 is a signed infinity, 0/0 is missing."""
    if top is None or bottom is None:
        return None
    if bottom == 0:
        return math.copysign(math.inf, top) if top else None
    return _known(float(top) / float(bottom)) if not (math.isinf(top) and math.isinf(bottom)) else None


def _rolled(values: list) -> tuple:
    """Mean, sample standard deviation, minimum and maximum of the values that are not missing."""
    some = [v for v in values if v is not None]
    if not some:
        return None, None, None, None
    mean = sum(some) / len(some)
    std = None
    if len(some) > 1 and math.isfinite(mean):
        std = math.sqrt(math.fsum((v - mean) ** 2 for v in some) / (len(some) - 1))
    return _known(mean), std, min(some), max(some)


class SeriesFeatures(StatefulProcessor):
    """Rolling, lag and difference features of the rows of a series, in their order. Rows that do not come after the
    newest one of the series, or have no place in the order, come back as late ones without features."""

    def __init__(
        self,
        order: Sequence[int],
        values: Sequence[int],
        floating: Sequence[bool],
        windows: Sequence[int],
        lags: Sequence[int],
        state: str,
        names: Sequence[str],
    ):
        self.order, self.values, self.floating = list(order), list(values), list(floating)
        self.windows, self.lags, self.schema, self.names = list(windows), list(lags), state, list(names)
        self.reach = max([w - 1 for w in windows] + list(lags) + [1])

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.state = handle.getListState("last", self.schema)
        self.made = Row(*self.names)

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:  # noqa: ANN001, N802, N803
        k, m = len(self.order), len(self.values)
        ring = [tuple(r) for r in self.state.get()] if self.state.exists() else []
        newest = ring[-1][:k] if ring else None
        n_features = m * (4 * len(self.windows) + len(self.lags) + 2)
        fresh = []
        for row in rows:
            place = tuple(row[i] for i in self.order)
            if None in place or (newest is not None and place <= newest):
                yield self.made(*row, True, *[None] * n_features)
            else:
                fresh.append((place, row))
        # What a micro-batch holds of one short series.
        fresh.sort(key=lambda p: p[0])
        for place, row in fresh:
            now = [_known(row[i]) for i in self.values]
            before = ring[-1][k + m :] if ring else (None,) * m
            filled = [b if v is None else v for v, b in zip(now, before)]
            ring.append((*place, *now, *filled))
            yield self.made(*row, False, *self._features(ring, k, m))
            del ring[: -(self.reach + 1)]
        if fresh:
            self.state.put(ring)

    def _features(self, ring: list[tuple], k: int, m: int) -> Iterator:
        def back(n: int, column: int):  # noqa: ANN202
            return ring[-1 - n][column] if n < len(ring) else None

        for c in range(k, k + m):
            for w in self.windows:
                yield from _rolled([r[c] for r in ring[-w:]])
        for c in range(k, k + m):
            for n in self.lags:
                yield back(n, c)
        for c, floating in zip(range(k, k + m), self.floating):
            now, earlier = ring[-1][c], back(1, c)
            change = None if now is None or earlier is None else now - earlier
            yield _known(change) if floating else change
            ratio = _divided(ring[-1][c + m], back(1, c + m))
            yield None if ratio is None else ratio - 1

    def close(self) -> None:
        pass


def with_keyed_features(
    rows: DataFrame, like: DataFrame, windows: Sequence[int], lags: Sequence[int], columns: list[str], order: list[str], keys: list[str]
) -> DataFrame:
    """The rows of a stream with ``__late`` and the features; ``like`` is an empty table with the columns of the result."""
    rows.sparkSession.conf.set("spark.sql.streaming.stateStore.providerClass", STATE_STORE)
    types = {f.name: f.dataType.simpleString() for f in rows.schema}
    place = {c: i for i, c in enumerate(rows.columns)}
    state = [f"o{i} {types[c]}" for i, c in enumerate(order)]
    state += [f"{part}{i} {types[c]}" for part in "vf" for i, c in enumerate(columns)]
    features = [f for f in like.schema if f.name not in place]
    schema = [f"`{c}` {t}" for c, t in types.items()] + ["__late boolean"]
    schema += [f"`{f.name}` {f.dataType.simpleString()}" for f in features]
    processor = SeriesFeatures(
        [place[c] for c in order],
        [place[c] for c in columns],
        [is_floating(rows, c) for c in columns],
        windows,
        lags,
        ", ".join(state),
        [*rows.columns, "__late", *[f.name for f in features]],
    )
    return rows.groupBy(*keys).transformWithState(processor, ", ".join(schema), "Append", "None")
