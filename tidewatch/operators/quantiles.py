"""Exact quantiles of columns that no single task can hold.

The wanted ranks are found by narrowing: an approximate percentile proposes real values around the rank, counts say
between which of them the rank lies, and the search goes on in that open interval. Every round shrinks the interval by
about the accuracy, a value that repeats often is recognised by its own count, and only scalars reach the driver. What
all open intervals together still hold, ``exact_rows`` values at most, is sorted at the end, each interval by itself.

The sketches bound how many values an interval can hold. Where that is little enough, and it is up to hundreds of millions
of values, the scan that counts gathers them too, so that two scans do: one for counts and cuts, one for the rest.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewatch.functions.missing import value

EXACT_ROWS = 200_000
ACCURACY = 10_000
# Distance of the proposed cuts from a rank, in errors of the sketch.
SLACK = 2.0


@dataclass
class _Search:
    """The open interval (low, high) that holds the value of one 0-based rank.

    ``below`` values lie at or under ``low`` and ``upto`` values lie under ``high``.
    """

    column: str
    rank: int
    upto: int
    below: int = 0
    low: float | None = None
    high: float | None = None
    found: float | None = None

    @property
    def inside(self) -> int:
        return self.upto - self.below

    @property
    def interval(self) -> tuple:
        return self.column, self.low, self.high

    def member(self) -> Column:
        """The column's value where it lies in the interval, missing elsewhere."""
        x = F.col(f"`{self.column}`")
        keep = x.isNotNull()
        if self.low is not None:
            keep = keep & (x > F.lit(self.low))
        if self.high is not None:
            keep = keep & (x < F.lit(self.high))
        return F.when(keep, x)

    def compare(self, cut: float, less: int, at_most: int) -> None:
        """Use that ``less`` values of the column are below ``cut`` and ``at_most`` values are not above it."""
        if self.rank < less:
            if less < self.upto:
                self.high, self.upto = cut, less
        elif self.rank < at_most:
            self.found = cut
        elif at_most > self.below:
            self.low, self.below = cut, at_most


def exact_quantiles(
    df: DataFrame,
    columns: list[str],
    probabilities: list[float],
    *,
    exact_rows: int = EXACT_ROWS,
    accuracy: int = ACCURACY,
) -> dict[str, list[float | None]]:
    """Linear-interpolated quantiles of the non-missing values, ``None`` for a column without values.

    Columns must be numeric; cast dates to a number first.
    """
    if not columns:
        return {}
    values = df.select(*[value(df, c).cast("double").alias(c) for c in columns])
    slack = SLACK / accuracy
    near = [min(1.0, max(0.0, p + d)) for p in probabilities for d in (-slack, slack)]
    sketches = [
        F.percentile_approx(F.col(f"`{c}`"), F.array(*[F.lit(p) for p in near]), F.lit(accuracy)).alias(f"p{i}")
        for i, c in enumerate(columns)
    ]
    first = values.agg(*[F.count(F.col(f"`{c}`")).alias(f"n{i}") for i, c in enumerate(columns)], *sketches).first()
    counts = {c: first[f"n{i}"] for i, c in enumerate(columns)}
    wanted = {}
    for c in columns:
        for p in probabilities:
            position = (counts[c] - 1) * p
            for rank in {math.floor(position), math.ceil(position)}:
                if counts[c]:
                    wanted.setdefault((c, rank), _Search(c, rank, counts[c]))
    brackets = set()
    for i, c in enumerate(columns):
        proposed = first[f"p{i}"] or []
        brackets |= {(c, low, high) for low, high in zip(proposed[::2], proposed[1::2])}
    if brackets:
        _narrow(values, list(wanted.values()), sorted(brackets), exact_rows, accuracy)
    _solve(values, list(wanted.values()), exact_rows, accuracy)

    out: dict[str, list[float | None]] = {}
    for c in columns:
        out[c] = []
        for p in probabilities:
            if not counts[c]:
                out[c].append(None)
                continue
            position = (counts[c] - 1) * p
            lower = wanted[c, math.floor(position)].found
            upper = wanted[c, math.ceil(position)].found
            share = position - math.floor(position)
            out[c].append(lower if lower == upper else lower + (upper - lower) * share)
    return out


def value_at_rank(df: DataFrame, column: str, rank: int, *, exact_rows: int = EXACT_ROWS) -> float | None:
    """The value at a 0-based rank among the non-missing values of one numeric column."""
    values = df.select(value(df, column).cast("double").alias(column))
    total = values.agg(F.count(F.col(f"`{column}`"))).first()[0]
    if not 0 <= rank < total:
        return None
    search = _Search(column, rank, total)
    _solve(values, [search], exact_rows, ACCURACY)
    return search.found


def _narrow(
    values: DataFrame, searches: list[_Search], brackets: list[tuple[str, float, float]], exact_rows: int, accuracy: int
) -> None:
    """Count at the ends of the brackets and, if these must hold few values, gather what lies inside."""
    cuts = sorted({(c, cut) for c, low, high in brackets for cut in (low, high)})
    # Inside a bracket lie its slack on both sides and the error of both ends.
    most = {s.column: s.upto for s in searches}
    gather = sum(2 * (SLACK + 1) / accuracy * most[c] for c, _, _ in brackets) <= exact_rows
    measures = []
    for c, cut in cuts:
        measures += [F.count_if(F.col(f"`{c}`") < cut), F.count_if(F.col(f"`{c}`") <= cut)]
    if gather:
        measures += [F.collect_list(_Search(c, 0, 0, 0, low, high).member()) for c, low, high in brackets]
    row = values.agg(*[m.alias(f"m{i}") for i, m in enumerate(measures)]).first()
    for i, (column, cut) in enumerate(cuts):
        for s in searches:
            if s.column == column and s.found is None:
                s.compare(cut, row[2 * i], row[2 * i + 1])
    held = dict(zip(brackets, row[2 * len(cuts) :]))
    for s in searches:
        if s.found is not None or s.low is None or s.high is None:
            continue
        for (column, low, high), inside in held.items():
            if column == s.column and low <= s.low and s.high <= high:
                s.found = sorted(x for x in inside if s.low < x < s.high)[s.rank - s.below]
                break


def _solve(values: DataFrame, searches: list[_Search], exact_rows: int, accuracy: int) -> None:
    slack = SLACK / accuracy
    while wide := _too_wide(searches, exact_rows):
        # One sketch per interval proposes cuts on both sides of every rank in it.
        shared = _by_interval(wide)
        proposals = []
        for i, group in enumerate(shared):
            shares = [(s.rank - s.below) / s.inside for s in group]
            near = sorted({min(1.0, max(0.0, c + d)) for c in shares for d in (-slack, slack)})
            wanted = F.array(*[F.lit(p) for p in near])
            proposals.append(F.percentile_approx(group[0].member(), wanted, F.lit(accuracy)).alias(f"p{i}"))
        proposed = values.agg(*proposals).first()

        cuts = sorted({(group[0].column, cut) for i, group in enumerate(shared) for cut in proposed[f"p{i}"]})
        counts = []
        for i, (column, cut) in enumerate(cuts):
            x = F.col(f"`{column}`")
            counts += [F.count_if(x < cut).alias(f"less{i}"), F.count_if(x <= cut).alias(f"at_most{i}")]
        counted = values.agg(*counts).first()
        for s in wide:
            for i, (column, cut) in enumerate(cuts):
                if column == s.column and s.found is None:
                    s.compare(cut, counted[f"less{i}"], counted[f"at_most{i}"])

    rest = _by_interval([s for s in searches if s.found is None])
    if rest:
        # One row for each value and each of the few intervals that hold it; a task sorts whole intervals.
        members = F.array(*[F.struct(F.lit(i).alias("i"), group[0].member().alias("x")) for i, group in enumerate(rest)])
        held = values.select(F.explode(F.filter(members, lambda m: m["x"].isNotNull())).alias("m")).groupBy("m.i")
        ranks = {i: [s.rank - s.below + 1 for s in group] for i, group in enumerate(rest)}
        for row in held.agg(F.sort_array(F.collect_list("m.x")).alias("x")).select("i", *_picks(ranks)).collect():
            for s, v in zip(rest[row["i"]], row["picks"]):
                s.found = v


def _picks(ranks: dict[int, list[int]]) -> list[Column]:
    """The values at the wanted 1-based ranks of each interval."""
    wanted = F
    for i, places in ranks.items():
        wanted = wanted.when(F.col("i") == i, F.array(*[F.get("x", F.lit(p - 1)) for p in places]))
    return [wanted.alias("picks")]


def _too_wide(searches: list[_Search], exact_rows: int) -> list[_Search]:
    """The open searches that must narrow until all intervals hold ``exact_rows`` together."""
    groups = _by_interval([s for s in searches if s.found is None])
    share = exact_rows // len(groups) if groups else 0
    return [s for group in groups for s in group if s.inside > max(share, 1)]


def _by_interval(searches: list[_Search]) -> list[list[_Search]]:
    groups: dict[tuple, list[_Search]] = {}
    for s in searches:
        groups.setdefault(s.interval, []).append(s)
    return list(groups.values())
