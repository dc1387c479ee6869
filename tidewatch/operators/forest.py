"""Isolation Forest (Liu, Ting, Zhou 2008) trained and scored on Spark.

Training draws for every tree ``psi`` rows of the whole table. Rows are reduced to a digest and a count, which is all that
is shuffled: the copies of a digest have one slot for each copy and tree, geometric gaps between hashes say which of them
are candidates, each tree takes the candidates of smallest hash, and only then the few chosen rows are read. A tree grows
in its own task. The fitted trees are a small node table; scoring sends them to the executors and descends all rows of an
Arrow batch together. Nothing depends on the partition layout: equal rows and seed give equal forests. All chance comes
from MD5 digests of texts, so that SQL can draw the same samples and grow the same trees.
"""

from __future__ import annotations

import hashlib
import math
import sys
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field, replace

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidewatch.functions.missing import all_finite, finite_value
from tidewatch.operators.quantiles import EXACT_ROWS, exact_quantiles
from tidewatch.sources.staging import stage

# The functions that run in Python workers travel with their code, so executors need not have this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

NODE_SCHEMA = (
    "tree int, node int, depth int, feature int, split double, left int, right int, size int, path_length double"
)
_NODE_TYPES = pa.schema(
    [
        ("tree", pa.int32()),
        ("node", pa.int32()),
        ("depth", pa.int32()),
        ("feature", pa.int32()),
        ("split", pa.float64()),
        ("left", pa.int32()),
        ("right", pa.int32()),
        ("size", pa.int32()),
        ("path_length", pa.float64()),
    ]
)
# Candidates per wanted row of a tree; drawn anew with more if a tree ends up short.
TREE_MARGIN = 2.0
# Candidates expected in a chunk of the slots of equal rows, and far more than a chunk ever has.
CHUNK_CANDIDATES, MOST_CANDIDATES = 64, 1024
# Up to so many drawn digests are sent to all tasks.
BROADCAST_ROWS = 1_000_000
# Trees of a broadcast part (about 20 MB at 256 samples); path lengths are added part by part.
TREES_PER_PART = 1000
EULER_GAMMA = 0.5772156649


def average_path(n: int) -> float:
    """Mean path length of an unsuccessful search in a binary search tree of ``n`` keys."""
    if n <= 1:
        return 0.0
    if n == 2:
        return 1.0
    return 2.0 * (math.log(n - 1.0) + EULER_GAMMA) - 2.0 * (n - 1.0) / n


@dataclass(frozen=True)
class ForestModel:
    """A fitted forest: the node rows and everything needed to score a table."""

    features: list[str]
    means: dict[str, float | None]
    psi: int
    offset: float
    n_estimators: int
    max_samples: int
    contamination: float
    random_state: int
    nodes: pa.Table = field(repr=False)

    def score(self, df: DataFrame) -> Column:
        """Anomaly score in [-1, 0), lower is more anomalous; missing inputs are filled with the training means."""
        absent = [c for c in self.features if c not in df.columns]
        if absent:
            raise ValueError(f"columns missing for scoring: {absent}")
        inputs = [F.coalesce(finite_value(df, c), F.lit(self.means.get(c) or 0.0)) for c in self.features]
        total = None
        for part in _node_parts(self.nodes):
            paths = _path_udf(df.sparkSession, part, len(inputs))(F.array(*inputs))
            total = paths if total is None else total + paths
        mean_path = total / F.lit(float(self.n_estimators))
        scale = average_path(self.psi)
        return -F.pow(F.lit(2.0), -mean_path / F.lit(scale)) if scale else F.lit(-0.5)

    def score_samples(self, df: DataFrame, output: str = "anomaly_score") -> DataFrame:
        return df.withColumn(output, self.score(df))

    def predict(self, df: DataFrame) -> DataFrame:
        """Append ``prediction``: -1 for rows below the contamination offset, 1 otherwise."""
        scored = self.score_samples(df, "__score")
        return scored.withColumn("prediction", self._label(F.col("__score"))).drop("__score")

    def get_anomalies(self, df: DataFrame, threshold: float | None = None) -> DataFrame:
        """Append prediction, anomaly_score and is_anomaly from one scoring pass."""
        return self.flag(self.score_samples(df), threshold)

    def flag(self, scored: DataFrame, threshold: float | None = None) -> DataFrame:
        """Flags for a table that already has ``anomaly_score``; ``threshold`` changes is_anomaly only."""
        score = F.col("anomaly_score")
        label = self._label(score)
        flag = label == -1 if threshold is None else score < F.lit(float(threshold))
        names = [c for c in scored.columns if c not in ("anomaly_score", "prediction", "is_anomaly")]
        return scored.select(*names, label.alias("prediction"), score, flag.alias("is_anomaly"))

    def _label(self, score: Column) -> Column:
        return F.when(score < F.lit(self.offset), -1).otherwise(1)

    def node_table(self, spark: SparkSession) -> DataFrame:
        return spark.createDataFrame(self.nodes)

    def save(self, spark: SparkSession, path: str) -> None:
        """Two Parquet tables below ``path``: nodes and one row of metadata."""
        base = path.rstrip("/")
        self.node_table(spark).coalesce(1).write.mode("overwrite").parquet(f"{base}/nodes")
        meta = (
            self.features,
            {k: v for k, v in self.means.items() if v is not None},
            self.psi,
            self.offset,
            self.n_estimators,
            self.max_samples,
            self.contamination,
            self.random_state,
        )
        spark.createDataFrame([meta], _META_SCHEMA).coalesce(1).write.mode("overwrite").parquet(f"{base}/metadata")

    @staticmethod
    def load(spark: SparkSession, path: str) -> ForestModel:
        """Read a saved model; a missing path raises."""
        base = path.rstrip("/")
        meta = spark.read.parquet(f"{base}/metadata").first().asDict()
        means = meta["means"] or {}
        nodes = _in_order(spark.read.schema(NODE_SCHEMA).parquet(f"{base}/nodes"))
        return ForestModel(**{**meta, "means": {c: means.get(c) for c in meta["features"]}}, nodes=nodes)


_META_SCHEMA = (
    "features array<string>, means map<string,double>, psi int, offset double, n_estimators int, max_samples int,"
    " contamination double, random_state int"
)


@dataclass(frozen=True)
class IsolationForest:
    """Training parameters."""

    n_estimators: int = 100
    max_samples: int = 256
    contamination: float = 0.05
    random_state: int = 42

    def fit(self, df: DataFrame, features: Sequence[str], key: Sequence[str]) -> ForestModel:
        """Train on the complete rows of ``df``. ``key`` identifies a row and decides which rows the trees see."""
        features = list(features)
        model = self._grow(df, features, list(key))
        training = df.where(all_finite(df, features))
        # The quantile search reads the scores several times; scoring happens once.
        return self._with_offset(model, stage(training.select(model.score(training).alias("anomaly_score")), "scores"))

    def fit_score(self, df: DataFrame, features: Sequence[str], key: Sequence[str]) -> tuple[ForestModel, DataFrame]:
        """``fit`` plus the whole table with its ``anomaly_score``, staged so that every row is scored once."""
        features = list(features)
        model = self._grow(df, features, list(key))
        scored = stage(model.score_samples(df).withColumn("__complete", all_finite(df, features)), "scores")
        model = self._with_offset(model, scored.where("__complete").select("anomaly_score"))
        return model, scored.drop("__complete")

    def _with_offset(self, model: ForestModel, scores: DataFrame) -> ForestModel:
        offset = exact_quantiles(scores, ["anomaly_score"], [self.contamination])["anomaly_score"][0]
        return replace(model, offset=offset)

    def _grow(self, df: DataFrame, features: list[str], key: list[str]) -> ForestModel:
        names = [f"__f{i}" for i in range(len(features))]
        complete = all_finite(df, features)
        facts = df.agg(
            *[F.avg(finite_value(df, c)).alias(n) for n, c in zip(names, features)],
            F.count_if(complete).alias("rows"),
        ).first()
        if not facts["rows"]:
            raise ValueError("no complete rows to train on")
        psi = min(self.max_samples, facts["rows"])
        doubles = [F.col(f"`{c}`").cast("double").alias(n) for n, c in zip(names, features)]
        training = df.where(complete).select(*key, *doubles)
        nodes = self._node_rows(self._draw(training, facts["rows"]), names, psi)
        return ForestModel(
            features=features,
            means={c: facts[n] for c, n in zip(features, names)},
            psi=psi,
            offset=float("-inf"),
            n_estimators=self.n_estimators,
            max_samples=self.max_samples,
            contamination=self.contamination,
            random_state=self.random_state,
            nodes=nodes,
        )

    def _node_rows(self, drawn: DataFrame, names: list[str], psi: int) -> pa.Table:
        seed, limit = self.random_state, math.ceil(math.log2(max(psi, 2)))

        def grow(pdf: pd.DataFrame) -> pd.DataFrame:
            sample = pdf[names].to_numpy(dtype=float)
            return pd.DataFrame(_grow_tree(int(pdf["tree"].iloc[0]), sample, limit, seed), columns=_NODE_TYPES.names)

        return _in_order(drawn.groupBy("tree").applyInPandas(grow, NODE_SCHEMA))

    def draw_samples(self, rows: DataFrame) -> DataFrame:
        """``min(max_samples, rows)`` rows per tree without replacement, with columns ``tree`` and ``draw`` added. All columns
        tell rows apart; of equal rows each copy may be drawn."""
        return self._draw(rows, rows.count())

    def _draw(self, rows: DataFrame, total: int) -> DataFrame:
        """Each tree takes the ``psi`` slots of smallest draw among its candidates; a slot is a candidate with the
        probability ``margin * psi / total``, so about ``margin * psi`` are ranked for each tree at any size."""
        if not total:
            return rows.withColumns({"tree": F.lit(0), "draw": F.lit(0.0)}).limit(0)
        psi, margin = min(self.max_samples, total), TREE_MARGIN
        digests = rows.select(_row_digest(rows).alias("__row"))
        # Copies combine before the shuffle, which carries 16 bytes and a count for each different row.
        counted = digests.groupBy("__row").agg(F.count("*").alias("__count"))
        while True:
            slots = _candidates(counted, min(1.0, margin * psi / total), self.n_estimators, self.random_state)
            order = Window.partitionBy("tree").orderBy("draw", "__row", "__copy")
            ranked = slots.withColumn("__n", F.row_number().over(order)).where(F.col("__n") <= psi).drop("__n")
            chosen = stage(ranked, "forest-draw")
            full = chosen.groupBy("tree").count().where(F.col("count") == psi).count()
            if full == self.n_estimators:
                break
            margin *= 2
        wanted = chosen.select("__row").distinct()
        if self.n_estimators * psi <= BROADCAST_ROWS:
            wanted = F.broadcast(wanted)
        named = rows.withColumn("__row", _row_digest(rows)).join(wanted, "__row", "left_semi")
        # Equal rows are the same in all columns.
        once = named.groupBy("__row").agg(*[F.first(f"`{c}`").alias(c) for c in rows.columns])
        return once.join(chosen, "__row").select(*[f"`{c}`" for c in rows.columns], "tree", "draw")


def _row_digest(rows: DataFrame) -> Column:
    """MD5 of all columns as text."""

    def text(name: str) -> Column:
        said = F.col(f"`{name}`").cast("string")
        # A bar in a text must not look like the next column.
        escaped = F.replace(said, F.lit("|"), F.lit("||")) if rows.schema[name].dataType.typeName() == "string" else said
        return F.coalesce(escaped, F.lit("~"))

    return F.unhex(F.md5(F.concat_ws("|", *[text(c) for c in rows.columns])))


def _candidates(counted: DataFrame, share: float, trees: int, seed: int) -> DataFrame:
    """(__row, __copy, tree, draw): the slots (copy, tree) of each digest that are candidates, each with probability
    ``share``.

    The gaps between candidates are geometric, so a digest needs a hash for each of them and one more; a digest that skips
    all its slots with the first gap, as most do in a large table, is dropped by one condition. The slots of very many
    copies are cut into chunks that spread over many tasks.
    """
    name = F.lower(F.hex("__row"))
    size = max(trees, math.ceil(CHUNK_CANDIDATES / share))
    slots = F.col("__count") * trees
    chunks = counted.withColumn("__chunk", F.explode(F.sequence(F.lit(0).cast("bigint"), F.expr(f"(__count * {trees} - 1) div {size}"))))
    length = F.least(F.lit(size), slots - F.col("__chunk") * size)

    def gap(number: Column) -> Column:
        if share >= 1:
            return F.lit(0).cast("bigint")
        u = _fraction(F.lit(seed), F.lit("gap"), name, F.col("__chunk"), number)
        return F.floor(F.log(1 - u) / F.lit(math.log(1 - share)))

    def step(state: Column, number: Column) -> Column:
        at = state["next"] + gap(number)
        more = F.struct((at + 1).alias("next"), F.concat(state["found"], F.array(at)).alias("found"))
        done = F.struct(length.cast("bigint").alias("next"), state["found"].alias("found"))
        return F.when(state["next"] >= length, state).when(at < length, more).otherwise(done)

    if share >= 1:
        found = F.sequence(F.lit(0).cast("bigint"), (length - 1).cast("bigint"))
    else:
        start = F.struct(F.lit(0).cast("bigint").alias("next"), F.array().cast("array<bigint>").alias("found"))
        numbers = F.sequence(F.lit(0), F.lit(min(MOST_CANDIDATES, size)))
        found = F.aggregate(numbers, start, step, lambda state: state["found"])
    slot = F.col("__chunk") * size + F.col("__slot")
    picked = (
        chunks.where(gap(F.lit(0)) < length)
        .withColumn("__slot", F.explode(found))
        .select("__row", F.expr(f"(__chunk * {size} + __slot) div {trees}").alias("__copy"), (slot % trees).cast("int").alias("tree"))
    )
    return picked.withColumn("draw", _fraction(F.lit(seed), F.lit("tree"), F.col("tree"), name, F.col("__copy")))


def _fraction(*parts: Column) -> Column:
    """A number in [0, 1) from the first 52 bits of the MD5 of the parts, joined by bars."""
    bits = F.conv(F.substring(F.md5(F.concat_ws("|", *[p.cast("string") for p in parts])), 1, 13), 16, 10)
    return bits.cast("bigint") / F.lit(float(1 << 52))


def node_rows(rows: list[tuple]) -> pa.Table:
    """Nodes given by hand as (tree, node, depth, feature, split, left, right, size, path_length), in order."""
    return pa.Table.from_pylist([dict(zip(_NODE_TYPES.names, r)) for r in rows], schema=_NODE_TYPES)


def _in_order(nodes: DataFrame) -> pa.Table:
    """The node table on the driver: at most n_estimators * (2 * psi - 1) rows."""
    table = nodes.select(*_NODE_TYPES.names).toArrow().cast(_NODE_TYPES)
    return table.sort_by([("tree", "ascending"), ("node", "ascending")]).combine_chunks()


def _chance(*parts: object) -> float:
    """The same number as ``_fraction`` gives."""
    return int(hashlib.md5("|".join(map(str, parts)).encode()).hexdigest()[:13], 16) / (1 << 52)


def _grow_tree(tree: int, rows: np.ndarray, limit: int, seed: int) -> list[tuple]:
    """Random axis-parallel splits until a node is pure, single or ``limit`` deep. The children of a node have twice its
    number plus one and plus two."""
    nodes: list[tuple] = []
    waiting = [(0, 0, rows)]
    for node, depth, part in waiting:
        size = len(part)
        low, high = part.min(axis=0), part.max(axis=0)
        varied = np.flatnonzero(high > low)
        if depth >= limit or size <= 1 or not len(varied):
            nodes.append((tree, node, depth, -1, None, -1, -1, size, depth + average_path(size)))
            continue
        feature = int(varied[int(_chance(seed, tree, node, "feature") * len(varied))])
        split = float(low[feature] + (high[feature] - low[feature]) * _chance(seed, tree, node, "split"))
        if not low[feature] < split <= high[feature]:
            split = float(high[feature])
        left = part[:, feature] < split
        below = 2 * node + 1
        nodes.append((tree, node, depth, feature, split, below, below + 1, size, None))
        waiting.append((below, depth + 1, part[left]))
        waiting.append((below + 1, depth + 1, part[~left]))
    return nodes


def _node_parts(nodes: pa.Table) -> Iterator[pa.Table]:
    """Whole trees in parts of a fixed number of them."""
    roots = np.flatnonzero(nodes["node"].to_numpy() == 0)
    starts = [*roots[::TREES_PER_PART].tolist(), len(nodes)]
    for begin, end in zip(starts, starts[1:]):
        yield nodes.slice(begin, end - begin)


def _path_udf(spark: SparkSession, nodes: pa.Table, width: int):
    """Sum over the given trees of the path length of each row."""
    column = {n: nodes[n].to_numpy() for n in ("node", "depth", "feature", "left", "right", "split", "path_length")}
    here, inner = np.arange(len(nodes)), column["feature"] >= 0
    roots = np.flatnonzero(column["node"] == 0)
    tree_of = np.repeat(np.arange(len(roots)), np.diff(np.append(roots, len(nodes))))
    # Nodes come by tree and number, so their places are found by search.
    number = lambda node: tree_of * (1 << 31) + node
    places = number(column["node"].astype(np.int64))
    child = lambda side: np.searchsorted(places, number(column[side].astype(np.int64)))
    # A leaf points at itself and nothing passes an infinite split, so all rows can take the same steps.
    packed = {
        "roots": roots,
        "depth": int(column["depth"].max()),
        "feature": np.where(inner, column["feature"], 0),
        "split": np.where(inner, column["split"], np.inf),
        "left": np.where(inner, child("left"), here),
        "right": np.where(inner, child("right"), here),
        "path": np.where(inner, 0.0, column["path_length"]),
    }
    shared = spark.sparkContext.broadcast(packed)

    def paths(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        forest = shared.value
        for batch in batches:
            rows = batch.flatten().to_numpy(zero_copy_only=False).reshape(len(batch), width)
            yield pa.array(_descend(rows, forest), pa.float64())

    return F.arrow_udf(paths, "double")


def _descend(rows: np.ndarray, forest: dict) -> np.ndarray:
    count, width = rows.shape
    flat, start = rows.ravel(), np.arange(count) * width
    total = np.zeros(count)
    for root in forest["roots"]:
        at = np.full(count, root)
        for _ in range(forest["depth"]):
            below = flat[start + forest["feature"][at]] < forest["split"][at]
            at = np.where(below, forest["left"][at], forest["right"][at])
        total += forest["path"][at]
    return total
