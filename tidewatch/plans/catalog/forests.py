"""Trained forests, and SQL that draws the same samples, grows the same trees and scores by them."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidewatch.operators.forest import EULER_GAMMA, ForestModel, IsolationForest
from tidewatch.plans.catalog.models import event_features
from tidewatch.plans.catalog.shared import rounded
from tidewatch.sources.staging import staging_path

_FEATURES = ["value", "hour", "user"]
_SEED, _TREES, _SAMPLES = 42, 100, 256


def _training_rows(spark, folder):
    """What the trees see of an event: its key and its features as doubles."""
    doubles = [F.col(c).cast("double").alias(c) for c in _FEATURES]
    return event_features(spark, folder).select("event_id", *doubles).dropna()


def _samples(spark, folder):
    return IsolationForest().draw_samples(_training_rows(spark, folder)).select("tree", "event_id", "draw")


def _nodes(spark, folder):
    model = IsolationForest().fit(event_features(spark, folder), _FEATURES, ["event_id"])
    return rounded(model.node_table(spark)).drop("left", "right")


def _scores(spark, folder):
    model, scored = IsolationForest().fit_score(event_features(spark, folder), _FEATURES, ["event_id"])
    return rounded(model.flag(scored))


def _reloaded_scores(spark, folder):
    events = event_features(spark, folder)
    path = staging_path(spark, "model")
    IsolationForest(contamination=0.1).fit(events, _FEATURES, ["event_id"]).save(spark, path)
    return rounded(ForestModel.load(spark, path).get_anomalies(events))


QUERIES = {
    "forest_samples": _samples,
    "forest_nodes": _nodes,
    "forest_scores": _scores,
    "forest_reloaded_scores": _reloaded_scores,
}


def _fraction(*parts: str) -> str:
    """A number in [0, 1) from the first 52 bits of the MD5 of the parts, joined by bars."""
    return f"CAST('0x' || substr(md5(concat_ws('|', {', '.join(parts)})), 1, 13) AS BIGINT) / 4503599627370496.0"


def _average_path(n: str) -> str:
    return f"""CASE WHEN {n} <= 1 THEN 0.0 WHEN {n} = 2 THEN 1.0
               ELSE 2 * (ln({n} - 1.0) + {EULER_GAMMA}) - 2 * ({n} - 1.0) / {n} END"""


def _gap(number: str) -> str:
    return f"""CASE WHEN share >= 1 THEN 0 ELSE
               CAST(floor(ln(1 - {_fraction(str(_SEED), "'gap'", "h", "0", number)}) / ln(1 - share)) AS BIGINT) END"""


_SAMPLED = f"""
        e AS (SELECT event_id, ts, value, CAST(hour(ts) AS INTEGER) AS hour, user_id AS "user" FROM events),
        r AS (SELECT event_id, CAST(value AS DOUBLE) AS a, CAST(hour AS DOUBLE) AS b, CAST("user" AS DOUBLE) AS c FROM e
              WHERE value IS NOT NULL AND hour IS NOT NULL AND "user" IS NOT NULL),
        d AS (SELECT *, md5(concat_ws('|', event_id, a, b, c)) AS h FROM r),
        facts AS (SELECT count(*) AS n, least({_SAMPLES}, count(*)) AS psi,
                         CASE WHEN count(*) <= 2 * {_SAMPLES} THEN 1.0 ELSE 2.0 * {_SAMPLES} / count(*) END AS share FROM r),
        -- each row has one slot for each tree; the gaps between the slots that are candidates are geometric
        slots AS (
          SELECT h, 0 AS k, slot FROM (SELECT h, {_gap("0")} AS slot FROM d, facts) WHERE slot < {_TREES}
          UNION ALL
          SELECT h, k, slot FROM (SELECT h, k + 1 AS k, slot + 1 + {_gap("k + 1")} AS slot FROM slots, facts)
          WHERE slot < {_TREES}),
        drawn AS (SELECT h, CAST(slot AS INTEGER) AS tree, {_fraction(str(_SEED), "'tree'", "slot", "h", "0")} AS draw FROM slots),
        samples AS (
          SELECT tree, event_id, draw, a, b, c
          FROM (SELECT *, row_number() OVER (PARTITION BY tree ORDER BY draw, h) AS place FROM drawn) JOIN d USING (h), facts
          WHERE place <= psi)"""

#: Feature and split of nodes with ranges a0..a1, b0..b1, c0..c1 and a size.
_CHOSEN = f"""SELECT *, CASE WHEN f >= 0 THEN CASE WHEN lo < lo + (hi - lo) * u AND lo + (hi - lo) * u <= hi
                        THEN lo + (hi - lo) * u ELSE hi END END AS split
              FROM (SELECT *, [a0, b0, c0][f + 1] AS lo, [a1, b1, c1][f + 1] AS hi,
                           {_fraction(str(_SEED), "tree", "node", "'split'")} AS u
                    FROM (SELECT *, CASE WHEN depth >= ceil(log2(greatest(psi, 2))) OR size <= 1 OR len(varied) = 0 THEN -1
                                         ELSE varied[1 + CAST(floor({_fraction(str(_SEED), "tree", "node", "'feature'")}
                                                                    * len(varied)) AS INTEGER)] END AS f
                          FROM (SELECT *, list_filter([0, 1, 2], lambda i: [a1, b1, c1][i + 1] > [a0, b0, c0][i + 1]) AS varied
                                FROM ranges, facts)))"""
_RANGES = ", ".join(f"min({x}) {{over}} AS {x}0, max({x}) {{over}} AS {x}1" for x in "abc") + ", count(*) {over} AS size"

_GROWN = f"""{_SAMPLED},
        grown AS (
          SELECT tree, CAST(0 AS BIGINT) AS node, 0 AS depth, a, b, c FROM samples
          UNION ALL
          SELECT tree, 2 * node + CASE WHEN [a, b, c][f + 1] < split THEN 1 ELSE 2 END, depth + 1, a, b, c
          FROM (WITH ranges AS (SELECT *, {_RANGES.format(over="OVER (PARTITION BY tree, node)")} FROM grown) {_CHOSEN})
          WHERE f >= 0),
        nodes AS (
          WITH ranges AS (SELECT tree, node, depth, {_RANGES.format(over="")} FROM grown GROUP BY ALL)
          SELECT tree, node, depth, f, split, size, CASE WHEN f < 0 THEN depth + {_average_path("size")} END AS path
          FROM ({_CHOSEN}))"""

_FLAGGED = f"""{_GROWN},
        filled AS (SELECT event_id, coalesce(value, avg(value) OVER ()) AS a, coalesce(hour, avg(hour) OVER ()) AS b,
                          coalesce("user", avg("user") OVER ()) AS c FROM e),
        walked AS (
          SELECT event_id, tree, CAST(0 AS BIGINT) AS node, a, b, c FROM filled, (SELECT DISTINCT tree FROM nodes)
          UNION ALL
          SELECT event_id, tree, 2 * node + CASE WHEN [a, b, c][f + 1] < split THEN 1 ELSE 2 END, a, b, c
          FROM walked JOIN nodes USING (tree, node) WHERE f >= 0),
        -- exact sums, so that events with the same leaves have the same score
        scored AS (
          SELECT event_id, -pow(2, -(CAST(sum(CAST(path AS DECIMAL(20, 12))) AS DOUBLE) / {_TREES})
                                   / any_value({_average_path("psi")})) AS score
          FROM walked JOIN nodes USING (tree, node), facts WHERE f < 0 GROUP BY event_id),
        cut AS (SELECT quantile_cont(score, {{share}}) AS cut FROM scored)
        SELECT event_id, ts, round(value, 6) AS value, hour, "user",
               CAST(CASE WHEN score < cut THEN -1 ELSE 1 END AS INTEGER) AS prediction, round(score, 6) AS anomaly_score,
               score < cut AS is_anomaly
        FROM e JOIN scored USING (event_id), cut"""

SQL = {
    "forest_samples": f"WITH RECURSIVE {_SAMPLED} SELECT tree, event_id, draw FROM samples",
    "forest_nodes": f"""
        WITH RECURSIVE {_GROWN}
        SELECT tree, CAST(node AS INTEGER) AS node, depth, CAST(f AS INTEGER) AS feature, round(split, 6) AS split,
               CAST(size AS INTEGER) AS size, round(path, 6) AS path_length
        FROM nodes""",
    "forest_scores": f"WITH RECURSIVE {_FLAGGED.format(share=0.05)}",
    "forest_reloaded_scores": f"WITH RECURSIVE {_FLAGGED.format(share=0.1)}",
}
