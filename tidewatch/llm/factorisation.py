"""A quality classifier: a factorisation machine over hashed words, structure statistics and metadata.

A text becomes a sparse vector: its different words, hashed to ``BUCKETS`` places and scaled to length 1 together, one
place for the bin that each structure statistic falls in, and one for the bin of each metadata column. The model has a
weight and a vector of ``RANK`` numbers for each place; the score is a logistic function of

    bias + sum w_i x_i + sum over pairs i < j of <v_i, v_j> x_i x_j,

where the pairs are summed in linear time as half of |sum v_i x_i|^2 - sum |v_i x_i|^2. Bins are cut at quantiles of the
training rows. Places that no training row holds weigh nothing.

**Training.** At most ``TRAIN_ROWS`` labelled rows of smallest hash, whose features together are at most
``TRAIN_FEATURES``; texts that are equal count once, with the mean of their labels. Their features are made in parallel
and only these come to the driver, where numpy fits the model with adaptive gradient steps over shuffled batches. The
result depends on the rows only, not on how they are laid out. Scoring is one pass over all texts, without a shuffle.

* NULL and empty texts have no words; their structure bins give them a score. NULL metadata has a bin of its own.
* Equal rows get equal scores. An empty table gives an empty table. Without labelled rows every score is 0.5; rows of one
  label only give a model that says that label.
* Texts are read whole, whatever their length. Other columns are not read.
"""

from __future__ import annotations

import hashlib
import zlib
from collections import Counter
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from string import ascii_letters, digits

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

BUCKETS, RANK = 1 << 18, 8
TRAIN_ROWS, TRAIN_FEATURES = 8192, 4_000_000
BINS = 12
#: Length of the part of a statistic in the vector; all words together have length 1.
STATISTIC = 0.4
#: Texts that are scored at once.
BATCH = 128

WORD_BYTES = bytes(b if b > 0x7F or chr(b) in ascii_letters + digits else 0x20 for b in range(256))
#: Bytes whose share of a text is a statistic.
CLASSES = {
    "digits": b"0123456789",
    "capitals": b"ABCDEFGHIJKLMNOPQRSTUVWXYZ",
    "symbols": b"#*$%&|<>{}[]()=_~^@\\/+",
    "stops": b".,;:?",
    "exclamations": b"!",
    "blanks": b" \t\r\x0b\x0c",
    "other": bytes(range(0x80, 0x100)),
}
STATISTICS = (
    "words", "word_length", "longest", "variety", "commonest", "repeated_pairs", "line_words", "lines", "repeated_lines",
    "empty_lines", *CLASSES,
)


def words_and_statistics(text: str | None) -> tuple[dict[bytes, int], list[float]]:
    """Lower-cased words with their numbers, and the structure statistics in order."""
    text = text or ""
    raw = text.encode()
    words = text.lower().encode().translate(WORD_BYTES).split()
    counts = Counter(words)
    n, size = len(words), max(len(raw), 1)
    lines = raw.split(b"\n")
    filled = [line for line in lines if line.strip()]
    pairs = n - 1 - len(set(zip(words, words[1:]))) if n > 1 else 0
    return counts, [
        np.log2(1 + n),
        sum(map(len, words)) / max(n, 1),
        np.log2(1 + max(map(len, raw.split()), default=0)),
        np.log2(1 + len(counts)) / np.log2(2 + n),
        max(counts.values(), default=0) / max(n, 1),
        pairs / max(n, 1),
        np.log2(1 + n / max(len(filled), 1)),
        np.log2(1 + len(filled)),
        1 - len(set(filled)) / max(len(filled), 1),
        1 - len(filled) / len(lines),
        *((len(raw) - len(raw.translate(None, some))) / size for some in CLASSES.values()),
    ]


def word_part(counts: dict[bytes, int]) -> tuple[np.ndarray, np.ndarray]:
    """Places of the words in order, and their values, of length 1 together."""
    if not counts:
        return np.empty(0, np.int64), np.empty(0)
    places = np.fromiter(map(zlib.crc32, counts), np.int64, len(counts)) % BUCKETS
    values = 1 + np.log(np.fromiter(counts.values(), np.float64, len(counts)))
    # Words of one place add up, in the order of their values, so that the sum does not depend on where they stand.
    order = np.lexsort((values, places))
    places, values = places[order], values[order]
    first = np.flatnonzero(np.concatenate([[True], places[1:] != places[:-1]]))
    places, values = places[first], np.add.reduceat(values, first)
    return places, values / np.sqrt(values @ values)


@dataclass
class Machine:
    """Bias, weights and vectors by place, and the cuts of the bins; a statistic's bins follow the word places."""

    bias: float
    weights: np.ndarray
    vectors: np.ndarray
    cuts: list[np.ndarray]

    def vector(self, counts: dict[bytes, int], statistics: Sequence[float]) -> tuple[np.ndarray, np.ndarray]:
        return _vector(*word_part(counts), np.asarray(statistics), self.cuts)

    def margins(self, places: list[np.ndarray], values: list[np.ndarray]) -> np.ndarray:
        """What the logistic function is taken of, for some vectors; none of them is empty."""
        i, x = np.concatenate(places), np.concatenate(values)
        starts = np.cumsum([0, *map(len, places[:-1])])
        scaled = self.vectors[i] * x[:, None]
        sums = np.add.reduceat(scaled, starts)
        squares = np.add.reduceat(scaled * scaled, starts)
        linear = np.add.reduceat(self.weights[i] * x, starts)
        return self.bias + linear + 0.5 * (sums * sums - squares).sum(1)

    def scores(self, texts: list[str | None], metadata: np.ndarray) -> np.ndarray:
        """Scores of texts; ``metadata`` has a row for each."""
        if not texts:
            return np.empty(0)
        made = []
        for t, more in zip(texts, metadata):
            counts, statistics = words_and_statistics(t)
            made.append(self.vector(counts, [*statistics, *more]))
        return sigmoid(self.margins(*map(list, zip(*made))))


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * (1 + np.tanh(0.5 * x))


def _vector(places, values, statistics, cuts):  # noqa: ANN001, ANN202
    bins = [BINS if np.isnan(s) else int(np.searchsorted(c, s, "right")) for s, c in zip(statistics, cuts)]
    more = BUCKETS + np.arange(len(bins)) * (BINS + 1) + np.array(bins, np.int64)
    return np.concatenate([places, more]), np.concatenate([values, np.full(len(bins), STATISTIC)])


def fit(
    words: list[tuple[np.ndarray, np.ndarray]],
    statistics: np.ndarray,
    labels: np.ndarray,
    *,
    epochs: int = 6,
    batch: int = 128,
    rate: float = 0.1,
    decay: float = 1e-4,
    seed: int = 3,
) -> Machine:
    """A machine from word parts, statistics (rows, statistics) and labels between 0 and 1."""
    inner = np.linspace(0, 1, BINS + 1)[1:-1]
    cuts = []
    for column in statistics.T:
        seen = column[~np.isnan(column)]
        cuts.append(np.unique(np.quantile(seen, inner)) if len(seen) else np.empty(0))
    size = BUCKETS + len(cuts) * (BINS + 1)
    machine = Machine(0.0, np.zeros(size), np.zeros((size, RANK)), cuts)
    if not len(labels):
        return machine
    rows = [_vector(*w, s, cuts) for w, s in zip(words, statistics)]
    touched = np.unique(np.concatenate([p for p, _ in rows]))
    rng = np.random.default_rng(seed)
    # Work on the touched places alone; column 0 is the weight, the others are the vector.
    table = np.concatenate([np.zeros((len(touched), 1)), rng.normal(0, 0.1, (len(touched), RANK))], axis=1)
    past, past_bias = np.full_like(table, 1e-4), 1e-4
    rows = [(np.searchsorted(touched, p), x) for p, x in rows]
    mean = np.clip(labels.mean(), 0.01, 0.99)
    bias = float(np.log(mean / (1 - mean)))
    for _ in range(epochs):
        order = rng.permutation(len(rows))
        for at in range(0, len(order), batch):
            some = order[at : at + batch]
            i = np.concatenate([rows[k][0] for k in some])
            x = np.concatenate([rows[k][1] for k in some])[:, None]
            sizes = np.array([len(rows[k][0]) for k in some])
            starts = np.cumsum(sizes) - sizes
            scaled = table[i] * x
            sums = np.add.reduceat(scaled, starts)
            squares = np.add.reduceat(scaled[:, 1:] ** 2, starts)
            margin = bias + sums[:, 0] + 0.5 * (sums[:, 1:] ** 2 - squares).sum(1)
            wrong = (sigmoid(margin) - labels[some]) / len(some)
            each = np.repeat(wrong, sizes)[:, None] * x
            slope = np.concatenate([each, each * (np.repeat(sums[:, 1:], sizes, axis=0) - scaled[:, 1:])], axis=1)
            # Slopes of one place add up.
            by_place = np.argsort(i, kind="stable")
            place = i[by_place]
            first = np.flatnonzero(np.concatenate([[True], place[1:] != place[:-1]]))
            place = place[first]
            slope = np.add.reduceat(slope[by_place], first) + decay * table[place]
            past[place] += slope**2
            table[place] -= rate * slope / np.sqrt(past[place])
            past_bias += wrong.sum() ** 2
            bias -= rate * wrong.sum() / np.sqrt(past_bias)
    machine.bias = float(bias)
    machine.weights[touched] = table[:, 0]
    machine.vectors[touched] = table[:, 1:]
    return machine


def metadata_columns(docs: DataFrame, metadata: Sequence[str]) -> list:
    """Numbers as logarithms with their sign, as doubles; NULL stays."""
    numbers = [F.col(c).cast("double") for c in metadata]
    return [(F.signum(c) * F.log2(1 + F.abs(c))).alias(f"m{k}") for k, c in enumerate(numbers)]


def labelled_sample(labels: DataFrame, *, key: str, label: str, most: int) -> DataFrame:
    """(key, y): keys of smallest hash, about ``most`` of them and not more, with the mean of their labels."""
    each = (
        labels.select(F.col(key).alias("key"), F.col(label).cast("double").alias("y"))
        .where("key IS NOT NULL AND y IS NOT NULL")
        .groupBy("key")
        .agg(F.avg("y").alias("y"))
        .withColumn("h", F.xxhash64(F.col("key").cast("string")))
    )
    # A bound on the hash leaves little more than wanted, so that the last cut has few rows to sort.
    n = each.count()
    share = min(1.0, 1.2 * (most + 50) / max(n, 1))
    bound = int(-(2**63) + share * (2**64 - 1))
    return each.where(F.col("h") <= min(bound, 2**63 - 1)).orderBy("h", "key").limit(most).select("key", "y")


def training_rows(
    docs: DataFrame,
    labels: DataFrame,
    *,
    key: str = "doc_id",
    text: str = "text",
    label: str = "quality",
    metadata: Sequence[str] = (),
    most_rows: int = TRAIN_ROWS,
    most_features: int = TRAIN_FEATURES,
) -> tuple[list[tuple[np.ndarray, np.ndarray]], np.ndarray, np.ndarray]:
    """Word parts, statistics and labels of the training set (see the top of the module)."""
    sample = labelled_sample(labels, key=key, label=label, most=most_rows)
    n_metadata = len(metadata)
    rows = docs.select(F.col(key).alias("key"), F.col(text).alias("text"), *metadata_columns(docs, metadata))
    # The sample has at most ``most_rows`` rows.
    labelled = rows.join(F.broadcast(sample), "key").select("text", "y", *[f"m{k}" for k in range(n_metadata)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            more = _metadata(batch, 2, n_metadata)
            for t, y, m in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), more):
                counts, statistics = words_and_statistics(t)
                places, values = word_part(counts)
                numbers = np.array([*statistics, *m], np.float64).tobytes()
                digest = hashlib.md5((t or "").encode() + b"\0" + numbers).digest()
                out.append((digest, y, len(places), places.astype(np.int32).tobytes(), values.tobytes(), numbers))
            arrays = [pa.array(c, k) for c, k in zip(zip(*out), FEATURE_TYPES)]
            yield pa.RecordBatch.from_arrays(arrays, names=FEATURES)

    each = labelled.mapInArrow(
        run, "digest binary, y double, n int, places binary, `values` binary, numbers binary"
    )
    whole = Window.orderBy("digest").rowsBetween(Window.unboundedPreceding, 0)
    first = [F.first(c).alias(c) for c in ("n", "places", "values", "numbers")]
    # Equal texts have equal features. At most ``most_rows`` keys, so one task can add up their sizes.
    once = each.groupBy("digest").agg(F.avg("y").alias("y"), *first)
    sized = once.withColumn("at", F.row_number().over(Window.orderBy("digest"))).withColumn("total", F.sum("n").over(whole))
    chosen = sized.where((F.col("at") <= most_rows) & (F.col("total") <= most_features))
    found = sorted((bytes(r["digest"]), r) for r in chosen.collect())
    words = [(np.frombuffer(r["places"], np.int32).astype(np.int64), np.frombuffer(r["values"])) for _, r in found]
    statistics = np.array([np.frombuffer(r["numbers"]) for _, r in found]).reshape(len(found), len(STATISTICS) + n_metadata)
    return words, statistics, np.array([r["y"] for _, r in found])


FEATURES = ["digest", "y", "n", "places", "values", "numbers"]
FEATURE_TYPES = [pa.binary(), pa.float64(), pa.int32(), pa.binary(), pa.binary(), pa.binary()]


def _metadata(batch: pa.RecordBatch, first: int, n: int) -> np.ndarray:
    """Metadata columns of a batch, a row for each of its rows, NaN for NULL."""
    if not n:
        return np.empty((batch.num_rows, 0))
    return np.stack([c.to_numpy(zero_copy_only=False).astype(np.float64) for c in batch.columns[first : first + n]], axis=1)


def train(docs: DataFrame, labels: DataFrame, *, key: str = "doc_id", **how: object) -> Machine:
    """The machine that the labelled rows give."""
    return fit(*training_rows(docs, labels, key=key, **how))


def score(
    docs: DataFrame, machine: Machine, *, key: str = "doc_id", text: str = "text", metadata: Sequence[str] = ()
) -> DataFrame:
    """(key, score): how likely label 1 is, for every row. ``metadata`` must be the columns of the training."""
    rows = docs.select(F.col(key).alias("key"), F.col(text).alias("text"), *metadata_columns(docs, metadata))
    kind, n_metadata = rows.schema["key"].dataType.simpleString(), len(metadata)
    shared = docs.sparkSession.sparkContext.broadcast(machine)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        machine = shared.value
        for batch in batches:
            texts, more = batch.column(1).to_pylist(), _metadata(batch, 2, n_metadata)
            parts = [machine.scores(texts[k : k + BATCH], more[k : k + BATCH]) for k in range(0, len(texts), BATCH)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(np.concatenate([np.empty(0), *parts]))], names=["key", "score"]
            )

    return rows.mapInArrow(run, f"key {kind}, score double").withColumnRenamed("key", key)
