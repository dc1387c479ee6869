"""Personal data: fixed patterns and a character-level bidirectional LSTM with a conditional random field on top.

The model is trained in numpy, on the driver, from labelled character windows of bounded number. It reads overlapping
windows; the scores of a character in several windows are averaged, the middle of a window counting most, and one
Viterbi pass over the whole stretch decides about it, so that window borders decide nothing.

Only stretches around digits and @ signs are read, since a value of any of the kinds holds one of them; every one of
them in the whole text is.

* NULL and empty texts have no spans. Repeated rows are read one by one; an empty table gives an empty table.
* Places count code points, the end is exclusive. Base spans of one kind never overlap, those of two kinds may; spans
  that the model adds overlap no base span.
* Without labelled windows there is no model and only base spans are returned.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

KINDS = ("email", "ip", "card", "phone")
#: Patterns of the base spans, fixed values.
DOMAIN = re.compile(r"@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
# A match begins where a run of digits does: what fails there fails at all later digits of the run too.
IP = re.compile(r"(?<![0-9])[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
#: What every value holds at least one of.
ANCHOR = re.compile(r"[0-9@]")
NOT_DIGIT = re.compile(r"[^0-9]")

WINDOW, STRIDE = 64, 32
#: Characters read to either side of an anchor.
MARGIN = 32
#: Bounds of the training set and of the training.
TRAIN_WINDOWS, TRAIN_STEPS, BATCH = 1500, 300, 32
TAGS = 1 + 2 * len(KINDS)  # outside, and begin and inside of each kind

Span = tuple[int, int, int]  # kind, start, end


def luhn(digits: str) -> bool:
    total = 0
    for k, d in enumerate(reversed(digits)):
        n = ord(d) - 48
        if k % 2:
            n = n * 2 - 9 * (n > 4)
        total += n
    return total % 10 == 0


LOCAL_CHARACTERS = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")


def emails(text: str) -> Iterator[tuple[int, int]]:
    """Leftmost non-overlapping addresses. Each starts at the beginning of the characters that may stand before its @,
    but not before the end of the last address; walking from @ to @ avoids trying all other places."""
    done, at = 0, text.find("@")
    while at >= 0:
        begin = at
        while begin > done and text[begin - 1] in LOCAL_CHARACTERS:
            begin -= 1
        found = DOMAIN.match(text, at) if begin < at else None
        if found:
            yield begin, found.end()
            done = found.end()
        at = text.find("@", found.end() if found else at + 1)


def base_spans(text: str) -> list[Span]:
    """Spans of the fixed patterns, by kind, then by start."""
    if not ANCHOR.search(text):
        return []
    spans = [(0, s, e) for s, e in emails(text)]
    for m in IP.finditer(text):
        parts = [p.lstrip("0") for p in m[0].split(".")]
        if all(len(p) <= 3 and int(p or 0) <= 255 for p in parts):
            spans.append((1, *m.span()))
    for m in CARD.finditer(text):
        digits = NOT_DIGIT.sub("", m[0])
        if 16 <= len(digits) <= 19 and luhn(digits):
            spans.append((2, *m.span()))
    if "+" in text:
        for m in PHONE.finditer(text):
            if 8 <= len(NOT_DIGIT.sub("", m[0])) <= 15:
                spans.append((3, *m.span()))
    return spans


def stretches(text: str) -> Iterator[tuple[int, int]]:
    """Parts of the text within ``MARGIN`` characters of an anchor, merged where they meet."""
    begin = end = -1
    for m in ANCHOR.finditer(text):
        at = m.start()
        if end < 0:
            begin = max(0, at - MARGIN)
        elif at - MARGIN > end:
            yield begin, end
            begin = at - MARGIN
        end = min(len(text), at + 1 + MARGIN)
    if end >= 0:
        yield begin, end


def tags(spans: Sequence[Span], begin: int, end: int) -> np.ndarray:
    """Tags of the characters from begin to end; where spans overlap the kind listed first counts."""
    out = np.zeros(end - begin, np.int8)
    for kind, s, e in sorted(spans, reverse=True):
        s_, e_ = max(s, begin) - begin, min(e, end) - begin
        if s_ < e_:
            out[s_:e_] = 2 + 2 * kind
            if s >= begin:
                out[s_] = 1 + 2 * kind
    return out


def spans_of(tagged: np.ndarray, begin: int) -> list[Span]:
    """Spans from tags: a begin or a change of kind starts one."""
    out: list[Span] = []
    open_kind, start = -1, 0
    for k, t in enumerate([*tagged.tolist(), 0]):
        kind = (t - 1) // 2 if t else -1
        if kind != open_kind or t % 2:
            if open_kind >= 0:
                out.append((open_kind, begin + start, begin + k))
            open_kind, start = kind, k
    return out


# Character classes: printable ASCII and the line feed by themselves, then other letters, other white space, the rest.
CLASSES = 99


def classes(text: str) -> np.ndarray:
    codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4")
    known = np.where((codes >= 32) & (codes < 127), codes - 31, 96)
    known[codes == 10] = 97
    known[(codes < 32) & (codes != 10)] = 98
    return known.astype(np.int16)


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * (1 + np.tanh(0.5 * x))


class Tagger:
    """The model: character vectors, an LSTM in each direction, tag scores, transitions between tags."""

    def __init__(self, hidden: int = 20, vector: int = 10, seed: int = 5):
        r = np.random.default_rng(seed)
        h, v = hidden, vector
        self.h = h
        small = lambda *shape: (r.standard_normal(shape) / np.sqrt(shape[0])).astype(np.float32)
        self.p = {
            "vectors": small(CLASSES + 1, v) * 3,
            "w0": small(v + h, 4 * h),
            "w1": small(v + h, 4 * h),
            "b0": np.zeros(4 * h, np.float32),
            "b1": np.zeros(4 * h, np.float32),
            "out": small(2 * h, TAGS),
            "bias": np.zeros(TAGS, np.float32),
            "moves": np.zeros((TAGS, TAGS), np.float32),
        }
        for b in ("b0", "b1"):
            self.p[b][h : 2 * h] = 1  # remember at first

    def _direction(self, x: np.ndarray, w: np.ndarray, b: np.ndarray, keep: list | None) -> np.ndarray:
        """Hidden states (time, batch, hidden) for vectors (time, batch, vector)."""
        h = self.h
        v = x.shape[2]
        inputs = x @ w[:v] + b
        state = cell = np.zeros((x.shape[1], h), np.float32)
        out = np.empty((x.shape[0], x.shape[1], h), np.float32)
        for t in range(x.shape[0]):
            z = inputs[t] + state @ w[v:]
            gates = _sigmoid(z[:, : 3 * h])
            new = np.tanh(z[:, 3 * h :])
            before = cell
            cell = gates[:, h : 2 * h] * before + gates[:, :h] * new
            squashed = np.tanh(cell)
            if keep is not None:
                keep.append((state, before, gates, new, squashed))
            state = gates[:, 2 * h :] * squashed
            out[t] = state
        return out

    def scores(self, x: np.ndarray) -> np.ndarray:
        """Tag scores (batch, time, tags) for classes (batch, time)."""
        vectors = self.p["vectors"][x.T]
        ahead = self._direction(vectors, self.p["w0"], self.p["b0"], None)
        back = self._direction(vectors[::-1], self.p["w1"], self.p["b1"], None)[::-1]
        return (np.concatenate([ahead, back], axis=2) @ self.p["out"] + self.p["bias"]).transpose(1, 0, 2)

    def _back(self, x, w, kept, grad):  # noqa: ANN001, ANN202
        h, v = self.h, x.shape[2]
        dw, db, dx = np.zeros_like(w), np.zeros(4 * h, np.float32), np.empty_like(x)
        dstate = dcell = np.zeros((x.shape[1], h), np.float32)
        for t in range(x.shape[0] - 1, -1, -1):
            state, before, gates, new, squashed = kept[t]
            i, f, o = gates[:, :h], gates[:, h : 2 * h], gates[:, 2 * h :]
            d = grad[t] + dstate
            dc = dcell + d * o * (1 - squashed**2)
            dz = np.concatenate(
                [dc * new * i * (1 - i), dc * before * f * (1 - f), d * squashed * o * (1 - o), dc * i * (1 - new**2)], 1
            )
            dcell = dc * f
            dw[:v] += x[t].T @ dz
            dw[v:] += state.T @ dz
            db += dz.sum(0)
            both = dz @ w.T
            dx[t], dstate = both[:, :v], both[:, v:]
        return dw, db, dx

    def _gradients(self, x: np.ndarray, y: np.ndarray) -> tuple[float, dict[str, np.ndarray]]:
        """Negative log likelihood of the tags under the random field, per character, and its gradients."""
        p, n = self.p, x.size
        vectors = p["vectors"][x.T]
        kept: tuple[list, list] = ([], [])
        ahead = self._direction(vectors, p["w0"], p["b0"], kept[0])
        back = self._direction(vectors[::-1], p["w1"], p["b1"], kept[1])
        hidden = np.concatenate([ahead, back[::-1]], axis=2)
        s = hidden @ p["out"] + p["bias"]
        time, batch, _ = s.shape
        moves = p["moves"]
        # Forward and backward sums in the log domain.
        alpha = np.empty_like(s)
        alpha[0] = s[0]
        for t in range(1, time):
            alpha[t] = s[t] + _logsum(alpha[t - 1][:, :, None] + moves, 1)
        beta = np.zeros_like(s)
        for t in range(time - 2, -1, -1):
            beta[t] = _logsum(moves + (s[t + 1] + beta[t + 1])[:, None, :], 2)
        norm = _logsum(alpha[-1], 1)
        yt = y.T.astype(np.int64)
        rows = np.arange(batch)
        gold = np.take_along_axis(s, yt[:, :, None], 2).sum() + moves[yt[:-1], yt[1:]].sum()
        ds = np.exp(alpha + beta - norm[None, :, None])
        dm = np.zeros_like(moves)
        for t in range(1, time):
            joint = alpha[t - 1][:, :, None] + moves + (s[t] + beta[t])[:, None, :] - norm[:, None, None]
            dm += np.exp(joint).sum(0)
        np.subtract.at(dm, (yt[:-1].ravel(), yt[1:].ravel()), 1)
        for t in range(time):
            ds[t, rows, yt[t]] -= 1
        ds, dm = ds / n, dm / n
        dh = ds @ p["out"].T
        g = {"out": np.einsum("tbh,tbk->hk", hidden, ds), "bias": ds.sum((0, 1)), "moves": dm}
        h = self.h
        g["w0"], g["b0"], dx0 = self._back(vectors, p["w0"], kept[0], dh[:, :, :h])
        g["w1"], g["b1"], dx1 = self._back(vectors[::-1], p["w1"], kept[1], dh[::-1, :, h:])
        g["vectors"] = np.zeros_like(p["vectors"])
        np.add.at(g["vectors"], x.T, dx0 + dx1[::-1])
        return float(norm.sum() - gold) / n, g

    def fit(self, x: np.ndarray, y: np.ndarray, steps: int = TRAIN_STEPS, batch: int = BATCH, rate: float = 0.03) -> float:
        """Adam over random batches; returns the last loss."""
        r = np.random.default_rng(7)
        mean = {k: np.zeros_like(v) for k, v in self.p.items()}
        square = {k: np.zeros_like(v) for k, v in self.p.items()}
        loss = 0.0
        for step in range(1, steps + 1):
            some = r.integers(0, len(x), batch)
            loss, g = self._gradients(x[some], y[some])
            now = rate * min(1.0, 2 * (steps - step + 1) / steps)
            for k, v in self.p.items():
                grad = np.clip(g[k], -1, 1)
                mean[k] = 0.9 * mean[k] + 0.1 * grad
                square[k] = 0.99 * square[k] + 0.01 * grad**2
                v -= now * (mean[k] / (1 - 0.9**step)) / (np.sqrt(square[k] / (1 - 0.99**step)) + 1e-8)
        return loss

    def decode(self, scores: np.ndarray) -> np.ndarray:
        """Best tags for the scores (time, tags) of one stretch."""
        moves, time = self.p["moves"], len(scores)
        came = np.empty((time, TAGS), np.int8)
        best = scores[0]
        for t in range(1, time):
            through = best[:, None] + moves
            came[t] = through.argmax(0)
            best = through.max(0) + scores[t]
        out = np.empty(time, np.int8)
        out[-1] = best.argmax()
        for t in range(time - 1, 0, -1):
            out[t - 1] = came[t, out[t]]
        return out

    def tagged(self, texts: Sequence[str]) -> list[np.ndarray]:
        """Tags of each stretch. Windows of all stretches are read together, then put together stretch by stretch."""
        places, windows = [], []
        for k, text in enumerate(texts):
            codes = classes(text)
            last = max(0, len(codes) - WINDOW)
            for at in sorted({*range(0, last, STRIDE), last}):
                part = codes[at : at + WINDOW]
                places.append((k, at, len(part)))
                windows.append(np.pad(part, (0, WINDOW - len(part)), constant_values=CLASSES))
        if not windows:
            return []
        total = [np.zeros((len(t), TAGS), np.float32) for t in texts]
        weight = [np.zeros((len(t), 1), np.float32) for t in texts]
        middle = np.minimum(np.arange(1, WINDOW + 1), np.arange(WINDOW, 0, -1)).astype(np.float32)[:, None]
        for at in range(0, len(windows), 512):
            scores = self.scores(np.stack(windows[at : at + 512]))
            for (k, begin, n), s in zip(places[at : at + 512], scores):
                total[k][begin : begin + n] += s[:n] * middle[:n]
                weight[k][begin : begin + n] += middle[:n]
        return [self.decode(s / w) for s, w in zip(total, weight)]


def _logsum(x: np.ndarray, axis: int) -> np.ndarray:
    top = x.max(axis, keepdims=True)
    return np.log(np.exp(x - top).sum(axis)) + top.squeeze(axis)


#: What a span that the model adds must look like.
PLAUSIBLE = (
    re.compile(r"[^\s@]+@[^\s@]+\.[^\s@]+"),
    re.compile(r"(?:[0-9]{1,3}\.){3}[0-9]{1,3}"),
    re.compile(r"(?:[0-9][ -]?){12,18}[0-9]"),
    re.compile(r"\+?[0-9(](?:[ ().-]?[0-9]){6,}"),
)


def added_spans(text: str, base: list[Span], model: Tagger) -> list[Span]:
    """Spans of the model that are plausible and overlap no base span."""
    parts = list(stretches(text))
    taken = bytearray(len(text))
    for _, s, e in base:
        taken[s:e] = b"\1" * (e - s)
    out = []
    for (begin, end), tagged in zip(parts, model.tagged([text[b:e] for b, e in parts])):
        for kind, s, e in spans_of(tagged, begin):
            while s < e and text[s].isspace():
                s += 1
            while s < e and text[e - 1].isspace():
                e -= 1
            if PLAUSIBLE[kind].fullmatch(text, s, e) and taken.find(1, s, e) < 0:
                out.append((kind, s, e))
    return out


def labelled_windows(docs: DataFrame, *, text: str = "text", most: int = TRAIN_WINDOWS) -> tuple[np.ndarray, np.ndarray]:
    """A training set: character windows of texts that hold an anchor, with the base spans as labels.

    The windows of all documents are made in parallel, one for each stretch, at an offset that varies. Windows of equal
    text and tags count once, however many documents hold them; the ``most`` of smallest hash come to the driver.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, labels = [], []
            for t in batch.column(0).to_pylist():
                spans = base_spans(t)
                for begin, end in stretches(t):
                    at = max(0, min(begin + (end * 7919 + len(t)) % (MARGIN + 1), len(t) - WINDOW))
                    texts.append(t[at : at + WINDOW])
                    labels.append(tags(spans, at, min(len(t), at + WINDOW)).tobytes())
            yield pa.RecordBatch.from_arrays([pa.array(texts, pa.string()), pa.array(labels, pa.binary())], names=["t", "y"])

    rows = (
        docs.select(F.col(text).alias("text"))
        .where(F.col("text").rlike("[0-9@]"))
        .mapInArrow(run, "t string, y binary")
        .distinct()
        .orderBy(F.xxhash64("t"), "t", "y")
        .limit(most)
        .collect()
    )
    x = np.full((len(rows), WINDOW), CLASSES, np.int16)
    y = np.zeros((len(rows), WINDOW), np.int8)
    for k, row in enumerate(rows):
        x[k, : len(row["t"])] = classes(row["t"])
        y[k, : len(row["t"])] = np.frombuffer(row["y"], np.int8)
    return x, y


def train(x: np.ndarray, y: np.ndarray, **how: int) -> Tagger | None:
    if not len(x):
        return None
    model = Tagger()
    model.fit(x, y, **how)
    return model


def find(docs: DataFrame, model: Tagger | None, *, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, base, spans): base spans and all spans of every row, as arrays of (kind, start, end) by kind in the order
    listed, then by start."""
    kind = "array<struct<kind:string,start:bigint,end:bigint>>"
    arrow = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))
    said = lambda spans: [{"kind": KINDS[k], "start": s, "end": e} for k, s, e in spans]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            base, every = [], []
            for t in batch.column(1).to_pylist():
                found = base_spans(t or "")
                more = added_spans(t, found, model) if model and t and ANCHOR.search(t) else []
                base.append(said(found))
                every.append(said(sorted(found + more)))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(base, arrow), pa.array(every, arrow)], names=["key", "base", "spans"]
            )

    rows = docs.select(F.col(key).alias("key"), F.col(text).alias("text"))
    key_type = rows.schema["key"].dataType.simpleString()
    return rows.mapInArrow(run, f"key {key_type}, base {kind}, spans {kind}").withColumnRenamed("key", key)
