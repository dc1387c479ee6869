"""Alignment of the tokens of two tokenizers, A (byte-level BPE) and B (pieces with byte fallback).

Both token sequences of a text spell the same bytes. Places where an A and a B token end together cut them into groups;
an A and a B token are linked where their byte ranges overlap, so the links of a text are the stretches between any two
neighbouring token ends. Most groups hold one token of each side, and then B's id follows from A's: the map from A ids to
B ids of the same bytes is made once. Such links are counted in a vector as long as A's vocabulary, one vector for each
task. Only what is left, the irregular links, is counted as pairs of ids.

One pass encodes the texts and writes what each document holds (different ids and pairs with their numbers) together
with the counts of its task. The counts of all tasks give the table of pairs. A second pass over the written table looks
counts up: of regular links in vectors of vocabulary length, of heavy pairs (those with at least one ``HEAVY``-th of all
irregular links, of which there can't be more than ``HEAVY``) in a sorted array, and the rest by a join on the pair. So no
key of the join holds more than that share of its rows, whatever the texts are.

* NULL and empty texts, and texts that a tokenizer does not spell byte for byte, have no tokens: zeros, empty digest.
* Rows are told apart by an own number: repeated rows and NULL keys each give their row. An empty table gives an empty
  table. Other columns are not read.
* Very long texts are encoded whole, in a batch of their own. Strings of special tokens are ordinary text.
"""

from __future__ import annotations

import hashlib
import os
import re
from collections.abc import Iterator
from dataclasses import dataclass
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tidewatch.llm import worker_tools
from tidewatch.llm.token_files import Memory
from tidewatch.sources.staging import stage

HEAVY = 16_384
#: Texts and bytes that are aligned at once.
BATCH_TEXTS, BATCH_BYTES = 256, 1 << 21
#: Words of a generation that a Python worker remembers.
MAX_WORDS = 250_000
#: Words of ASCII and of Latin letters with marks, and what line feeds join.
WORD = re.compile(r"[\x21-\x7E\xC0-\xD6\xD8-\xF6\xF8-\xFF]+(?:\n+[\x21-\x7E\xC0-\xD6\xD8-\xF6\xF8-\xFF]+)*").fullmatch
#: Different pairs that a task holds before it hands their counts on, and pairs in a row of counts.
HELD_PAIRS, ROW_PAIRS = 2_000_000, 65_536


def byte_alphabet() -> dict[str, int]:
    """Characters that stand for bytes in byte-level vocabularies: printable Latin-1 for itself, others from U+0100 on."""
    printable = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in set(printable)]
    return {chr(b): b for b in printable} | {chr(0x100 + k): b for k, b in enumerate(others)}


def token_bytes_a(tokenizer) -> list[bytes]:  # noqa: ANN001
    alphabet = byte_alphabet()
    return [
        bytes(alphabet[c] for c in t) if all(c in alphabet for c in t) else t.encode()
        for t in map(tokenizer.id_to_token, range(tokenizer.get_vocab_size()))
    ]


def token_bytes_b(pieces) -> list[bytes]:  # noqa: ANN001
    return [
        bytes([int(p[3:5], 16)]) if pieces.is_byte(i) else p.replace("▁", " ").encode()
        for i, p in enumerate(map(pieces.id_to_piece, range(pieces.vocab_size())))
    ]


@dataclass
class Aligned:
    """The alignment of some texts: per text numbers and digests, per link its text, its pair and whether it is regular."""

    n_a: np.ndarray
    n_b: np.ndarray
    n_groups: np.ndarray
    n_links: np.ndarray
    digests: list[str]
    text: np.ndarray
    a: np.ndarray
    b: np.ndarray
    regular: np.ndarray


class Aligner:
    """Both tokenizers of a Python worker, and the map from A ids to B ids of the same bytes."""

    def __init__(self, json_a: str, model_b: bytes, max_words: int = MAX_WORDS):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import sentencepiece
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_str(json_a)
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_proto=model_b)
        self.bytes_a, self.bytes_b = token_bytes_a(self.a), token_bytes_b(self.b)
        self.length_a = np.array([len(t) for t in self.bytes_a], np.int64)
        self.length_b = np.array([len(t) for t in self.bytes_b], np.int64)
        of_bytes: dict[bytes, int] = {}
        for i, t in enumerate(self.bytes_b):
            # Where a piece and a byte token spell the same, the tokenizer prefers the piece.
            if not self.b.is_control(i) and not self.b.is_unknown(i) and (t not in of_bytes or self.b.is_byte(of_bytes[t])):
                of_bytes[t] = i
        self.same = np.array([of_bytes.get(t, -1) for t in self.bytes_a], np.int64)
        self.spell_a, self.spell_b = self.bytes_a.__getitem__, self.bytes_b.__getitem__
        self.memory = Memory(max_words)
        # No piece goes on after the end of a word, so pieces of words don't depend on what follows.
        self.cuts = all("▁" not in self.b.id_to_piece(i).lstrip("▁") for i in range(self.width))
        ends = ((",", "|"), (",", ";"))
        self.forms = [f"{i}{e}" for n, side in zip((len(self.bytes_a), len(self.bytes_b)), ends) for i in range(n) for e in side]

    @property
    def width(self) -> int:
        """A pair as one number: A id * width + B id."""
        return len(self.bytes_b)

    def _learn(self, words: set[str]) -> None:
        """Ids of new words on both sides; many words are encoded as one text and told apart by their bytes."""
        new = self.memory.missing({w for w in words if WORD(w)})
        for at in range(0, len(new), 4096):
            some = new[at : at + 4096]
            ends = np.cumsum([1 + len(w.encode()) for w in some])
            joined = " ".join(some)
            ids_a = np.array(self.a.encode_batch_fast([" " + joined], add_special_tokens=False)[0].ids, "<u4")
            ids_b = np.array(self.b.encode(joined), "<u4")
            sides = []
            for ids, lengths in ((ids_a, self.length_a), (ids_b, self.length_b)):
                places = np.cumsum(lengths[ids])
                cuts = np.searchsorted(places, ends)
                if len(places) == 0 or places[-1] != ends[-1] or (places[cuts] != ends).any():
                    break
                raw, cuts = ids.tobytes(), [0, *(4 * (cuts + 1)).tolist()]
                sides.append([raw[x:y] for x, y in zip(cuts, cuts[1:])])
            if len(sides) == 2:
                self.memory.now.update(zip(some, zip(*sides)))

    def _ids(self, texts: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """A and B ids of each text.

        A word that follows a space starts with it on both sides, so a text may be cut before the spaces of words and its
        words remembered. What stands between known words is encoded as it is; a space that another one precedes may
        belong to it, so it stays with what is before.
        """
        cut = [t.split(" ") for t in texts]
        if self.cuts:
            self.memory.turn()
            self._learn(set().union(*cut))
        known, rest, holes, found = self.memory.now.get, [], [], []
        for number, parts in enumerate(cut):
            pairs, done = list(map(known, parts)), 0
            for k in [k for k, p in enumerate(pairs) if p is None]:
                if k < done:
                    continue
                last = k
                # B gives nothing for an empty text, so a space at the end goes with the word before it.
                k -= k > 0 and k + 1 == len(parts) and not parts[k]
                while last + 1 < len(parts) and (not parts[last] or pairs[last + 1] is None):
                    last += 1
                holes.append((number, k, last))
                rest.append(" ".join(parts[k : last + 1]))
                done = last + 1
            found.append(pairs)
        of_a = self.a.encode_batch_fast([" " + r for r in rest], add_special_tokens=False)
        for (number, first, last), ids_a, ids_b in zip(holes, of_a, self.b.encode(rest, num_threads=1)):
            ids = (np.array(ids_a.ids, "<u4").tobytes(), np.array(ids_b, "<u4").tobytes())
            found[number][first : last + 1] = [ids] + [(b"", b"")] * (last - first)
        for pairs in found:
            for_a, for_b = zip(*pairs)
            yield np.frombuffer(b"".join(for_a), "<u4"), np.frombuffer(b"".join(for_b), "<u4")

    def _encoded(self, texts: list[str]) -> Iterator[tuple[bytes, np.ndarray, np.ndarray]]:
        """Bytes, A ids and B ids of each text; all empty where a side does not spell the bytes."""
        none = (b"", np.empty(0, np.int64), np.empty(0, np.int64))
        for t, (ids_a, ids_b) in zip(texts, self._ids(texts)):
            raw = (" " + t).encode()
            spelled = (b"".join(map(known, ids.tolist())) for known, ids in ((self.spell_a, ids_a), (self.spell_b, ids_b)))
            if t and all(s == raw for s in spelled):
                yield raw, ids_a.astype(np.int64), ids_b.astype(np.int64)
            else:
                yield none

    def __call__(self, texts: list[str]) -> Aligned:
        """All texts at once: their bytes are laid out one after the other, and a text's end is an end of both sides."""
        raw, each_a, each_b = zip(*self._encoded(texts))
        n_a, n_b = (np.array([len(ids) for ids in each], np.int64) for each in (each_a, each_b))
        ids_a, ids_b = np.concatenate(each_a), np.concatenate(each_b)
        ends_a, ends_b = np.cumsum(self.length_a[ids_a]), np.cumsum(self.length_b[ids_b])
        last = np.cumsum([len(r) for r in raw])
        is_a, is_b = (np.zeros(int(last[-1]) + 1, bool) for _ in range(2))
        is_a[ends_a] = is_b[ends_b] = True
        both = is_a & is_b
        # A stretch between neighbouring ends lies in the first A token that ends at its end or later, same for B.
        ends = np.flatnonzero(is_a | is_b)
        a = ids_a[(np.cumsum(is_a) - is_a)[ends]]
        b = ids_b[(np.cumsum(is_b) - is_b)[ends]]
        text = np.searchsorted(last, ends)
        common = both[ends]
        regular = common & np.concatenate([[True], common[:-1]])[: len(common)] & (self.same[a] == b)
        count = lambda of: np.bincount(of, minlength=len(texts))
        digests = self._digests(ids_a, ids_b, ends_a, ends_b, both, n_a, n_b)
        return Aligned(n_a, n_b, count(text[common]), count(text), digests, text, a, b, regular)

    def _digests(self, ids_a, ids_b, ends_a, ends_b, both, n_a, n_b) -> list[str]:  # noqa: ANN001
        """Digests of the groups written out: A ids, a bar, B ids, semicolons between groups."""
        group = np.cumsum(both) - both
        of_a, of_b = group[ends_a], group[ends_b]
        written = np.empty(len(ids_a) + len(ids_b), np.int64)
        at_a = np.arange(len(ids_a)) + np.searchsorted(of_b, of_a)
        at_b = np.arange(len(ids_b)) + np.searchsorted(of_a, of_b, "right")
        written[at_a] = 2 * ids_a + both[ends_a]
        written[at_b] = 2 * (len(self.bytes_a) + ids_b) + both[ends_b]
        out, at, form = [], 0, self.forms.__getitem__
        for n in (n_a + n_b).tolist():
            line = "".join(map(form, written[at : at + n].tolist()))[:-1]
            out.append(hashlib.sha256(line.encode()).hexdigest() if n else "")
            at += n
        return out


def _aligner(files) -> Aligner:  # noqa: ANN001
    """The aligner of this Python worker; it outlives a task where workers are reused."""
    json_a, model_b = files
    key = ("aligner", hashlib.md5(json_a.encode() + model_b).digest())
    return worker_tools.keep(key, lambda: Aligner(json_a, model_b))


def tokenizer_files(path_a: str, path_b: str) -> tuple[str, bytes]:
    """The files as values, so that executors need not reach the paths."""
    return Path(path_a).read_text(encoding="utf-8"), Path(path_b).read_bytes()


def _slices(texts: list[str | None]) -> Iterator[tuple[int, list[str]]]:
    at, some, held = 0, [], 0
    for k, t in enumerate(texts):
        t = t or ""
        if some and (len(some) >= BATCH_TEXTS or held + len(t) > BATCH_BYTES):
            yield at, some
            at, some, held = k, [], 0
        some.append(t)
        held += len(t)
    if some:
        yield at, some


def _lists(of: np.ndarray, values: np.ndarray, n: int, kind: pa.DataType) -> pa.ListArray:
    """Lists of the values that belong to 0, 1, ..., n - 1; ``of`` ascends."""
    offsets = np.searchsorted(of, np.arange(n + 1)).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values, kind))


def merged(keys: list[np.ndarray], numbers: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Different keys in order and the sums of their numbers."""
    if not keys:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    key, n = np.concatenate(keys), np.concatenate(numbers)
    order = np.argsort(key, kind="stable")
    key, n = key[order], n[order]
    first = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]])) if len(key) else np.empty(0, np.int64)
    return key[first], np.add.reduceat(n, first) if len(first) else n


def aligned_documents(docs: DataFrame, files: tuple[str, bytes], *, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The written table of the first pass. Rows of documents: ``counted`` is NULL, (row, key, n_a, n_b, n_groups, n_links,
    groups_sha256), different A ids of regular links and irregular pairs, with numbers. Rows of counts: ``counted`` is
    "regular" or "irregular", pairs and numbers of a part of the documents."""
    shared = docs.sparkSession.sparkContext.broadcast(files)
    rows = docs.select(F.col(key).alias("key"), F.col(text).alias("text"))
    kind = rows.schema["key"].dataType.simpleString()
    schema = (
        f"key {kind}, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, groups_sha256 string,"
        " ids array<int>, ids_n array<int>, pairs array<bigint>, pairs_n array<int>,"
        " counted string, counted_pairs array<bigint>, counted_n array<bigint>"
    )
    names = [f.name for f in StructType.fromDDL(schema)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        align = _aligner(shared.value)
        size_a, width = len(align.bytes_a), align.width
        vector = np.zeros(size_a, np.int64)
        keys: list[np.ndarray] = []
        numbers: list[np.ndarray] = []
        key_type = None

        def counts(label: str, pairs: np.ndarray, n: np.ndarray) -> Iterator[pa.RecordBatch]:
            for at in range(0, len(pairs), ROW_PAIRS):
                row = {
                    "counted": pa.array([label]),
                    "counted_pairs": pa.array([pairs[at : at + ROW_PAIRS]], pa.list_(pa.int64())),
                    "counted_n": pa.array([n[at : at + ROW_PAIRS]], pa.list_(pa.int64())),
                }
                yield filled(row, 1)

        def filled(columns: dict[str, pa.Array], n: int) -> pa.RecordBatch:
            types = {"key": key_type, "groups_sha256": pa.string(), "counted": pa.string()}
            types |= {c: pa.list_(pa.int32()) for c in ("ids", "ids_n", "pairs_n")}
            types |= {c: pa.list_(pa.int64()) for c in ("pairs", "counted_pairs", "counted_n")}
            arrays = [columns[c] if c in columns else pa.nulls(n, types.get(c, pa.int64())) for c in names]
            return pa.RecordBatch.from_arrays(arrays, names=names)

        for batch in batches:
            key_type = batch.column(0).type
            for at, texts in _slices(batch.column(1).to_pylist()):
                n, found = len(texts), align(texts)
                regular, rest = found.regular, ~found.regular
                ids, ids_n = np.unique(found.text[regular] * size_a + found.a[regular], return_counts=True)
                pair = found.a[rest] * width + found.b[rest]
                places, pairs_n = np.unique(found.text[rest] * (size_a * width) + pair, return_counts=True)
                of_ids, ids = np.divmod(ids, size_a)
                of_pairs, pairs = np.divmod(places, size_a * width)
                vector += np.bincount(ids, ids_n, size_a).astype(np.int64)
                keys.append(pairs)
                numbers.append(pairs_n)
                yield filled(
                    {
                        "key": batch.column(0).slice(at, n),
                        "n_a": pa.array(found.n_a),
                        "n_b": pa.array(found.n_b),
                        "n_groups": pa.array(found.n_groups, pa.int64()),
                        "n_links": pa.array(found.n_links, pa.int64()),
                        "groups_sha256": pa.array(found.digests, pa.string()),
                        "ids": _lists(of_ids, ids, n, pa.int32()),
                        "ids_n": _lists(of_ids, ids_n, n, pa.int32()),
                        "pairs": _lists(of_pairs, pairs, n, pa.int64()),
                        "pairs_n": _lists(of_pairs, pairs_n, n, pa.int32()),
                    },
                    n,
                )
                if sum(map(len, keys)) >= HELD_PAIRS:
                    every, n_every = merged(keys, numbers)
                    keys, numbers = [every], [n_every]
                    if len(every) >= HELD_PAIRS // 2:
                        yield from counts("irregular", every, n_every)
                        keys, numbers = [], []
        if key_type is not None:
            seen = np.flatnonzero(vector)
            yield from counts("regular", seen * width + align.same[seen], vector[seen])
            yield from counts("irregular", *merged(keys, numbers))

    return stage(rows.mapInArrow(run, schema).withColumn("row", F.monotonically_increasing_id()), "aligned")


def pair_counts(aligned: DataFrame, width: int) -> DataFrame:
    """(pair, a, b, links, regular, best): links of all documents that hold the pair, how many of them were regular, and
    whether no other pair of the B id has more."""
    each = aligned.where("counted IS NOT NULL").select(
        "counted", F.explode(F.arrays_zip(F.col("counted_pairs").alias("pair"), F.col("counted_n").alias("n"))).alias("c")
    )
    summed = each.groupBy(F.col("c.pair").alias("pair")).agg(
        F.sum("c.n").alias("links"), F.sum(F.when(F.col("counted") == "regular", F.col("c.n")).otherwise(0)).alias("regular")
    )
    # At most as many pairs as A has ids share a B id.
    return (
        summed.withColumn("a", F.floor(F.col("pair") / width))
        .withColumn("b", F.col("pair") % width)
        .withColumn("best", F.col("links") == F.max("links").over(Window.partitionBy("b")))
    )


def align_documents(
    docs: DataFrame, path_a: str, path_b: str, *, key: str = "doc_id", text: str = "text"
) -> tuple[DataFrame, DataFrame]:
    """The alignment of every row, (key, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256), and the table of
    pairs (see ``pair_counts``)."""
    files = tokenizer_files(path_a, path_b)
    align = Aligner(*files)
    size_a, width = len(align.bytes_a), align.width
    aligned = aligned_documents(docs, files, key=key, text=text)
    pairs = stage(pair_counts(aligned, width), "aligned-pairs")
    return _scored(aligned, pairs, size_a).withColumnRenamed("key", key), pairs


def _scored(aligned: DataFrame, pairs: DataFrame, size_a: int) -> DataFrame:
    total = pairs.agg(F.coalesce(F.sum(F.col("links") - F.col("regular")), F.lit(0))).first()[0]
    # At most one pair for each A id, and at most HEAVY pairs.
    links, best = np.zeros(size_a, np.int64), np.zeros(size_a, bool)
    for r in pairs.where("regular > 0").select("a", "links", "best").collect():
        links[r["a"]], best[r["a"]] = r["links"], r["best"]
    is_heavy = (F.col("links") - F.col("regular") > 0) & ((F.col("links") - F.col("regular")) * HEAVY >= total)
    heavy = pairs.where(is_heavy)
    held = sorted(tuple(r) for r in heavy.select("pair", "links", "best").collect())
    table = np.array(held, np.int64).reshape(-1, 3).T
    shared = aligned.sparkSession.sparkContext.broadcast((links, best, table))

    kept = ["row", "key", "n_a", "n_b", "n_groups", "n_links", "groups_sha256"]
    documents = aligned.where("counted IS NULL").select(*kept, "ids", "ids_n", "pairs", "pairs_n")
    types = {f.name: f.dataType.simpleString() for f in documents.schema}
    schema = ", ".join(f"{c} {types[c]}" for c in kept) + ", n_best bigint, count_sum bigint"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        links, best, (heavy_pairs, heavy_links, heavy_best) = shared.value
        for batch in batches:
            ids, ids_n, pairs_, pairs_n = (batch.column(len(kept) + k) for k in range(4))
            at = _ends(ids)
            id_, n = _values(ids), _values(ids_n)
            of_best = _sums(n * best[id_], at)
            of_links = _sums(n * links[id_], at)
            if len(heavy_pairs):
                at = _ends(pairs_)
                pair, n = _values(pairs_), _values(pairs_n)
                place = np.minimum(np.searchsorted(heavy_pairs, pair), len(heavy_pairs) - 1)
                n = n * (heavy_pairs[place] == pair)
                of_best += _sums(n * heavy_best[place], at)
                of_links += _sums(n * heavy_links[place], at)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[: len(kept)], pa.array(of_best), pa.array(of_links)], names=[*kept, "n_best", "count_sum"]
            )

    in_memory = documents.mapInArrow(run, schema)
    irregular = documents.select(
        "row", F.explode(F.arrays_zip(F.col("pairs").alias("pair"), F.col("pairs_n").alias("n"))).alias("c")
    ).select("row", "c.pair", "c.n")
    light = irregular.join(F.broadcast(heavy.select("pair")), "pair", "left_anti")
    joined = (
        light.join(pairs.where(~is_heavy).select("pair", "links", "best"), "pair")
        .groupBy("row")
        .agg(
            F.sum(F.col("n") * F.col("links")).alias("more_links"),
            F.sum(F.when(F.col("best"), F.col("n")).otherwise(0)).alias("more_best"),
        )
    )
    return in_memory.join(joined, "row", "left").select(
        "key",
        "n_a",
        "n_b",
        "n_groups",
        "n_links",
        (F.col("n_best") + F.coalesce("more_best", F.lit(0))).alias("n_best"),
        (F.col("count_sum") + F.coalesce("more_links", F.lit(0))).alias("count_sum"),
        "groups_sha256",
    )


def _ends(lists: pa.ListArray) -> np.ndarray:
    offsets = lists.offsets.to_numpy()
    return (offsets - offsets[0]).astype(np.int64)


def _values(lists: pa.ListArray) -> np.ndarray:
    return lists.flatten().to_numpy(zero_copy_only=False).astype(np.int64)


def _sums(values: np.ndarray, at: np.ndarray) -> np.ndarray:
    running = np.concatenate([[0], np.cumsum(values)])
    return running[at[1:]] - running[at[:-1]]
