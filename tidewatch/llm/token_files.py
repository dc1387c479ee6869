"""Token ids in binary files of patched frame-of-reference blocks.

Documents are range-partitioned by key and sorted; every task encodes its documents in that order and writes them to
shards. A shard holds the keys, the number of ids of each document and the ids, the latter two as streams of blocks: the
block's minimum is subtracted, all values are packed at the width that a percentile of them needs, and the high bits of
the others go to an exception list. An index of block starts allows to decode any range of ids alone.

Files get a name of their own for each attempt of a task. Which files count is said by a manifest that Spark commits;
so a repeated or speculative task leaves at most files that nobody reads.

* NULL and empty texts have the end id only. NULL keys come first. Rows of one key are ordered by the hash of their text,
  as they are dealt out to tasks, so that their places do not depend on the number of tasks. Keys must be integers.
* Repeated rows are all written. An empty table gives an empty manifest and an empty result.
* Texts of any length are written whole, a shard may then be larger than ``SHARD_IDS``.
"""

from __future__ import annotations

import json
import os
import re
import struct
import uuid
import zlib
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidewatch.llm import worker_tools
from tidewatch.sources.staging import stage

BLOCK = 4096
PERCENTILE = 90
SHARD_IDS = 4_000_000
#: Words of a generation that a Python worker remembers.
MAX_WORDS = 600_000
MAGIC = b"PFOR\x01\x00\x00\x00"
#: minimum, width, number of exceptions.
HEAD = "<IBxH"
HEAD_SIZE = struct.calcsize(HEAD)
#: Texts that are encoded at once, and their bytes.
TEXTS, TEXT_BYTES = 1024, 4_000_000
#: The pattern and the normaliser for which plain texts are brought to their normal form in Python.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
NORMALIZER = [
    {"type": "NFC"},
    {"type": "Replace", "pattern": {"Regex": "\\s+"}, "content": " "},
    {"type": "Lowercase"},
]
#: Texts of ASCII and of Latin letters with marks; their white space is spaces and line feeds.
PLAIN = re.compile(r"[\n\x20-\x7E\xC0-\xD6\xD8-\xF6\xF8-\xFF]*").fullmatch
#: A comma or a full stop between a letter and a blank or the end is a piece of its own.
MARK = re.compile(r"[,.](?<=[a-z\xDF-\xF6\xF8-\xFF][,.])(?![^ \n])").sub
#: Words that are one piece and have their normal form.
LETTERS = re.compile(r"[a-z\xDF-\xF6\xF8-\xFF]+").fullmatch
#: Words of ASCII and of Latin letters with marks.
LATIN = re.compile(r"[\x21-\x7E\xC0-\xD6\xD8-\xF6\xF8-\xFF]+").fullmatch


def pack(values: np.ndarray, width: int) -> bytes:
    """The low ``width`` bits of each value, highest bit first."""
    if width in (8, 16):
        return values.astype(f">u{width // 8}").tobytes()
    bits = np.unpackbits(values.astype(">u4").view(np.uint8).reshape(-1, 4), axis=1)
    return np.packbits(bits[:, 32 - width :]).tobytes()


def unpack(data: bytes, n: int, width: int) -> np.ndarray:
    if width in (8, 16):
        return np.frombuffer(data, f">u{width // 8}", n).astype(np.uint32)
    bits = np.zeros((n, 32), np.uint8)
    bits[:, 32 - width :] = np.unpackbits(np.frombuffer(data, np.uint8), count=n * width).reshape(n, width)
    return np.packbits(bits, axis=1).view(">u4").ravel().astype(np.uint32)


def encode_block(values: np.ndarray, percentile: int = PERCENTILE) -> bytes:
    low = int(values.min())
    rest = values - np.uint32(low)
    width = int(np.partition(rest, k := (len(rest) - 1) * percentile // 100)[k]).bit_length()
    high = rest >> np.uint32(width) if width < 32 else np.zeros_like(rest)
    at = np.flatnonzero(high)
    packed = pack(rest, width) if width else b""
    return struct.pack(HEAD, low, width, len(at)) + packed + at.astype("<u2").tobytes() + high[at].astype("<u4").tobytes()


def decode_block(data: bytes, n: int) -> np.ndarray:
    low, width, patches = struct.unpack_from(HEAD, data)
    size = (n * width + 7) // 8
    at = HEAD_SIZE + size
    values = unpack(data[HEAD_SIZE : at], n, width) if width else np.zeros(n, np.uint32)
    places = np.frombuffer(data, "<u2", patches, at)
    high = np.frombuffer(data, "<u4", patches, at + 2 * patches)
    values[places] |= high.astype(np.uint32) << np.uint32(width)
    return values + np.uint32(low)


def encode_stream(values: np.ndarray, percentile: int = PERCENTILE) -> bytes:
    """Number of values, number of blocks, index of block starts (one more than blocks), blocks."""
    blocks = [encode_block(values[i : i + BLOCK], percentile) for i in range(0, len(values), BLOCK)]
    starts = np.cumsum([0, *map(len, blocks)], dtype="<u8")
    return struct.pack("<QQ", len(values), len(blocks)) + starts.tobytes() + b"".join(blocks)


class Stream:
    """Reads a stream in place."""

    def __init__(self, data: memoryview, at: int = 0):
        self.n, blocks = struct.unpack_from("<QQ", data, at)
        at += 16
        self.starts = np.frombuffer(data, "<u8", blocks + 1, at)
        self.at = at + 8 * (blocks + 1)
        self.data = data
        self.end = self.at + int(self.starts[-1])

    def block(self, k: int) -> np.ndarray:
        begin, end = (self.at + int(x) for x in self.starts[k : k + 2])
        return decode_block(self.data[begin:end], min(BLOCK, self.n - k * BLOCK))

    def read(self, begin: int, end: int) -> np.ndarray:
        """The values from begin to end, from the blocks that hold them."""
        if begin >= end:
            return np.empty(0, np.uint32)
        blocks = range(begin // BLOCK, (end - 1) // BLOCK + 1)
        found = np.concatenate([self.block(k) for k in blocks])
        return found[begin - blocks[0] * BLOCK : end - blocks[0] * BLOCK]


def encode_shard(keys: list[int | None], ids: list[np.ndarray], percentile: int = PERCENTILE) -> bytes:
    valid = np.array([k is not None for k in keys], np.uint8)
    numbers = np.array([k or 0 for k in keys], "<i8")
    lengths = np.array([len(i) for i in ids], np.uint32)
    every = np.concatenate(ids) if ids else np.empty(0, np.uint32)
    return b"".join(
        [
            MAGIC,
            struct.pack("<Q", len(keys)),
            numbers.tobytes(),
            valid.tobytes(),
            encode_stream(lengths, percentile),
            encode_stream(every.astype(np.uint32), percentile),
        ]
    )


class Shard:
    """A shard's keys, lengths and ids."""

    def __init__(self, data: bytes | memoryview):
        data = memoryview(data)
        if bytes(data[:8]) != MAGIC:
            raise ValueError("not a shard of token ids")
        (n,) = struct.unpack_from("<Q", data, 8)
        numbers, valid = np.frombuffer(data, "<i8", n, 16), np.frombuffer(data, np.uint8, n, 16 + 8 * n)
        self.keys = [int(k) if v else None for k, v in zip(numbers, valid)]
        lengths = Stream(data, 16 + 9 * n)
        self.lengths = lengths.read(0, lengths.n)
        self.ids = Stream(data, lengths.end)

    def documents(self) -> Iterator[tuple[int | None, int, np.ndarray]]:
        """(key, first id's place in the shard, ids) of each document; decodes some blocks at a time."""
        ends = np.cumsum(self.lengths, dtype=np.int64)
        at = 0
        while at < len(ends):
            begin = int(ends[at] - self.lengths[at])
            last = max(int(np.searchsorted(ends, begin + 64 * BLOCK)), at + 1)
            some = self.ids.read(begin, int(ends[last - 1]))
            for k in range(at, last):
                first = int(ends[k] - self.lengths[k])
                yield self.keys[k], first, some[first - begin : int(ends[k]) - begin]
            at = last


def _store(path: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(path) if "://" in path or path.startswith("file:") else (fs.LocalFileSystem(), path)


class Encoder:
    """The tokenizer, behind a memory of words and pieces.

    Normaliser and pre-tokeniser treat what stands between spaces and line feeds by itself, so a text may be cut there,
    and each different part need be encoded only once. Other white space stays inside the parts. A part of Latin letters
    is cut further where the tokenizer's own pattern cuts it, since many parts differ in punctuation only. Texts of such
    letters get their normal form as a whole and lose the commas and full stops at their words, so most of their parts
    are pieces already.
    """

    def __init__(self, path: str, max_words: int = MAX_WORDS):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True
        self.max_words = max_words
        self.words = Memory(max_words)
        self.normalized = False
        self.find_pieces = self._pattern(path)

    def _pattern(self, path: str) -> Callable[[str], list[str]] | None:
        """What cuts a normalised word into pieces, if the file says so in one pattern and marks the last token of a
        piece; these marks tell the ids of many pieces apart that are encoded as one text."""
        from tokenizers import Tokenizer, pre_tokenizers

        spec = json.loads(self.tokenizer.to_str())
        steps = (spec["pre_tokenizer"] or {}).get("pretokenizers", [])
        suffix = spec["model"].get("end_of_word_suffix")
        if [s["type"] for s in steps] != ["Split", "ByteLevel"] or not suffix or steps[1]["use_regex"]:
            return None
        if not steps[0]["invert"] or "Regex" not in steps[0]["pattern"]:
            return None
        size = self.tokenizer.get_vocab_size()
        self.last = np.array([(self.tokenizer.id_to_token(i) or "").endswith(suffix) for i in range(size)])
        known = (spec["normalizer"] or {}).get("normalizers")
        self.normalized = steps[0]["pattern"]["Regex"] == PATTERN and known == NORMALIZER
        # For pieces that are cut and normal already.
        self.bare = Tokenizer.from_file(path)
        self.bare.encode_special_tokens = True
        self.bare.normalizer = None
        self.bare.pre_tokenizer = pre_tokenizers.Sequence(
            [
                pre_tokenizers.WhitespaceSplit(),
                pre_tokenizers.ByteLevel(add_prefix_space=steps[1]["add_prefix_space"], use_regex=False),
            ]
        )
        return regex.compile(steps[0]["pattern"]["Regex"]).findall

    def _encoded(self, some: list[str]) -> list[bytes]:
        found = self.tokenizer.encode_batch_fast(some, add_special_tokens=False)
        return [np.array(f.ids, "<u4").tobytes() for f in found]

    def _pieces(self, some: list[str]) -> list[bytes]:
        """Ids of pieces, encoded as one text."""
        ids = np.array(self.bare.encode_batch_fast([" ".join(some)], add_special_tokens=False)[0].ids, "<u4")
        cuts = [0, *(4 * (np.flatnonzero(self.last[ids]) + 1)).tolist()]
        if len(cuts) != len(some) + 1:
            return self._encoded(some)
        raw = ids.tobytes()
        return [raw[begin:end] for begin, end in zip(cuts, cuts[1:])]

    def _learn(self, new: list[str]) -> None:
        """Remember the ids of words that are not known yet."""
        cut = {}
        if self.find_pieces:
            pieces = [w for w in new if LETTERS(w)] if self.normalized else []
            single = set(pieces)
            # Elsewhere tables of letters may differ from those of the tokenizer.
            latin = [w for w in new if w not in single and LATIN(w)]
            # Words of these letters have no white space, so they are normalised as one text.
            joined = " ".join(latin)
            normal = self.tokenizer.normalizer.normalize_str(joined) if self.tokenizer.normalizer else joined
            forms = normal.split(" ")
            if len(forms) == len(latin):
                cut = dict(zip(latin, map(self.find_pieces, forms)))
            new = [w for w in new if w not in single and w not in cut]
            pieces += self.words.missing(set().union(*cut.values()) - single)
            for at in range(0, len(pieces), 4096):
                some = pieces[at : at + 4096]
                self.words.now.update(zip(some, self._pieces(some)))
            known = self.words.now.__getitem__
            self.words.now.update([(w, b"".join(map(known, parts))) for w, parts in cut.items()])
        for at in range(0, len(new), 4096):
            some = new[at : at + 4096]
            self.words.now.update(zip(some, self._encoded(some)))

    def _parted(self, text: str) -> str:
        """The text with spaces between its parts."""
        if self.normalized and self.find_pieces and PLAIN(text):
            text = MARK(r" \g<0>", text.lower())
        return text.replace("\n", " ")

    def __call__(self, texts: list[str]) -> list[np.ndarray]:
        self.words.turn()
        parts = pc.split_pattern(pa.array(map(self._parted, texts), pa.large_string()), " ")
        each = parts.flatten().dictionary_encode()
        words = each.dictionary.to_pylist()
        self._learn(self.words.missing(words))
        packed = list(map(self.words.now.__getitem__, words))
        ids = np.frombuffer(b"".join(packed), "<u4")
        # Where the ids of each different word begin and end, then those of each word of the texts.
        sizes = np.fromiter(map(len, packed), np.int64, len(packed)) // 4
        at = each.indices.to_numpy()
        lengths = sizes[at]
        ends = np.concatenate([[0], np.cumsum(lengths)])
        shift = (np.cumsum(sizes) - sizes)[at] - ends[:-1]
        found = ids[np.repeat(shift, lengths) + np.arange(ends[-1])]
        cuts = ends[parts.offsets.to_numpy()].tolist()
        return [found[begin:end] for begin, end in zip(cuts, cuts[1:])]


class Memory:
    """Two generations: a full one becomes the old one, and what is used again moves on to the new one."""

    def __init__(self, most: int):
        self.most = most
        self.now: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}

    def turn(self) -> None:
        if len(self.now) > self.most:
            self.old, self.now = self.now, {}

    def missing(self, some: Iterable[str]) -> list[str]:
        """Those of them, all different, that are in neither generation."""
        out = []
        for s in some:
            if s in self.now:
                continue
            if (known := self.old.get(s)) is None:
                out.append(s)
            else:
                self.now[s] = known
        return out


def _bounded(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """The rows in slices of at most ``TEXTS`` texts and of ``TEXT_BYTES``, or of one text."""
    ends = np.cumsum(pc.binary_length(batch.column(1)).to_numpy(), dtype=np.int64)
    at = 0
    while at < batch.num_rows:
        before = int(ends[at - 1]) if at else 0
        fit = int(np.searchsorted(ends, before + TEXT_BYTES, "right")) - at
        n = min(max(fit, 1), TEXTS)
        yield batch.slice(at, n)
        at += n


def _encoder(path: str) -> Encoder:
    """The encoder of this Python worker."""
    return worker_tools.keep(("tokenizer", path), lambda: Encoder(path))


def write_token_files(
    docs: DataFrame,
    folder: str,
    tokenizer_path: str,
    end_id: int,
    *,
    key: str = "doc_id",
    text: str = "text",
    partitions: int | None = None,
) -> DataFrame:
    """Write shards below ``folder`` and return their manifest: (part, shard, path, n_docs, n_ids), in key order."""
    spark = docs.sparkSession
    n = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = docs.select(F.col(key).cast("bigint").alias("key"), F.coalesce(text, F.lit("")).alias("text"))
    ordered = rows.withColumn("h", F.xxhash64("text")).repartitionByRange(n, "key", "h")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = _encoder(tokenizer_path)
        files, place = _store(folder)
        files.create_dir(place, recursive=True)
        part, shards = TaskContext.get().partitionId(), 0
        keys: list[int | None] = []
        ids: list[np.ndarray] = []

        def flush() -> pa.RecordBatch:
            name = f"part-{part:06d}-{shards:06d}-{uuid.uuid4().hex}.pfor"
            with files.open_output_stream(f"{place}/{name}") as out:
                out.write(encode_shard(keys, ids))
            row = {
                "part": part,
                "shard": shards,
                "path": f"{folder}/{name}",
                "n_docs": len(keys),
                "n_ids": sum(map(len, ids)),
            }
            keys.clear()
            ids.clear()
            return pa.RecordBatch.from_pylist([row], schema=MANIFEST)

        held = 0
        for batch in batches:
            for some in _bounded(batch):
                for k, found in zip(some.column(0).to_pylist(), encode(some.column(1).to_pylist())):
                    keys.append(k)
                    ids.append(np.append(found, np.uint32(end_id)))
                    held += len(ids[-1])
                if held >= SHARD_IDS:
                    yield flush()
                    shards, held = shards + 1, 0
        if keys:
            yield flush()

    manifest = (
        ordered.sortWithinPartitions(F.col("key").asc_nulls_first(), "h", "text")
        .select("key", "text")
        .mapInArrow(run, "part bigint, shard bigint, path string, n_docs bigint, n_ids bigint")
    )
    return stage(manifest, "token-manifest")


MANIFEST = pa.schema(
    [("part", pa.int64()), ("shard", pa.int64()), ("path", pa.string()), ("n_docs", pa.int64()), ("n_ids", pa.int64())]
)


def with_starts(manifest: DataFrame) -> DataFrame:
    """The manifest with ``start``: the number of ids in all shards before. Sums per part come first, so that the one
    task that adds up all parts has a row for each of them only."""
    parts = manifest.groupBy("part").agg(F.sum("n_ids").alias("of_part"))
    whole = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = parts.select("part", F.coalesce(F.sum("of_part").over(whole), F.lit(0)).alias("offset"))
    inside = Window.partitionBy("part").orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    return (
        manifest.withColumn("inside", F.coalesce(F.sum("n_ids").over(inside), F.lit(0)))
        .join(offsets, "part")
        .withColumn("start", F.col("offset") + F.col("inside"))
        .drop("inside", "offset")
    )


def read_token_files(manifest: DataFrame, *, key: str = "doc_id") -> DataFrame:
    """(key, start, n_tokens, ids_crc32) of every document, from the files: ``start`` counts the ids of all documents
    before it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                files, place = _store(row["path"])
                with files.open_input_file(place) as source:
                    shard = Shard(source.read_buffer())
                found = [
                    (k, row["start"] + first, len(ids), zlib.crc32(ids.astype("<u4").tobytes()))
                    for k, first, ids in shard.documents()
                ]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, pa.int64()) for c in zip(*found)], names=["key", "start", "n_tokens", "ids_crc32"]
                )

    # With a number, since adaptive execution would put the few rows of many files into one task.
    tasks = int(manifest.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return (
        with_starts(manifest)
        .select("path", "start")
        .repartition(tasks, "path")
        .mapInArrow(run, "key bigint, start bigint, n_tokens bigint, ids_crc32 bigint")
        .withColumnRenamed("key", key)
    )


def write_and_read(spark: SparkSession, docs: DataFrame, folder: str, tokenizer_path: str, end_id: int) -> DataFrame:
    """Write the documents to token files and describe each of them as the files tell."""
    return read_token_files(write_token_files(docs, folder, tokenizer_path, end_id))
