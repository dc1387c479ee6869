"""Byte-level BPE by a lazily determinised finite-state transducer, and a streaming decoder.

**Encoding.** The encoding of a prefix of a word is the encoding of a shorter prefix plus one token, and a sequence of
tokens is an encoding if any two neighbours are (they come out when the bytes of both are encoded together). So after
each byte the transducer need only know, for every earlier place from which a token may still grow, how far that token
has come in the trie of the vocabulary and which tokens led there. Tokens on which all those places agree can no longer
change and are emitted; the rest waits, for no more bytes than the longest token has. Such a configuration is a state.
States and arcs are made when a text first needs them and kept; a table that is full is started anew.

**Decoding.** Tokens cut characters anywhere. The decoder feeds the bytes of each chunk of tokens to a UTF-8 state
machine that carries an unfinished character over to the next chunk and replaces bytes that can't be part of one.

* NULL and empty texts have no tokens. Repeated rows are encoded one by one; an empty table gives an empty table.
* Texts without spaces are one word of any length: the transducer works through it with bounded memory.
* Strings of special tokens are ordinary text. Ids that the vocabulary lacks are an error in the decoder.
"""

from __future__ import annotations

import base64
import hashlib
import sys
from array import array
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from tidewatch.llm import worker_tools

#: Bounds of the tables of a Python worker: states of the transducer, remembered words.
MAX_STATES = 400_000
MAX_WORDS = 250_000
#: Words of more bytes are not remembered.
LONGEST_WORD = 64


def load_ranks(path: str) -> dict[bytes, int]:
    """A rank file: a token in base 64 and its rank in every line."""
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


class Transducer:
    """Encodes words, i.e. matches of the pre-tokeniser's pattern, to ids."""

    def __init__(self, ranks: dict[bytes, int], max_states: int = MAX_STATES):
        self.ranks = ranks
        self.token = {rank: token for token, rank in ranks.items()}
        self.max_states = max_states
        self._pairs: dict[tuple[int, int], bool] = {}
        self._trie()
        self._reset()

    def _trie(self) -> None:
        """Nodes are numbers: the child by node and byte, the token that ends at a node, whether it has children."""
        self.child: dict[int, int] = {}
        self.ends, self.inner = array("i", [-1]), bytearray(1)
        for token, rank in self.ranks.items():
            at = 0
            for byte in token:
                below = self.child.get(at << 8 | byte)
                if below is None:
                    below = self.child[at << 8 | byte] = len(self.ends)
                    self.inner[at] = 1
                    self.ends.append(-1)
                    self.inner.append(0)
                at = below
            self.ends[at] = rank

    def _reset(self) -> None:
        # A state: the last emitted token (-1 at the start, -2 where it cannot matter any more), then for each place its
        # node in the trie, the number of tokens that wait, and these; the last place is the end of what was read. As
        # bytes a state takes a tenth of the memory of tuples.
        start = array("i", [-1, 0, 0]).tobytes()
        self._ids = {start: 0}
        self._states = [start]
        self._arcs: list[dict[int, tuple[int, tuple[int, ...]]]] = [{}]
        self._rest: dict[int, tuple[int, ...]] = {}

    def _state(self, key: bytes) -> int:
        known = self._ids.get(key)
        if known is None:
            known = self._ids[key] = len(self._states)
            self._states.append(key)
            self._arcs.append({})
        return known

    @staticmethod
    def _places(key: bytes) -> tuple[int, list[tuple[int, tuple[int, ...]]]]:
        numbers = array("i", key)
        places, at = [], 1
        while at < len(numbers):
            end = at + 2 + numbers[at + 1]
            places.append((numbers[at], tuple(numbers[at + 2 : end])))
            at = end
        return numbers[0], places

    def merged(self, piece: bytes) -> list[int]:
        """The encoding by merging the pair of lowest rank until none is left; for the few bytes of token pairs."""
        parts = [piece[i : i + 1] for i in range(len(piece))]
        while len(parts) > 1:
            rank, at = min(
                (self.ranks.get(parts[i] + parts[i + 1], sys.maxsize), i) for i in range(len(parts) - 1)
            )
            if rank == sys.maxsize:
                break
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return [self.ranks[p] for p in parts]

    def _follows(self, before: int, token: int) -> bool:
        """Both tokens come out when their bytes are encoded together."""
        known = self._pairs.get((before, token))
        if known is None:
            if len(self._pairs) >= 1_000_000:
                self._pairs.clear()
            if before < 0:
                known = self.merged(self.token[token]) == [token]
            else:
                known = self.merged(self.token[before] + self.token[token]) == [before, token]
            self._pairs[before, token] = known
        return known

    def _arc(self, state: int, byte: int) -> tuple[int, tuple[int, ...]]:
        """The arc of a byte: the next state and the tokens that are now certain."""
        context, places = self._places(self._states[state])
        grown, chain = [], None
        for node, waiting in places:
            below = self.child.get(node << 8 | byte)
            if below is None:
                continue
            if self.inner[below]:
                grown.append((below, waiting))
            token = self.ends[below]
            if chain is None and token >= 0 and self._follows(waiting[-1] if waiting else context, token):
                chain = (*waiting, token)
        if chain is None:
            raise ValueError(f"no token ends with byte {byte} here")
        grown.append((0, chain))
        shortest = min(len(waiting) for _, waiting in grown)
        sure = 0
        while sure < shortest and all(waiting[sure] == chain[sure] for _, waiting in grown):
            sure += 1
        last = chain[sure - 1] if sure else context
        numbers = array("i", [last if sure == shortest else -2])
        for node, waiting in grown:
            numbers.extend((node, len(waiting) - sure, *waiting[sure:]))
        arc = self._arcs[state][byte] = (self._state(numbers.tobytes()), chain[:sure])
        return arc

    def encode(self, word: bytes) -> list[int]:
        """Ids of one word."""
        whole = self.ranks.get(word)
        if whole is not None:
            return [whole]
        if len(self._states) > self.max_states:
            self._reset()
        state, out, arcs = 0, [], self._arcs
        for byte in word:
            arc = arcs[state].get(byte)
            if arc is None:
                arc = self._arc(state, byte)
                if len(self._states) > self.max_states + 10_000:
                    # A very long word: keep its configuration only.
                    key = self._states[arc[0]]
                    self._reset()
                    arcs = self._arcs
                    arc = (self._state(key), arc[1])
            state = arc[0]
            if arc[1]:
                out.extend(arc[1])
        rest = self._rest.get(state)
        if rest is None:
            rest = self._rest[state] = self._places(self._states[state])[1][-1][1]
        out.extend(rest)
        return out


class Encoder:
    """Encodes texts: cuts them into words by a pattern, looks up words seen before, else runs the transducer.

    The pattern of byte-level BPE lets a word begin with one space but not go beyond it. So a space between two other
    characters that are not white space always begins a word, and texts may be cut there and remembered in parts.
    """

    def __init__(self, ranks: dict[bytes, int], pattern: str, max_words: int = MAX_WORDS):
        self.transducer = Transducer(ranks)
        self.split = regex.compile(pattern).findall
        self.words: dict[str, bytes] = {}
        # Two generations: a full one becomes the old one, and what is used again moves on to the new one.
        self.parts: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}
        self.max_words = max_words

    def _word(self, word: str) -> bytes:
        raw = word.encode()
        ids = array("I", self.transducer.encode(raw))
        if sys.byteorder == "big":
            ids.byteswap()
        packed = ids.tobytes()
        if len(raw) <= LONGEST_WORD:
            if len(self.words) >= self.max_words // 4:
                self.words.clear()
            self.words[word] = packed
        return packed

    def _cut(self, text: str) -> bytes:
        known = self.words.get
        return b"".join([known(word) or self._word(word) for word in self.split(text)])

    def _remember(self, part: str, packed: bytes) -> None:
        if len(self.parts) >= self.max_words:
            self.old, self.parts = self.parts, {}
        self.parts[part] = packed

    def __call__(self, text: str) -> bytes:
        """Ids as little-endian unsigned 32-bit integers."""
        parts = text.split(" ")
        packed = list(map(self.parts.get, parts))
        packed[0] = None
        done = 0
        for k in [k for k, p in enumerate(packed) if p is None]:
            if k < done:
                continue
            if k and (found := self.old.get(parts[k])) is not None:
                self._remember(parts[k], found)
                packed[k] = found
                continue
            # Put parts together again where white space meets the cut; known parts have none at their ends.
            first = last = k
            while first > 0 and _blank_start(parts[first]):
                first -= 1
            while last + 1 < len(parts) and (_blank_end(parts[last]) or _blank_start(parts[last + 1])):
                last += 1
            joined = " ".join(parts[first : last + 1])
            found = self._cut(" " + joined if first else joined)
            if first and first == last and len(joined) <= LONGEST_WORD:
                self._remember(joined, found)
            packed[first : last + 1] = [found] + [b""] * (last - first)
            done = last + 1
        return b"".join(packed)


def _blank_start(part: str) -> bool:
    return not part or part[0].isspace()


def _blank_end(part: str) -> bool:
    return not part or part[-1].isspace()


class Utf8Stream:
    """Incremental UTF-8: bytes in any portions in, text out.

    The state is the number of continuation bytes that are still due and the range that the next one must lie in.
    A maximal part of a character that cannot be completed becomes one replacement character.
    """

    def __init__(self) -> None:
        self.held = b""

    @staticmethod
    def _lead(byte: int) -> tuple[int, int, int]:
        """Continuation bytes after a first byte and the range of the first of them."""
        if 0xC2 <= byte <= 0xDF:
            return 1, 0x80, 0xBF
        if 0xE0 <= byte <= 0xEF:
            return 2, 0xA0 if byte == 0xE0 else 0x80, 0x9F if byte == 0xED else 0xBF
        if 0xF0 <= byte <= 0xF4:
            return 3, 0x90 if byte == 0xF0 else 0x80, 0x8F if byte == 0xF4 else 0xBF
        return 0, 0, 0

    def _unfinished(self, data: bytes) -> int:
        """Bytes at the end that may still become a character."""
        for back in range(1, min(3, len(data)) + 1):
            byte = data[-back]
            if byte & 0xC0 == 0x80:
                continue
            due, low, high = self._lead(byte)
            if due < back:
                return 0
            if back > 1 and not low <= data[1 - back] <= high:
                return 0
            return back
        return 0

    def feed(self, data: bytes) -> str:
        """The text that is certain after these bytes."""
        data = self.held + data
        keep = self._unfinished(data)
        self.held = data[len(data) - keep :]
        return data[: len(data) - keep].decode("utf-8", "replace")

    def close(self) -> str:
        """What is left: an unfinished character is replaced."""
        held, self.held = self.held, b""
        return held.decode("utf-8", "replace")


class Decoder:
    """Ids to text, a chunk of tokens at a time."""

    def __init__(self, ranks: dict[bytes, int], chunk: int = 4096):
        self.token = {rank: token for token, rank in ranks.items()}
        self.chunk = chunk

    def pieces(self, ids: np.ndarray) -> Iterator[bytes]:
        """The bytes of each chunk."""
        token = self.token.__getitem__
        for at in range(0, len(ids), self.chunk):
            yield b"".join(map(token, ids[at : at + self.chunk].tolist()))

    def text(self, ids: np.ndarray | Iterable[int]) -> str:
        stream = Utf8Stream()
        parts = [stream.feed(piece) for piece in self.pieces(np.asarray(ids, dtype=np.uint32))]
        return "".join([*parts, stream.close()])


def _tools(ranks_path: str, pattern: str) -> tuple[Encoder, Decoder]:
    """Encoder and decoder of this Python worker; they outlive a task where workers are reused."""

    def make() -> tuple[Encoder, Decoder]:
        ranks = load_ranks(ranks_path)
        return Encoder(ranks, pattern), Decoder(ranks)

    return worker_tools.keep(("bpe", ranks_path, pattern), make)


def encode_documents(
    docs: DataFrame, ranks_path: str, pattern: str, *, key: str = "doc_id", text: str = "text"
) -> DataFrame:
    """(key, ids): ids as an array of integers."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, _ = _tools(ranks_path, pattern)
        for batch in batches:
            ids = [np.frombuffer(encode(t or ""), "<u4").astype(np.int32) for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(ids, pa.list_(pa.int32()))], names=["key", "ids"])

    rows = docs.select(docs[key].alias("key"), docs[text].alias("text"))
    kind = rows.schema["key"].dataType.simpleString()
    return rows.mapInArrow(run, f"key {kind}, ids array<int>").withColumnRenamed("key", key)


def decode_documents(encoded: DataFrame, ranks_path: str, *, key: str = "doc_id", ids: str = "ids") -> DataFrame:
    """(key, text): the decoded texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        _, decoder = _tools(ranks_path, "")
        for batch in batches:
            texts = [decoder.text(i) for i in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], names=["key", "text"])

    rows = encoded.select(encoded[key].alias("key"), encoded[ids].alias("ids"))
    kind = rows.schema["key"].dataType.simpleString()
    return rows.mapInArrow(run, f"key {kind}, text string").withColumnRenamed("key", key)


def digests(docs: DataFrame, ranks_path: str, pattern: str, *, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, n_tokens, ids_sha256, decoded_sha256): each text is encoded, its ids are decoded again, and digests of the
    ids and of the decoded bytes are kept instead of both."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, decoder = _tools(ranks_path, pattern)
        for batch in batches:
            numbers, of_ids, of_text = [], [], []
            for t in batch.column(1).to_pylist():
                packed = encode(t or "")
                numbers.append(len(packed) // 4)
                of_ids.append(hashlib.sha256(packed).hexdigest())
                of_text.append(hashlib.sha256(decoder.text(np.frombuffer(packed, "<u4")).encode()).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(numbers, pa.int64()), pa.array(of_ids, pa.string()), pa.array(of_text, pa.string())],
                names=["key", "n_tokens", "ids_sha256", "decoded_sha256"],
            )

    rows = docs.select(docs[key].alias("key"), docs[text].alias("text"))
    kind = rows.schema["key"].dataType.simpleString()
    out = rows.mapInArrow(run, f"key {kind}, n_tokens bigint, ids_sha256 string, decoded_sha256 string")
    return out.withColumnRenamed("key", key)
