import hashlib
import random
import zlib

import numpy as np
import public_tokenizers
import regex
import tiktoken
from llm_odd import ODD, table  # noqa: F401
from tokenizers import Tokenizer

from tidewatch.llm import bpe, token_files
from tidewatch.sources.staging import staging_path

RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
WORDS = public_tokenizers.path("word_bpe_49k.json")
r = random.Random(5)
STRANGE = [
    "a" * 3000,
    "antidisestablishmentarianism" * 30,
    "it's 'S we'll\t\n\r\n  x  ",
    "a\x1cb \x1d c \x85   d",
    "<|endoftext|> x",
    "İstanbul ΑΣ ǅ ß é 🙂🙂",
    *["".join(r.choice("etaoin rsh\n") for _ in range(400)) for _ in range(40)],
    *["".join(chr(r.choice([r.randint(1, 127), r.randint(160, 0x2FFF), r.randint(0x1F300, 0x1F6FF)])) for _ in range(400)) for _ in range(20)],
]


def reference():
    ranks = bpe.load_ranks(RANKS)
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_transducer_is_the_tokenizer():
    known, ranks = reference(), bpe.load_ranks(RANKS)
    encode = bpe.Encoder(ranks, public_tokenizers.PATTERN, max_words=50)
    small = bpe.Transducer(ranks, max_states=300)
    decode = bpe.Decoder(ranks, chunk=3)
    for text in [t or "" for t in ODD] + STRANGE:
        want = known.encode_ordinary(text)
        assert np.frombuffer(encode(text), "<u4").tolist() == want
        assert [i for w in regex.findall(public_tokenizers.PATTERN, text) for i in small.encode(w.encode())] == want
        assert decode.text(want) == text
    assert len(small._states) <= 300 + 10_001


def test_utf8_stream_equals_decoding_at_once():
    rng = random.Random(2)
    whole = [bytes(rng.choice([65, 0x80, 0xC3, 0xA9, 0xE2, 0x82, 0xAC, 0xF0, 0x9F, 0xFF]) for _ in range(40)) for _ in range(300)]
    for data in whole + ["é漢🙂".encode() * 3]:
        stream = bpe.Utf8Stream()
        parts = [stream.feed(data[i : i + 1]) for i in range(len(data))]
        assert "".join(parts) + stream.close() == data.decode("utf-8", "replace")


def test_documents_and_back(table):
    docs = table(ODD)
    got = {x["doc_id"]: x for x in bpe.digests(docs, RANKS, public_tokenizers.PATTERN).collect()}
    known = reference()
    for i, text in enumerate(ODD):
        ids = known.encode_ordinary(text or "")
        assert got[i]["n_tokens"] == len(ids)
        assert got[i]["ids_sha256"] == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert got[i]["decoded_sha256"] == hashlib.sha256((text or "").encode()).hexdigest()
    encoded = bpe.encode_documents(docs, RANKS, public_tokenizers.PATTERN)
    back = {x["doc_id"]: x["text"] for x in bpe.decode_documents(encoded, RANKS).collect()}
    assert back == {i: t or "" for i, t in enumerate(ODD)}
    assert bpe.digests(docs.where("false"), RANKS, public_tokenizers.PATTERN).count() == 0


def test_blocks_round_trip():
    rng = np.random.default_rng(0)
    for n in (0, 1, 5, 4095, 4096, 4097, 9000):
        for top in (1, 2, 300, 50_000, 2**32 - 1):
            values = rng.integers(0, top, n, dtype=np.uint64).astype(np.uint32)
            values[::97] = 2**31
            stream = token_files.Stream(memoryview(token_files.encode_stream(values)))
            assert (stream.read(0, n) == values).all()
            assert (stream.read(n // 3, n - n // 5) == values[n // 3 : n - n // 5]).all()


def test_exceptions_keep_blocks_narrow():
    values = np.arange(4096, dtype=np.uint32) % 16
    values[::100] = 2**30
    assert len(token_files.encode_block(values)) < 4096 * 4 / 8 + 41 * 6 + 16


def test_word_memory_equals_whole_texts():
    encode = token_files.Encoder(WORDS, max_words=10)
    texts = [t or "" for t in ODD] + STRANGE
    for text, ids in zip(texts, encode(texts)):
        assert ids.tolist() == encode.tokenizer.encode(text, add_special_tokens=False).ids


def test_pieces_equal_whole_words():
    """Words of Latin letters are cut by the pattern of the file; all kinds of borders, and no pattern at all."""
    marks = ["", "'s", "'t", "'re", "'ve", "'m", "'ll", "'d", "'", "''s", "...", "-", "_", "1", "42", "É", "ß", "ÿ", "µ", "×", "İ", "<0>"]
    words = [a + b + c for a in marks for b in marks for c in ("x", "Hello", "ÀÉ", "naïve", "")]
    texts = [" ".join(words), "<|endoftext|>x <|startoftext|>", "e\u0301 \u0301x x\u0301", *words[::7]]
    encode, plain = token_files.Encoder(WORDS), token_files.Encoder(WORDS, max_words=3)
    plain.find_pieces = None
    assert encode.find_pieces
    for text, ids, same in zip(texts, encode(texts), plain(texts)):
        assert ids.tolist() == same.tolist() == encode.tokenizer.encode(text, add_special_tokens=False).ids


def test_files_hold_documents_in_order(spark, table, monkeypatch):
    tokenizer = Tokenizer.from_file(WORDS)
    texts, ids = [*ODD, "x", "y z"], [5, 3, None, 9, 1, 7, 7, 2, 8, 0, 4]
    got = token_files.write_and_read(spark, table(texts, ids), staging_path(spark, "files"), WORDS, 2).collect()
    assert len(got) == len(texts)
    at = 0
    hashes = {r["text"]: r["h"] for r in spark.createDataFrame([(t or "",) for t in set(texts)], "text string").selectExpr("text", "xxhash64(text) h").collect()}
    for i, text in sorted(zip(ids, texts), key=lambda p: (p[0] is not None, p[0] or 0, hashes[p[1] or ""])):
        want = tokenizer.encode(text or "", add_special_tokens=False).ids + [2]
        row = (i, at, len(want), zlib.crc32(np.array(want, "<u4").tobytes()))
        assert tuple(next(g for g in got if g["start"] == at)) == row
        at += len(want)
    empty = token_files.write_and_read(spark, table(texts).where("false"), staging_path(spark, "none"), WORDS, 2)
    assert empty.count() == 0


def test_plain_texts_learn_each_piece_once():
    """Case, commas and full stops make no new words; borders where they do belong to a piece are left alone."""
    encode = token_files.Encoder(WORDS)
    (ids,) = encode(["Word, word. WORD\nword, Word."])
    assert ids.tolist() == encode.tokenizer.encode("Word, word. WORD\nword, Word.", add_special_tokens=False).ids
    assert set(encode.words.now) <= {"word", ",", "."}
    rng = random.Random(11)
    texts = ["".join(rng.choice("aZéÉßÿ,,..!' \n1-sT\t\xa0µİ"[: rng.choice([16, 17, 21])]) for _ in range(60)) for _ in range(400)]
    for text, found in zip(texts, encode(texts)):
        assert found.tolist() == encode.tokenizer.encode(text, add_special_tokens=False).ids


def test_slices_are_bounded_and_whole(monkeypatch):
    monkeypatch.setattr(token_files, "TEXTS", 3)
    monkeypatch.setattr(token_files, "TEXT_BYTES", 10)
    texts = ["", "x" * 30, "", "ab", "cd", "ef", "gh", "é" * 5, "y" * 11, "z", ""]
    batch = token_files.pa.record_batch({"key": list(range(len(texts))), "text": texts})
    slices = [s.column(1).to_pylist() for s in token_files._bounded(batch)]
    assert [t for s in slices for t in s] == texts
    assert all(len(s) <= 3 and (len(s) == 1 or sum(len(t.encode()) for t in s) <= 10) for s in slices)
    assert len(slices) == 7
    assert not list(token_files._bounded(batch.slice(0, 0)))
