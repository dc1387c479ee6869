import hashlib
from collections import Counter

import public_tokenizers
import pytest
import sentencepiece
from llm_odd import DATA, ODD, table  # noqa: F401
from tokenizers import Tokenizer

from tidewatch.llm import alignment

A = public_tokenizers.path("byte_bpe_50k.json")
B = public_tokenizers.path("piece_bpe_32k.model")
TEXTS = [*ODD, "hello world", "hello world", "x▁y", "<|endoftext|> <s>", "a\x00b", "  two  blanks\r\n", "naïve 漢字🙂 12345"]


ALPHABET = alignment.byte_alphabet()


def spelled_a(token):
    return bytes(ALPHABET[c] for c in token)


def spelled_b(piece):
    if len(piece) == 6 and piece.startswith("<0x"):
        return bytes([int(piece[3:5], 16)])
    return piece.replace("▁", " ").encode()


def by_hand(texts):
    """The same numbers from byte ranges, token by token."""
    a, b = Tokenizer.from_file(A), sentencepiece.SentencePieceProcessor(model_file=B)
    a.encode_special_tokens = True
    rows = []
    for text in texts:
        found = a.encode(" " + text, add_special_tokens=False) if text else None
        sides = []
        if text:
            for ids, spell in ((found.ids, lambda i: spelled_a(a.id_to_token(i))), (b.encode(text), lambda i: spelled_b(b.id_to_piece(i)))):
                at, side = 0, []
                for i in ids:
                    side.append((i, at, at + len(spell(i))))
                    at = side[-1][2]
                sides.append((side, b"".join(spell(i) for i in ids)))
        if not text or not sides[0][1] == sides[1][1] == (" " + text).encode():
            rows.append(((0, 0, 0, 0), [], ""))
            continue
        (left, _), (right, _) = sides
        links, k = [], 0
        for i, begin, end in left:
            while right[k][2] <= begin:
                k += 1
            j = k
            while j < len(right) and right[j][1] < end:
                links.append((i, right[j][0]))
                j += 1
        cuts = sorted({e for _, _, e in left} & {e for _, _, e in right})
        groups, before = [], 0
        x = y = 0
        for cut in cuts:
            ids_a, ids_b = [], []
            while x < len(left) and left[x][2] <= cut:
                ids_a.append(str(left[x][0]))
                x += 1
            while y < len(right) and right[y][2] <= cut:
                ids_b.append(str(right[y][0]))
                y += 1
            groups.append(",".join(ids_a) + "|" + ",".join(ids_b))
            before = cut
        assert before == len(sides[0][1])
        digest = hashlib.sha256(";".join(groups).encode()).hexdigest()
        rows.append(((len(left), len(right), len(groups), len(links)), links, digest))
    counts = Counter(p for _, links, _ in rows for p in links)
    best = {}
    for (_, j), n in counts.items():
        best[j] = max(best.get(j, 0), n)
    out = []
    for numbers, links, digest in rows:
        n_best = sum(counts[p] == best[p[1]] for p in links)
        out.append((*numbers, n_best, sum(counts[p] for p in links), digest))
    return out, counts


COLUMNS = ["n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]


@pytest.mark.parametrize("heavy", [alignment.HEAVY, 20])
def test_odd_texts_against_byte_ranges(spark, table, monkeypatch, heavy):
    monkeypatch.setattr(alignment, "HEAVY", heavy)
    want, counts = by_hand([t or "" for t in TEXTS])
    got, pairs = alignment.align_documents(table(TEXTS), A, B)
    got = {r["doc_id"]: tuple(r[c] for c in COLUMNS) for r in got.collect()}
    assert got == dict(enumerate(want))
    assert {(r["a"], r["b"]): r["links"] for r in pairs.collect()} == counts


@pytest.mark.parametrize("heavy", [alignment.HEAVY, 300])
def test_documents_against_byte_ranges(spark, monkeypatch, heavy):
    """A small bound leaves most pairs to the join."""
    monkeypatch.setattr(alignment, "HEAVY", heavy)
    docs = spark.read.parquet(f"{DATA}/documents.parquet").repartition(5)
    rows = docs.collect()
    want, _ = by_hand([r["text"] or "" for r in rows])
    got = alignment.align_documents(docs, A, B)[0].collect()
    assert sorted((r["doc_id"], *(r[c] for c in COLUMNS)) for r in got) == sorted((r["doc_id"], *w) for r, w in zip(rows, want))


def test_remembered_words_equal_whole_texts():
    """Cuts at spaces of all kinds, with a memory that is full at once, a large one, and none."""
    marks = ["", "  ", "   ", "\n", " \n", "\n ", " \n ", "\n\n", "\t", " . ", "漢", " é", "'s", " 's ", "\r\n", "▁", " ▁", "\u0301", "\xa0", "..."]
    texts = [a + x + b + y + c for a in marks for b in marks for c in ("", "end", " end ") for x, y in (("word", "Naïve1"), ("", "ß"))]
    a, b = Tokenizer.from_file(A), sentencepiece.SentencePieceProcessor(model_file=B)
    a.encode_special_tokens = True
    files = alignment.tokenizer_files(A, B)
    small, large, plain = alignment.Aligner(*files, max_words=3), alignment.Aligner(*files), alignment.Aligner(*files)
    assert large.cuts
    plain.cuts = False
    for some in (texts, texts[::-1], [" ".join(texts)]):
        for aligner in (small, large, plain):
            for t, (ids_a, ids_b) in zip(some, aligner._ids(some), strict=True):
                assert ids_a.tolist() == a.encode(" " + t, add_special_tokens=False).ids
                assert ids_b.tolist() == b.encode(t), t


def test_counts_are_handed_on_in_parts(spark, table, monkeypatch):
    """Tasks that hold few pairs and rows of few counts give the same."""
    monkeypatch.setattr(alignment, "HELD_PAIRS", 4)
    monkeypatch.setattr(alignment, "ROW_PAIRS", 3)
    monkeypatch.setattr(alignment, "BATCH_TEXTS", 2)
    want, _ = by_hand([t or "" for t in TEXTS])
    got = alignment.align_documents(table(TEXTS), A, B)[0].collect()
    assert {r["doc_id"]: tuple(r[c] for c in COLUMNS) for r in got} == dict(enumerate(want))


def test_keys_that_repeat_or_are_missing(spark, table):
    texts, ids = ["some text", "other words", "some text", None, "é"], [1, 1, None, None, 2]
    want, _ = by_hand([t or "" for t in texts])
    got = alignment.align_documents(table(texts, ids), A, B)[0].collect()
    by_key = lambda r: (r[0] is None, r[0] or 0, r[1:])
    rows = [(r["doc_id"], *(r[c] for c in COLUMNS)) for r in got]
    assert sorted(rows, key=by_key) == sorted([(i, *w) for i, w in zip(ids, want)], key=by_key)


def test_empty_table(spark, table):
    got, pairs = alignment.align_documents(table(ODD).where("false"), A, B)
    assert got.count() == 0 and pairs.count() == 0
