"""The whole pipeline against a plain version of its own, document by document."""

import hashlib
import re
from collections import Counter

import corpus_pipeline
import numpy as np
import public_tokenizers
import tiktoken
from llm_odd import DATA

from tidewatch.llm import bpe

BLANKS = re.compile(r"[\x20\x09-\x0D]+")
MASKED = re.compile(r"[0-9]")


def words(text):
    return [w for w in BLANKS.split(text) if w]


def inside(starts, width):
    return len({i + k for i in starts for k in range(width)})


def good(text):
    w, lines = words(text), [x for x in text.split("\n") if words(x)]
    n, chars = len(w), sum(map(len, w))
    grams = [tuple(w[i : i + 8]) for i in range(n - 7)]
    many = Counter(grams)
    foreign = sum("฀" <= c <= "࿿" or "　" <= c <= "ヿ" or "一" <= c <= "鿿" for c in text)
    units = n + foreign / 2
    return not (
        units < 20
        or 100 * inside([i for i, g in enumerate(grams) if many[g] > 1], 8) > 30 * n
        or 2 * sum(c in "#*$%&|<>" for c in text) > units
        or 2 * text.count("!") > units
        or 2 * sum("A" <= c <= "Z" for c in text) > chars
        or 2 * (len(lines) - len(set(lines))) > len(lines)
        or chars < 2 * n
        or chars - foreign > 15 * n
        or 10 * sum(len(set(w[i : i + 10_000])) for i in range(0, n, 10_000)) < n
    )


def templates(line):
    w = words(line)
    n, t = len(w), ["<*>" if MASKED.search(x) else x for x in w]
    holds = lambda part: 2 * sum(x != "<*>" for x in part) > n
    a, b = (n // 3, 2 * n // 3) if n >= 12 else ((n - n // 4) // 2, (n - n // 4) // 2 + n // 4)
    tail = 2 * n // 3 if n >= 12 else n - n // 4
    found = [(n, k, *part) for k, part in ((0, t[:tail]), (1, t[:a] + t[b:])) if n >= 4 and holds(part)]
    return found or ([(n, 2, *(t if holds(t) else w))] if n >= 4 else [])


def without_recurring_lines(docs):
    where = {}
    for i, text in sorted(docs.items()):
        for at, line in enumerate(text.split("\n")):
            for t in templates(line):
                where.setdefault(t, []).append((i, at))
    gone, staying = set(), set()
    for t, places in where.items():
        if len({i for i, _ in places}) >= (3 if t[0] >= 12 else 10):
            gone |= set(places)
            staying.add(min(places))
    gone -= staying
    holders = {i for i, _ in staying}
    out = {}
    for i, text in docs.items():
        lines = text.split("\n")
        lost = [x for at, x in enumerate(lines) if (i, at) in gone]
        size = lambda some: sum(len(words(x)) for x in some)
        if not lost or i in holders or 100 * size(lost) < 80 * size(lines):
            out[i] = "\n".join(x for at, x in enumerate(lines) if (i, at) not in gone)
    return out


def one_of_each(docs):
    sets = {}
    for i, text in docs.items():
        w = words("".join(c.lower() if "A" <= c <= "Z" else c for c in text))
        sets[i] = {tuple(w[k : k + 5]) for k in range(max(len(w) - 4, 1))} if w else set()
    root = {i: i for i in docs}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in docs:
        for j in docs:
            if i < j and sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= 75 * len(sets[i] | sets[j]):
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    return {i: text for i, text in docs.items() if find(i) == i}


def clean(docs, items):
    split = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in t or ""))
    known = {}
    for w in map(split, items):
        n = min(13, len(w))
        known.setdefault(n, set()).update(tuple(w[k : k + n]) for k in range(len(w) - n + 1 if n else 0))
    out = {}
    for i, text in docs.items():
        w = split(text)
        hit = {k + j for n, some in known.items() if n for k in range(len(w) - n + 1) if tuple(w[k : k + n]) in some for j in range(n)}
        if not hit or 20 * len(hit) < len(w):
            out[i] = text
    return out


def test_pipeline_against_brute_force(spark):
    rows = spark.read.parquet(f"{DATA}/documents.parquet").collect()
    docs = {r["doc_id"]: r["text"] or "" for r in rows}
    assert len(docs) == len(rows)
    items = [r["text"] for r in spark.read.parquet(f"{DATA}/benchmark.parquet").collect()]
    kept = clean(one_of_each(without_recurring_lines({i: t for i, t in docs.items() if good(t)})), items)
    assert 0 < len(kept) < len(docs)
    ranks = bpe.load_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken"))
    known = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    sha = lambda b: hashlib.sha256(b).hexdigest()
    want = {}
    for i, text in kept.items():
        ids = known.encode_ordinary(text)
        want[i] = (len(ids), sha(np.array(ids, "<u4").tobytes()), sha(text.encode()))
    got = {r["doc_id"]: tuple(r)[1:] for r in corpus_pipeline.run(spark, DATA).collect()}
    assert got == want
