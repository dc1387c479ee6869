import math
import random
import re
from collections import Counter

import numpy as np
import pytest
from llm_odd import DATA, ODD, table  # noqa: F401

from tidewatch.llm import lexical_search as search


def terms(text):
    lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", lowered)


def by_hand(docs, items, top=50):
    """(item, rank, key, score) from every term of every item in every document."""
    held = [(k, Counter(terms(t))) for k, t in docs]
    held = [(k, c, sum(c.values())) for k, c in held if c]
    n_docs, length = len(held), sum(n for _, _, n in held)
    df = Counter(t for _, c, _ in held for t in c)
    out = []
    for item, text in items:
        scored = []
        for key, counts, n in held:
            m = 100 - 50 + (50 * n * n_docs) // length
            score = 0
            for t in set(terms(text)):
                w = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1)))
                score += w * ((1000000000 * counts[t]) // (1000 * counts[t] + 20 * m))
            if score > 0:
                scored.append((-score, key is None, key, score))
        scored.sort(key=lambda s: (s[0], s[1], s[2] or 0))
        out += [(item, rank, key, score) for rank, (_, _, key, score) in enumerate(scored[:top], 1)]
    return out


def rows(df):
    return sorted(map(tuple, df.select("item_id", "rank", "doc_id", "score").collect()), key=str)


ITEMS = [
    (1, "Word same TEXT here"),
    (2, "a b c d e same text"),
    (3, "a b c d e word"),
    (4, "a b c d e word"),
    (5, None),
    (6, " .,; "),
    (None, "É漢字🙂 Éx unknown text"),
    (6, "long LONG word x"),
]


@pytest.mark.parametrize("block_terms", [search.BLOCK_TERMS, 5])
def test_odd_texts(spark, table, block_terms):
    texts = [*ODD, "same text here", "same TEXT here", "a a a b", "x" * 200_000]
    ids = [*range(9), 20, None, 15, 3]
    items = spark.createDataFrame(ITEMS, "item_id int, text string")
    got = search.search(table(texts, ids), items, block_terms=block_terms, top=5)
    assert rows(got) == sorted(by_hand(list(zip(ids, texts)), ITEMS, 5), key=str)


def test_ties_beyond_the_top(spark, table):
    """Many equal documents: the smallest keys win, wherever they stand."""
    order = list(range(3000))
    random.Random(1).shuffle(order)
    docs = table(["the same words", "others entirely"] * 1500, order, 7)
    items = spark.createDataFrame([(1, "same words"), (2, "entirely others words")], "item_id int, text string")
    want = by_hand([(k, ["the same words", "others entirely"][at % 2]) for at, k in enumerate(order)], [(1, "same words"), (2, "entirely others words")])
    assert rows(search.search(docs, items)) == sorted(want, key=str)


def test_documents_by_hand(spark):
    docs = spark.read.parquet(f"{DATA}/documents.parquet").repartition(4)
    items = spark.read.parquet(f"{DATA}/benchmark.parquet")
    want = by_hand([tuple(r) for r in docs.select("doc_id", "text").collect()], [tuple(r) for r in items.select("item_id", "text").collect()])
    assert rows(search.search(docs, items)) == sorted(want, key=str)


def test_empty_tables(spark, table):
    items = spark.createDataFrame(ITEMS, "item_id int, text string")
    assert search.search(table(ODD).where("false"), items).count() == 0
    assert search.search(table(ODD), items.where("false")).count() == 0
    assert search.search(table([None, "", "..."]), items).count() == 0


def test_graph_adds_up_and_shares():
    rng = random.Random(4)
    common = [rng.sample(range(60), 12) for _ in range(5)]
    queries = []
    for k in range(80):
        q = set(rng.sample(range(200), rng.randint(0, 10)))
        if k % 2:
            q |= set(common[k % 5])
        queries.append(sorted(q))
    queries += queries[:7] + [[]]
    graph = search.mine(queries, 200)
    given = np.random.default_rng(0).integers(0, 1000, (200, 9))
    sums = graph.evaluate(given)
    for q, at in zip(queries, graph.queries):
        assert at == -1 if not q else (sums[at] == given[q].sum(0)).all()
    assert graph.additions() < 0.8 * sum(len(q) - 1 for q in queries if q)
    for first, children, _ in graph.levels:
        assert (children < first).all()
