"""Ranked lexical search of many queries at once, by evaluating what they share only once.

**Sharing.** Queries become sets of terms. Terms that stand in exactly the same queries form one node; then queries are
written as sequences of nodes, most shared first, and neighbours that stand together in more than one query become a node
of their own, round by round, until nothing is shared. The nodes form an acyclic graph: a node is the sum of nodes below
it, and a query is the sum of the few nodes that are left in its sequence; equal queries are one.

**Evaluation.** One pass over the texts writes, for each document, its number of terms and the numbers of the queries'
terms in it, with counts for the corpus. A second pass over the written table gives, for some documents at a time, every
term its share of the score, fills the nodes level by level (the partial accumulators, each made once for all queries
that share it) and adds up the queries. Every task keeps the best ``top`` documents of each query.

Queries are worked off in blocks of bounded size, each with its own graph, so what a task and the driver hold of them is
bounded however many there are; the texts are read once for each block.

* NULL and empty texts, and texts without terms, hold nothing and do not count as documents. Queries without terms find
  nothing.
* Equal scores come by ascending key; NULL keys last. Equal rows are ranked one by one, and so are repeated queries.
* Keys of documents must be integers. An empty table of documents or queries gives an empty result.
* Texts are read whole, whatever their length. Other columns are not read.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field
from functools import reduce
from itertools import repeat
from string import ascii_letters, digits

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidewatch.sources.staging import stage

TOP = 50
#: Terms of the queries of a block; a single query may have more.
BLOCK_TERMS = 200_000
#: Accumulators (documents times nodes) that a task fills at once.
CELLS = 4_000_000
#: Parts in which the best documents of a query are first ranked.
SALTS = 64

#: Bytes that separate terms become spaces, A-Z become a-z; bytes of other scripts stay.
TERM_BYTES = bytes(b if b > 0x7F or chr(b) in ascii_letters + digits else 0x20 for b in range(256)).lower()


def terms_of(text: str | None) -> list[bytes]:
    return (text or "").encode().translate(TERM_BYTES).split()


def weight(n_documents: int, holding: int) -> int:
    return math.floor(1000 * math.log((2 * n_documents + 2) / (2 * holding + 1)))


@dataclass
class Graph:
    """Nodes 0 .. n_terms - 1 are terms; ``levels`` make the others from nodes of earlier levels: (first node, children,
    starts of each node's children). ``roots`` are the nodes of each different query, ``queries`` says which one a query
    is (-1: it has no terms)."""

    n_terms: int
    levels: list[tuple[int, np.ndarray, np.ndarray]] = field(default_factory=list)
    n_nodes: int = 0
    roots: list[tuple[int, ...]] = field(default_factory=list)
    queries: list[int] = field(default_factory=list)

    def additions(self) -> int:
        """Additions for one document, with what is shared made once."""
        made = sum(len(children) - len(starts) for _, children, starts in self.levels)
        return made + sum(len(r) - 1 for r in self.roots)

    def evaluate(self, of_terms: np.ndarray) -> np.ndarray:
        """Sums of the different queries (queries, documents) from what the terms give (terms, documents)."""
        cells = np.empty((self.n_nodes, of_terms.shape[1]), np.int64)
        cells[: self.n_terms] = of_terms
        for first, children, starts in self.levels:
            cells[first : first + len(starts)] = np.add.reduceat(cells[children], starts, axis=0)
        flat = np.fromiter((n for r in self.roots for n in r), np.int64)
        starts = np.cumsum([0, *(len(r) for r in self.roots[:-1])])
        return np.add.reduceat(cells[flat], starts, axis=0)


def mine(queries: list[list[int]], n_terms: int) -> Graph:
    """The graph of queries, which are lists of different terms."""
    graph = Graph(n_terms, n_nodes=n_terms)
    distinct = {tuple(q): k for k, q in enumerate(dict.fromkeys(tuple(sorted(q)) for q in queries if q))}
    graph.queries = [distinct.get(tuple(sorted(q)), -1) for q in queries]
    holders: dict[int, list[int]] = {}
    for terms, k in distinct.items():
        for t in terms:
            holders.setdefault(t, []).append(k)
    level = {t: 0 for t in range(n_terms)}
    made: dict[int, tuple[int, ...]] = {}

    def node(children: tuple[int, ...]) -> int:
        number = n_terms + len(made)
        made[number] = children
        level[number] = 1 + max(level[c] for c in children)
        return number

    # Terms of the same queries.
    together: dict[tuple[int, ...], list[int]] = {}
    for t, ks in holders.items():
        together.setdefault(tuple(ks), []).append(t)
    sequences: list[list[int]] = [[] for _ in distinct]
    for ks, terms in sorted(together.items(), key=lambda p: (-len(p[0]), p[1])):
        # A set that only one query holds is no shared work.
        some = [node(tuple(terms))] if len(terms) > 1 and len(ks) > 1 else terms
        for k in ks:
            sequences[k].extend(some)
    # Neighbours that stand together more than once.
    while True:
        pairs = Counter(p for s in sequences for p in set(zip(s, s[1:])))
        shared = {p: n for p, n in pairs.items() if n > 1}
        if not shared:
            break
        best: dict[int, tuple[int, int, int]] = {}
        for (x, y), n in shared.items():
            for end in (x, y):
                best[end] = max(best.get(end, (0, 0, 0)), (n, -x, -y))
        # Pairs that are the best one of both their ends; there always is one.
        chosen = {(x, y): node((x, y)) for (x, y), n in sorted(shared.items()) if best[x] == best[y] == (n, -x, -y)}
        for k, s in enumerate(sequences):
            out, at = [], 0
            while at < len(s):
                joined = chosen.get((s[at], s[at + 1])) if at + 1 < len(s) else None
                out.append(s[at] if joined is None else joined)
                at += 1 if joined is None else 2
            sequences[k] = out
    # Number the nodes level by level.
    order = sorted(made, key=lambda n: (level[n], n))
    number = {old: n_terms + k for k, old in enumerate(order)} | {t: t for t in range(n_terms)}
    for depth in sorted({level[n] for n in order}):
        some = [n for n in order if level[n] == depth]
        sizes = [len(made[n]) for n in some]
        children = np.array([number[c] for n in some for c in made[n]], np.int64)
        graph.levels.append((number[some[0]], children, np.cumsum([0, *sizes[:-1]])))
    graph.n_nodes = n_terms + len(made)
    graph.roots = [tuple(number[n] for n in s) for s in sequences]
    return graph


def blocks(queries: DataFrame, key: str, text: str, most: int = BLOCK_TERMS) -> Iterator[list[tuple[object, list[bytes]]]]:
    """(key, different terms) of the queries, block by block; they come to the driver a partition at a time."""
    rows = queries.select(F.col(key).alias("key"), F.col(text).alias("text"))
    some, held = [], 0
    for row in rows.toLocalIterator():
        terms = sorted(set(terms_of(row["text"])))
        if some and held + len(terms) > most:
            yield some
            some, held = [], 0
        if terms:
            some.append((row["key"], terms))
            held += len(terms)
    if some:
        yield some


def counted_terms(docs: DataFrame, vocabulary: list[bytes], *, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The written table of the first pass. Rows of documents that have terms: (key, n, terms, counts), where ``n`` is the
    number of all their terms and the arrays hold those of the vocabulary. One row for each task: (documents, length,
    holding), its sums for the corpus and for each term of the vocabulary."""
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(vocabulary)
    rows = docs.select(F.col(key).cast("bigint").alias("key"), F.col(text).alias("text"))
    schema = "key bigint, n bigint, terms array<int>, counts array<int>, documents bigint, length bigint, holding array<bigint>"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        size = len(shared.value)
        number = {t: k for k, t in enumerate(shared.value)}.get
        documents = length = 0
        holding = np.zeros(size, np.int64)
        lists, wide = pa.list_(pa.int32()), pa.list_(pa.int64())
        for batch in batches:
            keys, ns, ends, found = [], [], [0], []
            for k, t in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                terms = terms_of(t)
                if not terms:
                    continue
                ids = np.fromiter(map(number, terms, repeat(-1)), np.int64, len(terms))
                ids, tf = np.unique(ids[ids >= 0], return_counts=True)
                holding[ids] += 1
                length += len(terms)
                keys.append(k)
                ns.append(len(terms))
                ends.append(ends[-1] + len(ids))
                found.append((ids, tf))
            documents += len(keys)
            if keys:
                offsets = pa.array(ends, pa.int32())
                ids, tf = (pa.array(np.concatenate(c), pa.int32()) for c in zip(*found))
                nulls = [pa.nulls(len(keys), t) for t in (pa.int64(), pa.int64(), wide)]
                arrays = [pa.array(keys, pa.int64()), pa.array(ns, pa.int64())]
                arrays += [pa.ListArray.from_arrays(offsets, ids), pa.ListArray.from_arrays(offsets, tf), *nulls]
                yield pa.RecordBatch.from_arrays(arrays, names=NAMES)
        if documents:
            nulls = [pa.nulls(1, t) for t in (pa.int64(), pa.int64(), lists, lists)]
            sums = [pa.array([documents]), pa.array([length]), pa.array([holding], wide)]
            yield pa.RecordBatch.from_arrays([*nulls, *sums], names=NAMES)

    return stage(rows.mapInArrow(run, schema), "counted-terms")


NAMES = ["key", "n", "terms", "counts", "documents", "length", "holding"]


def corpus_counts(counted: DataFrame, size: int) -> tuple[int, int, np.ndarray]:
    """Documents, terms of all documents, and how many documents hold each term."""
    sums = counted.where("documents IS NOT NULL")
    n, length = sums.agg(F.coalesce(F.sum("documents"), F.lit(0)), F.coalesce(F.sum("length"), F.lit(0))).first()
    holding = np.zeros(size, np.int64)
    for term, k in sums.select(F.posexplode("holding")).groupBy("pos").agg(F.sum("col")).collect():
        holding[term] = k
    return n, length, holding


class Best:
    """The best documents of each query, from scores of some documents at a time."""

    def __init__(self, n_queries: int, top: int):
        self.top = top
        self.least = np.zeros(n_queries, np.int64)
        self.last = np.full(n_queries, np.iinfo(np.int64).max)
        self.held: list[np.ndarray] = []
        self.n_held = 0

    def add(self, scores: np.ndarray, keys: np.ndarray, missing: np.ndarray) -> None:
        """Scores (queries, documents); documents that can't be among the best any more are left out."""
        order = np.where(missing, np.iinfo(np.int64).max, keys)
        least = self.least[:, None]
        query, doc = np.nonzero((scores > least) | ((scores == least) & (scores > 0) & (order <= self.last[:, None])))
        self.held.append(np.stack([query, scores[query, doc], keys[doc], missing[doc]]))
        self.n_held += len(query)
        if self.n_held > 4 * self.top * len(self.least) + 10_000:
            self.rows()

    def rows(self) -> np.ndarray:
        """(query, score, key, whether the key is NULL) of the best."""
        if not self.held:
            return np.empty((4, 0), np.int64)
        query, score, key, missing = np.concatenate(self.held, axis=1)
        order = np.lexsort((key, missing, -score, query))
        query, score, key, missing = (c[order] for c in (query, score, key, missing))
        first = np.searchsorted(query, query)
        keep = np.arange(len(query)) - first < self.top
        full = np.flatnonzero(np.arange(len(query)) - first == self.top - 1)
        self.least[query[full]] = score[full]
        self.last[query[full]] = np.where(missing[full] == 1, np.iinfo(np.int64).max, key[full])
        best = np.stack([query, score, key, missing])[:, keep]
        self.held, self.n_held = [best], best.shape[1]
        return best


def shares(tf: np.ndarray, n: np.ndarray, weights: np.ndarray, n_documents: int, length: int) -> np.ndarray:
    """What a term gives a document: its weight times how often it stands there, against the document's length."""
    m = 100 - 50 + (50 * n * n_documents) // length
    return weights * ((1_000_000_000 * tf) // (1000 * tf + 20 * m))


def best_documents(counted: DataFrame, graph: Graph, *, top: int = TOP) -> DataFrame:
    """(query, key, score): the best documents of each different query of the graph, of every task."""
    n_documents, length, holding = corpus_counts(counted, graph.n_terms)
    weights = np.array([weight(n_documents, int(df)) for df in holding], np.int64)
    shared = counted.sparkSession.sparkContext.broadcast((graph, weights))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        graph, weights = shared.value
        best = Best(len(graph.roots), top)
        step = max(1, CELLS // graph.n_nodes)
        for batch in batches:
            for at in range(0, batch.num_rows, step):
                some = batch.slice(at, step)
                offsets = some.column(2).offsets.to_numpy()
                terms, tf = (some.column(c).flatten().to_numpy(zero_copy_only=False).astype(np.int64) for c in (2, 3))
                doc = np.repeat(np.arange(some.num_rows), np.diff(offsets))
                n = some.column(1).to_numpy()[doc]
                given = np.zeros((graph.n_terms, some.num_rows), np.int64)
                given[terms, doc] = shares(tf, n, weights[terms], n_documents, length)
                keys = some.column(0)
                missing = keys.is_null().to_numpy(zero_copy_only=False)
                best.add(graph.evaluate(given), keys.fill_null(0).to_numpy(), missing)
        query, score, key, missing = best.rows()
        keys = pa.array(key, pa.int64(), mask=missing.astype(bool))
        yield pa.RecordBatch.from_arrays([pa.array(query), keys, pa.array(score)], names=["query", "key", "score"])

    rows = counted.where("n IS NOT NULL").select("key", "n", "terms", "counts")
    found = rows.mapInArrow(run, "query bigint, key bigint, score bigint")
    # A query's rows, some for each task, are first ranked in parts, so that no task sees them all.
    parted = found.withColumn("part", F.spark_partition_id() % SALTS)
    order = [F.desc("score"), F.asc_nulls_last("key")]
    in_part = Window.partitionBy("query", "part").orderBy(*order)
    return parted.withColumn("at", F.row_number().over(in_part)).where(F.col("at") <= top).select("query", "key", "score")


def search(
    docs: DataFrame,
    queries: DataFrame,
    *,
    key: str = "doc_id",
    text: str = "text",
    query_key: str = "item_id",
    query_text: str = "text",
    top: int = TOP,
    block_terms: int = BLOCK_TERMS,
) -> DataFrame:
    """(query_key, rank, key, score): the ``top`` documents of highest score of each query, from rank 1."""
    spark = docs.sparkSession
    kind = queries.schema[query_key].dataType.simpleString()
    found = []
    for block in blocks(queries, query_key, query_text, block_terms):
        vocabulary = sorted({t for _, terms in block for t in terms})
        number = {t: k for k, t in enumerate(vocabulary)}
        graph = mine([[number[t] for t in terms] for _, terms in block], len(vocabulary))
        names = spark.createDataFrame(
            [(at, k, query) for at, ((k, _), query) in enumerate(zip(block, graph.queries))],
            f"at bigint, query_key {kind}, query bigint",
        )
        best = best_documents(counted_terms(docs, vocabulary, key=key, text=text), graph, top=top)
        of_query = Window.partitionBy("query").orderBy(F.desc("score"), F.asc_nulls_last("key"))
        ranked = best.withColumn("rank", F.row_number().over(of_query)).where(F.col("rank") <= top)
        # Repeated queries share their rows; a block's queries are few.
        found.append(names.join(ranked, "query").select("query_key", "rank", "key", "score"))
    if not found:
        found = [spark.createDataFrame([], f"query_key {kind}, rank int, key bigint, score bigint")]
    return _union(found).select(F.col("query_key").alias(query_key), "rank", F.col("key").alias(key), "score")


def _union(tables: Iterable[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, tables)
