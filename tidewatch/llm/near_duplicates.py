"""Near-duplicates by circulant MinHash, banding and exact Jaccard verification.

A text becomes the set of its distinct shingles of five words (lower-cased A-Z, white space between words); fewer words
are one shingle. Two permutations give the whole signature: the first spreads the set over the universe of 32 bits, the
second, shifted circularly by k, gives coordinate k as its smallest value. Bands of coordinates that agree propose
pairs; a pair is linked if the full sets share at least 75 % of their union.

Equal sets are one class from the start, so copies never meet each other. Within a bucket every class is compared with
the smallest one first. Where that leaves classes of a bucket in different components, all classes of such buckets that
hang together are compared block by block through an index of their shingles. No class of a bucket is left out, and no
pair becomes a row unless it is one with the bucket's smallest class or a link that connects something.

With 32 bands of 4 coordinates a pair at the threshold is proposed with a probability of 1 - 5e-6, a pair at 0.9 with
1 - 1e-15. Shingles are compared as 64-bit hashes.

* NULL, empty and blank texts have an empty set and are linked with nothing.
* Repeated rows and repeated ids: the component of an id-less (NULL) row is the smallest id of its class, if any.
* An empty table gives an empty table. Further columns of the input are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewatch.llm import worker_tools
from tidewatch.llm.components import connected_components
from tidewatch.sources.staging import stage

SHINGLE = 5
BANDS = 32
ROWS = 4
#: Sets and shingles of a block of a group, about.
BLOCK_SETS, BLOCK_SHINGLES = 512, 400_000
#: Share of the union, in percent, that links two sets.
PERCENT = 75

_PRIME = np.uint64(0x9E3779B185EBCA87)


def _spread(x: np.ndarray) -> np.ndarray:
    """A bijection of 32-bit integers that scatters neighbours (multiply and shift, twice)."""
    x = x ^ (x >> np.uint32(16))
    x = x * np.uint32(0x21F0AAAD)
    x ^= x >> np.uint32(15)
    x *= np.uint32(0x735A2D97)
    x ^= x >> np.uint32(15)
    return x


def shingles(text: bytes, size: int = SHINGLE) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the shingles of a text in UTF-8."""
    tokens = text.lower().split()
    if not tokens:
        return np.empty(0, np.uint64)
    hashed = np.fromiter(map(xxhash.xxh3_64_intdigest, tokens), np.uint64, len(tokens))
    width = min(size, len(tokens))
    n = len(tokens) - width + 1
    mixed = np.full(n, width, np.uint64)
    for k in range(width):
        mixed = mixed * _PRIME + hashed[k : k + n]
        mixed ^= mixed >> np.uint64(29)
    return np.unique(mixed)


def band_keys(hashes: np.ndarray, bands: int = BANDS, rows: int = ROWS) -> np.ndarray:
    """One 64-bit key for each band of the circulant signature of a set that is not empty."""
    first = _spread((hashes ^ (hashes >> np.uint64(32))).astype(np.uint32) ^ np.uint32(0x5BD1E995))
    shifts = np.arange(1, bands * rows + 1, dtype=np.uint32)
    signature = np.full(bands * rows, 0xFFFFFFFF, np.uint32)
    for part in np.array_split(first, max(1, len(first) // 2048)):
        # Adding modulo 2**32 is the circular shift of the second permutation.
        shifted = _spread(part[None, :] + shifts[:, None])
        np.minimum(signature, shifted.min(axis=1), out=signature)
    keys = np.arange(1, bands + 1, dtype=np.uint64)
    for column in signature.reshape(bands, rows).T:
        keys = (keys ^ column.astype(np.uint64)) * _PRIME
        keys ^= keys >> np.uint64(31)
    return keys


def _digest(hashes: np.ndarray) -> int:
    """A number for the set, the same for equal sets."""
    return int(np.frombuffer(xxhash.xxh3_64_digest(hashes.tobytes()), np.int64)[0])


def _signed(texts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    worker_tools.release()
    for batch in texts:
        kept = {"n": [], "class": [], "bands": []}
        for text in batch.column(2).cast(pa.binary()).to_pylist():
            found = shingles(text or b"")
            kept["n"].append(len(found))
            kept["class"].append(_digest(found) if len(found) else None)
            kept["bands"].append(band_keys(found).view(np.int64) if len(found) else None)
        yield pa.RecordBatch.from_arrays(
            [
                batch.column(0),
                batch.column(1),
                pa.array(kept["n"], pa.int64()),
                pa.array(kept["class"], pa.int64()),
                pa.array(kept["bands"], pa.list_(pa.int64())),
            ],
            names=["id", "mark", "n", "class", "bands"],
        )


def _sets(texts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    worker_tools.release()
    for batch in texts:
        found = [shingles(text or b"") for text in batch.column(0).cast(pa.binary()).to_pylist()]
        yield pa.RecordBatch.from_arrays(
            [
                pa.array([_digest(f) if len(f) else None for f in found], pa.int64()),
                pa.array([f.view(np.int64) for f in found], pa.list_(pa.int64())),
            ],
            names=["class", "shingles"],
        )


def _similar(a: Column, b: Column, percent: int) -> Column:
    """Sizes alone do not rule out the similarity."""
    return 100 * F.least(a, b) >= percent * F.greatest(a, b)


def _verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose sets are similar."""
    left = sets.select(F.col("class").alias("a"), F.col("shingles").alias("x"))
    right = sets.select(F.col("class").alias("b"), F.col("shingles").alias("y"))
    both = F.size(F.array_intersect("x", "y"))
    union = F.size("x") + F.size("y") - both
    return pairs.join(left, "a").join(right, "b").where(100 * both >= percent * union).select("a", "b")


def _links_in_groups(groups: DataFrame, sizes: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Links (a, b) that connect what is similar inside each group of classes; pairs never become rows.

    A group is cut into blocks of bounded content, and each pair of its blocks is a group of rows by itself, compared
    through an index of its shingles. A forest of links is returned for it, no more than it has classes.
    """
    blocks = (
        groups.join(sizes, "node")
        .groupBy("component")
        .agg(F.greatest(F.ceil(F.count("*") / BLOCK_SETS), F.ceil(F.sum("n") / BLOCK_SHINGLES)).cast("int").alias("blocks"))
    )
    block = F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int")
    dealt = (
        groups.join(blocks, "component")
        .withColumn("block", block)
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        .select(
            "component", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"), F.col("node").alias("class")
        )
    )

    def linked(table: pa.Table) -> pa.Table:
        worker_tools.release()
        a, b = _forest(table.column("class").to_numpy(), table.column("shingles").combine_chunks(), percent)
        return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})

    return dealt.join(sets, "class").groupBy("component", "i", "j").applyInArrow(linked, "a bigint, b bigint")


def _forest(names: np.ndarray, shingle_lists: pa.ListArray, percent: int) -> tuple[list[int], list[int]]:
    """Links between similar sets that connect the same sets as all such links do."""
    sizes = np.diff(shingle_lists.offsets.to_numpy())
    _, numbered = np.unique(shingle_lists.flatten().to_numpy(), return_inverse=True)
    ends = np.concatenate([[0], np.cumsum(sizes)])
    # Sets by shingle: who holds the shingle number s stands from begin[s] to begin[s + 1].
    holders = np.repeat(np.arange(len(names)), sizes)[np.argsort(numbered, kind="stable")]
    begin = np.concatenate([[0], np.cumsum(np.bincount(numbered))])
    parent = list(range(len(names)))

    def root(x: int) -> int:
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    a, b = [], []
    for k in range(len(names)):
        own = numbered[ends[k] : ends[k + 1]]
        own = own[begin[own + 1] - begin[own] > 1]
        if 100 * len(own) < percent * sizes[k]:
            continue  # too much of it is in no other set
        shared = np.bincount(np.concatenate([holders[begin[s] : begin[s + 1]] for s in own]), minlength=len(names))
        similar = 100 * shared >= percent * (sizes[k] + sizes - shared)
        for other in np.flatnonzero(similar[:k]).tolist():
            x, y = root(k), root(other)
            if x != y:
                parent[x] = y
                a.append(int(names[k]))
                b.append(int(names[other]))
    return a, b


def with_components(docs: DataFrame, *, key: str = "doc_id", text: str = "text", percent: int = PERCENT) -> DataFrame:
    """(key, n_shingles, class, component): for every row the size of its set, the number of its class (equal sets) and
    the smallest key that is reachable over links, itself included."""
    rows = docs.select(F.col(key).alias("id"), F.xxhash64(text).alias("mark"), F.col(text).alias("text"))
    id_type = rows.schema["id"].dataType.simpleString()
    signed = stage(
        rows.mapInArrow(_signed, f"id {id_type}, mark bigint, n bigint, class bigint, bands array<bigint>"),
        "minhash-signatures",
    )
    classes = (
        signed.where("class IS NOT NULL")
        .groupBy("class")
        .agg(
            F.min("id").alias("id"),
            F.min(F.struct("id", "mark")).alias("holder"),
            F.first("n").alias("n"),
            F.first("bands").alias("bands"),
        )
    )
    in_bands = classes.select("class", "n", F.posexplode("bands").alias("band", "bucket")).select(
        F.xxhash64("band", "bucket").alias("bucket"), F.struct("class", "n").alias("member")
    )
    buckets = in_bands.groupBy("bucket").agg(F.min("member").alias("center"), F.count("*").alias("size")).where("size > 1")
    members = stage(
        in_bands.join(buckets, "bucket").select("bucket", "member", "center"), "minhash-buckets"
    )
    # The sets of all classes that share a bucket with another one.
    wanted = members.select(F.col("member.class").alias("class")).distinct()
    holders = classes.select("class", "holder").join(wanted, "class", "left_semi").select("holder").distinct()
    held = rows["id"].eqNullSafe(holders["holder.id"]) & (rows["mark"] == holders["holder.mark"])
    sets = stage(
        rows.join(holders, held, "left_semi")
        .select("text")
        .mapInArrow(_sets, "class bigint, shingles array<bigint>")
        .where("class IS NOT NULL")
        .dropDuplicates(["class"]),
        "minhash-sets",
    )
    stars = (
        members.where(F.col("member.class") != F.col("center.class"))
        .where(_similar(F.col("member.n"), F.col("center.n"), percent))
        .select(F.col("center.class").alias("a"), F.col("member.class").alias("b"))
        .distinct()
    )
    links = stage(_verified(stars, sets, percent), "minhash-links")
    first = connected_components(links)
    # Buckets whose classes are still apart: all their classes, put together by the buckets they share.
    placed = (
        members.select("bucket", "member", "center", F.col("member.class").alias("node"))
        .join(first, "node", "left")
        .select("bucket", "node", "member.n", "center.class", F.coalesce("component", "node").alias("component"))
    )
    apart = (
        placed.groupBy("bucket")
        .agg(F.min("component").alias("x"), F.max("component").alias("y"))
        .where("x < y")
        .select("bucket")
    )
    open_ = stage(placed.join(apart, "bucket", "left_semi").select("node", "class", "n").distinct(), "minhash-open")
    groups = connected_components(open_.select(F.col("node").alias("a"), F.col("class").alias("b")))
    more = stage(_links_in_groups(groups, open_.select("node", "n").distinct(), sets, percent), "minhash-links")
    # The first components are stars already, so only what connects them has to be worked out.
    known = first.select(F.col("node").alias("a"), F.col("component").alias("b"))
    components = connected_components(known.union(more)) if not more.isEmpty() else first
    by_class = (
        classes.select("class", "id")
        .join(components, F.col("class") == F.col("node"), "left")
        .select("class", "id", F.coalesce("component", "class").alias("component"))
    )
    smallest = by_class.groupBy("component").agg(F.min("id").alias("smallest"))
    labels = by_class.join(smallest, "component").select("class", "smallest")
    return (
        signed.select("id", "n", "class")
        .join(labels, "class", "left")
        .select(
            F.col("id").alias(key),
            F.col("n").alias("n_shingles"),
            "class",
            F.coalesce("smallest", "id").alias("component"),
        )
    )


def keep_one_of_each(docs: DataFrame, *, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The documents whose key is the smallest of their component, with their columns as they were. Repeated rows of
    one key stay together; rows without a key stay."""
    labels = with_components(docs, key=key, text=text)
    dropped = labels.where(F.col("component") != F.col(key)).select(key).distinct()
    return docs.join(dropped, key, "left_anti").select(*[F.col(f"`{c}`") for c in docs.columns])
