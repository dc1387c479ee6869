"""Benchmark decontamination: find benchmark n-grams in training documents and remove spans or documents.

Documents and items are lower-cased (A-Z) and cut into words of letters, digits and characters beyond ASCII. A window
is ``n`` consecutive words of an item; an item of fewer words, but not none, is one window. A document word inside any
occurrence of a window is hit.

The windows are a hash table that every task gets as a constant of the plan: an array of buckets, addressed by hash, of
windows with their items. Its size is checked against ``max_windows``; a larger benchmark is joined with the windows of
candidate documents by a shuffle instead, with equal results.

Most documents hold no window. Every window of n words covers a gram of ``a`` words that starts at a multiple of
``n - a + 1``, so it is enough to look up those grams first and to compare all windows only where one is found. Nothing
is missed by that, and all hits are compared as text.

* NULL or empty texts have no words: not hit, never contaminated. Items without words have no window.
* Repeated documents are judged one by one, repeated windows list all their items.
* No items: nothing is hit. An empty table gives an empty table. Further columns stay as they are.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewatch.llm.text import covered, every, lower_ascii, n_words, spaced, whole, windows
from tidewatch.sources.staging import stage

WINDOW = 13
#: Largest number of distinct windows that is sent to every task (some 200 bytes each).
MAX_WINDOWS = 50_000
HITS = "array<struct<start:int,end:int,items:array<string>>>"


def item_windows(benchmark: DataFrame, n: int = WINDOW, item: str = "item_id", text: str = "text") -> DataFrame:
    """(length, window, items): the distinct windows and the sorted ids (as strings) of the items that hold them."""
    tokens = benchmark.select(
        F.col(item).cast("string").alias("item"), spaced(lower_ascii(whole(text))).alias("spaced")
    ).where("spaced <> ''")
    return (
        tokens.select("item", "spaced", F.least(n_words(F.col("spaced")), F.lit(n)).alias("length"))
        .select(
            "item",
            "length",
            F.explode(
                F.when(F.col("length") < n, F.array("spaced")).otherwise(windows(F.col("spaced"), n))
            ).alias("window"),
        )
        .groupBy("length", "window")
        .agg(F.array_sort(F.collect_set("item")).alias("items"))
    )


def table(rows: DataFrame, key: str, buckets: int) -> Column:
    """A constant: an array of ``buckets`` arrays of the rows, addressed by the hash of ``key``.

    Goes through the driver; the caller has checked the number of rows.
    """
    entry = F.struct(*rows.columns)
    filled = rows.groupBy(bucket(F.col(key), buckets).alias("bucket")).agg(F.collect_list(entry).alias("entries"))
    arrays = (
        rows.sparkSession.range(buckets)
        .select(F.col("id").alias("bucket"))
        .join(filled, "bucket", "left")
        .agg(F.array_sort(F.collect_list(F.struct("bucket", F.coalesce("entries", F.array()).alias("entries")))).alias("t"))
        .select(F.transform("t", lambda b: b["entries"]).alias("t"))
    )
    return F.from_json(F.lit(arrays.select(F.to_json("t")).first()[0]), arrays.schema["t"].dataType)


def bucket(key: Column, buckets: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(buckets).cast("long"))


def lookup(hash_table: Column, key: Column, name: str, buckets: int) -> Column:
    """The entries of the table whose field ``name`` equals the key."""
    entries = F.get(hash_table, bucket(key, buckets).cast("int"))
    return F.filter(entries, lambda e: e[name] == key)


def gram_shape(length: int) -> tuple[int, int]:
    """Words of an aligned gram and the step between grams, for windows of the given length."""
    size = min(5, (length + 1) // 2)
    return size, length - size + 1


def hits(spaced_text: Column, length: int, hash_table: Column, buckets: int) -> Column:
    """Every occurrence of a window of this length, by comparing all windows of the document."""
    found = F.transform(
        windows(spaced_text, length),
        lambda w, i: F.struct(
            i.alias("start"),
            (i + length).alias("end"),
            lookup(hash_table, w, "window", buckets).alias("entries"),
        ),
    )
    # A window of items without an id is an entry whose list of items is empty.
    return F.transform(
        F.filter(found, lambda f: F.size(f["entries"]) > 0),
        lambda f: F.struct(
            f["start"].alias("start"),
            f["end"].alias("end"),
            F.flatten(F.transform(f["entries"], lambda e: e["items"])).alias("items"),
        ),
    )


def window_grams(item_rows: DataFrame, length: int) -> DataFrame:
    """All grams of the windows of one length, at every offset."""
    size, _ = gram_shape(length)
    return item_rows.where(F.col("length") == length).select(F.explode(windows(F.col("window"), size)).alias("gram"))


def power_of_two(n: int) -> int:
    return 1 << max(4, n).bit_length()


def with_hits(
    docs: DataFrame,
    benchmark: DataFrame,
    n: int = WINDOW,
    *,
    max_windows: int = MAX_WINDOWS,
    item: str = "item_id",
    text: str = "text",
) -> DataFrame:
    """(row, spaced, hits): the document as a struct, its words, and its hits as (start, end, items) by start, where
    start and end count words from 0 and the end is exclusive."""
    base = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")).withColumn(
        "spaced", spaced(lower_ascii(whole(F.col("row").getField(text))))
    )
    rows = stage(item_windows(benchmark, n, item=item), "benchmark-windows")
    sizes = {r["length"]: r["n"] for r in rows.groupBy("length").agg(F.count("*").alias("n")).collect()}
    none = F.array().cast(HITS)
    if not sizes:
        return base.withColumn("hits", none)
    if sum(sizes.values()) > max_windows:
        return joined_hits(base, rows, sorted(sizes))
    buckets = power_of_two(sum(sizes.values()))
    window_table = table(rows.select("window", "items"), "window", buckets)
    parts = []
    for length in sorted(sizes):
        slots = power_of_two(sizes[length])
        gram_table = table(window_grams(rows, length).distinct(), "gram", slots)
        candidate = F.exists(
            every(F.col("spaced"), *gram_shape(length)),
            lambda g: F.size(lookup(gram_table, g, "gram", slots)) > 0,  # noqa: B023
        )
        found = hits(F.col("spaced"), length, window_table, buckets)
        parts.append(F.when(candidate, found).otherwise(none).cast(HITS))
    return base.withColumn("hits", F.sort_array(F.concat(*parts)) if len(parts) > 1 else parts[0])


def joined_hits(base: DataFrame, item_rows: DataFrame, lengths: list[int]) -> DataFrame:
    """The same hits for a benchmark too large to be sent to every task: windows of documents meet item windows in a
    shuffle on the window, and the hits come back to their documents by a row number.

    Aligned grams meet first, as 64-bit hashes, so only documents that hold a gram of an item hand over their windows.
    """
    rows = stage(base.withColumn("n", F.monotonically_increasing_id()), "decontaminate-rows")
    found = None
    for length in lengths:
        # Written, so that Spark may send a small side to the tasks or split a gram or window of very many rows.
        grams = stage(window_grams(item_rows, length).select(F.xxhash64("gram").alias("gram")).distinct(), "decontaminate-grams")
        held = rows.select("n", F.explode(every(F.col("spaced"), *gram_shape(length))).alias("gram"))
        candidates = stage(
            held.select("n", F.xxhash64("gram").alias("gram")).join(grams, "gram", "left_semi").select("n").distinct(),
            "decontaminate-candidates",
        )
        items = stage(item_rows.where(F.col("length") == length).drop("length"), "decontaminate-items")
        part = (
            rows.join(candidates, "n", "left_semi")
            .select("n", F.posexplode(windows(F.col("spaced"), length)))
            .withColumnsRenamed({"pos": "start", "col": "window"})
            .join(items, "window")
            .select("n", F.struct("start", (F.col("start") + length).alias("end"), "items").alias("hit"))
        )
        found = part if found is None else found.union(part)
    per_row = found.groupBy("n").agg(F.sort_array(F.collect_list("hit")).cast(HITS).alias("hits"))
    return rows.join(per_row, "n", "left").select(
        "row", "spaced", F.coalesce("hits", F.array().cast(HITS)).alias("hits")
    )


def contaminated(hit: Column, total: Column) -> Column:
    """At least one word and 5 % of the words are hit."""
    return (hit > 0) & (20 * hit >= total)


def n_hit() -> Column:
    """Number of hit words, from ``hits``."""
    return covered(F.col("hits"))


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, n: int = WINDOW, **how: object) -> DataFrame:
    """The documents that are not contaminated, with their columns as they were."""
    judged = with_hits(docs, benchmark, n, **how)
    return judged.where(~contaminated(n_hit(), n_words(F.col("spaced")))).select("row.*")


def remove_spans(docs: DataFrame, benchmark: DataFrame, n: int = WINDOW, *, text: str = "text", **how: object) -> DataFrame:
    """Documents with the hit words taken out of their text; texts without a hit stay as they are.

    What separates words is kept, except between two removed words.
    """
    judged = with_hits(docs, benchmark, n, text=text, **how)
    pattern = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
    gaps = F.split(whole(F.col("row").getField(text)), pattern, -1)
    found = F.regexp_extract_all(whole(F.col("row").getField(text)), F.lit(pattern), F.lit(0))
    hit = lambda i: F.exists("hits", lambda h: (h["start"] <= i) & (i < h["end"]))
    kept = F.transform(
        found,
        lambda w, i: F.when(hit(i), F.when(hit(i - 1), "").otherwise(F.get(gaps, i))).otherwise(
            F.concat(F.get(gaps, i), w)
        ),
    )
    cleaned = F.concat(F.array_join(kept, ""), F.element_at(gaps, -1))
    new = F.when(F.size("hits") > 0, cleaned).otherwise(F.col("row").getField(text))
    return judged.select(*[new.alias(c) if c == text else F.col("row").getField(c).alias(c) for c in docs.columns])
