"""Line dedup by a tree of line templates.

A line is parsed in a tree of fixed depth: by its number of tokens, then by its leading tokens, after tokens that hold a
digit became ``<*>``. Below that it has two templates, each with one variable field, in its middle or at its end; the field
covers a third of a line of at least ``LONG`` tokens and a quarter of a shorter one. Two lines that differ in digits and
inside one such field share a template. So a template is a key, and what recurs is found by counting keys: no line is
compared with another, and a line of millions of documents is counted where it is read first.

What digits and fields hide must not be what a line is about, as in rows of numbers. So a template counts only if more than
``LITERAL_SHARE`` percent of the line's tokens stand in it unmasked. A line without such a template has the masked line
itself, and a line whose masked form holds too few tokens has the line unmasked.

A template recurs if lines of at least ``min_docs`` documents have it (``min_docs_short`` for lines under ``LONG`` tokens).
Its line of the smallest key, in it the first one, stays; other lines are dropped unless they stay for another template.
With ``drop_share`` a document that loses at least that percentage of its words goes as a whole, but never one that holds
a line that stays for others; without it (the default) every document stays.

* NULL and empty texts have no lines and stay as they are; lines under ``SHORT`` tokens are never dropped.
* Equal rows of one key count as one document and keep or lose the same lines. NULL keys come first.
* Texts that lose nothing stay byte for byte, line breaks included. An empty table gives an empty table.
* A line that the document repeats is one row with many places, so the work grows with the lines, however long a text is.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewatch.llm import worker_tools
from tidewatch.llm.text import whole
from tidewatch.sources.staging import stage

SHORT, LONG = 4, 12
MIN_DOCS, MIN_DOCS_SHORT = 3, 10
MASK, LITERAL_SHARE = b"<*>", 50
DIGIT = re.compile(rb"[0-9]").search
#: Texts whose templates are handed on at once.
BATCH = 256
FOUND = "array<struct<template:binary,n:int,places:array<int>>>"


def templates(tokens: list[bytes]) -> list[bytes]:
    """The templates of a line: number of tokens, then the tokens that are not in the variable field."""
    n, head = len(tokens), b"%d " % len(tokens)
    if n >= LONG:
        begin, end = n // 3, 2 * n // 3
        parts = ((tokens[:end], []), (tokens[:begin], tokens[end:]))
    else:
        begin = (n - n // 4) // 2
        parts = ((tokens[: n - n // 4], []), (tokens[:begin], tokens[begin + n // 4 :]))
    out = [
        head + b" ".join([*before, MASK, *after])
        for before, after in parts
        if 100 * (len(before) + len(after) - before.count(MASK) - after.count(MASK)) > LITERAL_SHARE * n
    ]
    return out


def line_templates(line: bytes, tokens: list[bytes]) -> list[bytes]:
    """The templates of a line of at least ``SHORT`` tokens; separators are ASCII white space."""
    if not DIGIT(line):
        return templates(tokens)
    masked = [MASK if DIGIT(t) else t for t in tokens]
    if found := templates(masked):
        return found
    literal = len(masked) - masked.count(MASK)
    return [b"%d " % len(tokens) + b" ".join(masked if 100 * literal > LITERAL_SHARE * len(tokens) else tokens)]


def parsed(text: str) -> tuple[int, dict[bytes, tuple[int, list[int]]]]:
    """Words of a text, and its templates as digests with the number of tokens and the places of their lines, from 0."""
    words, found = 0, {}
    digest = xxhash.xxh3_128_digest
    for at, line in enumerate(text.encode().split(b"\n")):
        tokens = line.split()
        words += len(tokens)
        if len(tokens) >= SHORT:
            for t in line_templates(line, tokens):
                found.setdefault(digest(t), (len(tokens), []))[1].append(at)
    return words, found


def row_mark(key: str, text: str) -> Column:
    """The same for equal rows of key and text only."""
    return F.unhex(F.md5(F.concat_ws("\0", F.coalesce(F.col(key).cast("string"), F.lit("")), whole(text))))


def with_templates(docs: DataFrame, *, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(mark, key, words, found): the templates of every row that has any."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        worker_tools.release()
        for whole_batch in batches:
            for begin in range(0, whole_batch.num_rows, BATCH):
                batch = whole_batch.slice(begin, BATCH)
                words, sizes, digests, ns, numbers, places = [], [0], [], [], [0], []
                for t in batch.column(2).to_pylist():
                    n, found = parsed(t)
                    words.append(n)
                    sizes.append(sizes[-1] + len(found))
                    digests += found
                    for n_tokens, at in found.values():
                        ns.append(n_tokens)
                        places += at
                        numbers.append(len(places))
                at = pa.ListArray.from_arrays(pa.array(numbers, pa.int32()), pa.array(np.array(places, np.int32)))
                each = pa.StructArray.from_arrays(
                    [pa.array(digests, pa.binary()), pa.array(ns, pa.int32()), at], names=["template", "n", "places"]
                )
                lists = pa.ListArray.from_arrays(pa.array(sizes, pa.int32()), each)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), batch.column(1), pa.array(words, pa.int64()), lists],
                    names=["mark", "key", "words", "found"],
                )

    rows = docs.select(row_mark(key, text).alias("mark"), F.col(key).alias("key"), whole(text).alias("text"))
    kind = rows.schema["key"].dataType.simpleString()
    return rows.mapInArrow(run, f"mark binary, key {kind}, words bigint, found {FOUND}").where(F.size("found") > 0)


def dropped_lines(
    docs: DataFrame,
    *,
    key: str = "doc_id",
    text: str = "text",
    min_docs: int = MIN_DOCS,
    min_docs_short: int = MIN_DOCS_SHORT,
) -> DataFrame:
    """(mark, dropped, words, lost, holds): for rows with recurring templates, the places of the lines that they lose, all
    their words and the lost ones, and whether a line of theirs stays for others."""
    parsed_rows = stage(with_templates(docs, key=key, text=text), "line-templates")
    each = parsed_rows.select("mark", "key", "words", F.inline("found"))
    # Equal rows count once. What is left by row is counted by template where it lies before it is dealt out again.
    by_document = each.groupBy("template", "mark").agg(
        F.first("key").alias("key"), F.min(F.element_at("places", 1)).alias("at"), F.min("n").alias("n")
    )
    # Written, so that Spark may send a small table to the tasks or split a template of very many rows.
    recurring = stage(
        by_document.groupBy("template")
        .agg(F.count("*").alias("docs"), F.min(F.struct("key", "mark", "at")).alias("first"), F.min("n").alias("n"))
        .where(F.col("docs") >= F.when(F.col("n") >= LONG, min_docs).otherwise(min_docs_short))
        .select("template", "first"),
        "recurring-templates",
    )
    # A line as one number, its tokens above its place: sets of numbers are hashed, sets of structs are not.
    line = lambda at: F.shiftleft(F.col("n").cast("bigint"), 32) + at
    stays = F.col("first.mark") == F.col("mark")
    by_row = (
        each.join(recurring, "template")
        .groupBy("mark")
        .agg(
            F.max("words").alias("words"),
            F.array_distinct(F.flatten(F.collect_list(F.transform("places", line)))).alias("lines"),
            F.collect_set(F.when(stays, line(F.col("first.at")))).alias("staying"),
        )
    )
    lost = by_row.withColumn("gone", F.array_except("lines", "staying"))
    return lost.select(
        "mark",
        F.transform("gone", lambda g: g.bitwiseAND(0xFFFFFFFF).cast("int")).alias("dropped"),
        "words",
        F.aggregate("gone", F.lit(0).cast("bigint"), lambda total, g: total + F.shiftright(g, 32)).alias("lost"),
        (F.size("staying") > 0).alias("holds"),
    )


def without_lines(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
    """Texts without the lines of the given numbers; NULL where there are none."""
    worker_tools.release()
    for texts, dropped in batches:
        out = []
        for t, gone in zip(texts.to_pylist(), dropped.to_pylist()):
            some = set(gone or ())
            out.append("\n".join([x for at, x in enumerate(t.split("\n")) if at not in some]) if some else None)
        yield pa.array(out, pa.string())


def drop_recurring_lines(
    docs: DataFrame, *, key: str = "doc_id", text: str = "text", drop_share: int | None = None, **how: int
) -> DataFrame:
    """Documents without the lines of recurring templates, with their other columns as they were."""
    dropped = dropped_lines(docs, key=key, text=text, **how).where(F.size("dropped") > 0)
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), row_mark(key, text).alias("mark"))
    joined = rows.join(dropped, "mark", "left")
    if drop_share is not None:
        falls = (100 * F.col("lost") >= drop_share * F.col("words")) & ~F.col("holds")
        joined = joined.where(~F.coalesce(falls, F.lit(False)))
    old = F.col("row").getField(text)
    # Only texts that lose lines go to Python.
    new = F.arrow_udf(without_lines, "string")(F.when(F.col("dropped").isNotNull(), old), F.col("dropped"))
    kept = joined.withColumn("new", F.coalesce(new, old))
    return kept.select(*[(F.col("new") if c == text else F.col("row").getField(c)).alias(c) for c in docs.columns])
