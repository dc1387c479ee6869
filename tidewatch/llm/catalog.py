"""The registered queries of the operators: digests of their results over whole tables, and the SQL that states them."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewatch.llm import alignment, bpe, factorisation, lexical_search, licenses, line_templates, near_duplicates, pii
from tidewatch.llm import secrets, token_files, url_filter
from tidewatch.llm import decontaminate as decon
from tidewatch.llm import quality_cascade as quality
from tidewatch.llm.sql import SQL  # noqa: F401
from tidewatch.llm.text import n_words
from tidewatch.sources.staging import staging_path


def read(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def sha256(text: Column) -> Column:
    return F.sha2(text, 256)


def op1_licenses(spark: SparkSession, folder: str) -> DataFrame:
    scanned = licenses.scan(read(spark, folder, "documents").select("doc_id", "text"))
    none = F.lit(None).cast("struct<n:int,first:int,last:int>")
    possible = F.contains("words", F.lit("license"))
    base = scanned.withColumns(
        {
            label: F.when(possible, licenses.phrase_places(F.col("words"), phrase)).otherwise(none)
            for label, phrase in licenses.PHRASES
        }
    )
    found = [F.col(label) for label, _ in licenses.PHRASES]
    held = F.array_compact(F.array(*[F.when(c.isNotNull(), F.lit(k)) for (k, _), c in zip(licenses.PHRASES, found)]))
    more = F.transform("detections", lambda d: d["label"])
    return base.select(
        F.col("row.doc_id").alias("doc_id"),
        F.col("n_words").cast("long").alias("n_words"),
        sum(F.coalesce(c["n"], F.lit(0)) for c in found).cast("long").alias("n_base"),
        F.least(*[c["first"] for c in found]).cast("long").alias("first_word"),
        F.greatest(*[c["last"] for c in found]).cast("long").alias("last_word"),
        F.array_join(F.sort_array(held), ",").alias("base_labels"),
        F.array_join(F.sort_array(F.array_union(held, more)), ",").alias("labels"),
        F.coalesce(F.array_max(F.transform("detections", lambda d: d["confidence"])), F.lit(0.0)).alias("score"),
        F.size("detections").cast("long").alias("n_detections"),
    )


def op2_bpe(spark: SparkSession, folder: str) -> DataFrame:
    ranks = public_tokenizers.path("byte_bpe_50k.tiktoken")
    return bpe.digests(read(spark, folder, "documents"), ranks, public_tokenizers.PATTERN)


def op3_token_files(spark: SparkSession, folder: str) -> DataFrame:
    docs = read(spark, folder, "documents")
    tokenizer = public_tokenizers.path("word_bpe_49k.json")
    return token_files.write_and_read(spark, docs, staging_path(spark, "token-files"), tokenizer, end_id=2)


def spans_text(spans: str) -> Column:
    return F.array_join(F.transform(spans, lambda f: F.concat_ws(":", f["kind"], f["start"], f["end"])), ",")


def n_of_kind(spans: str, kind: str) -> Column:
    return F.size(F.filter(spans, lambda f: f["kind"] == kind)).cast("long").alias(f"n_{kind}")


def op4_pii(spark: SparkSession, folder: str) -> DataFrame:
    docs = read(spark, folder, "documents").select("doc_id", "text")
    model = pii.train(*pii.labelled_windows(docs))
    return pii.find(docs, model).select(
        "doc_id",
        *[n_of_kind("base", kind) for kind in pii.KINDS],
        sha256(spans_text("base")).alias("base_sha256"),
        spans_text("spans").alias("spans"),
    )


def op5_urls(spark: SparkSession, folder: str) -> DataFrame:
    pages = read(spark, folder, "pages").select("page_id", "url", "html")
    return url_filter.filter_urls(pages).select(F.col("row.page_id").alias("page_id"), "host", "path", "rule", "verdict")


def op6_decontaminate(spark: SparkSession, folder: str) -> DataFrame:
    docs = read(spark, folder, "documents").select("doc_id", "text")
    judged = decon.with_hits(docs, read(spark, folder, "benchmark")).select(
        F.col("row.doc_id").alias("doc_id"),
        n_words(F.col("spaced")).cast("long").alias("n_words"),
        decon.n_hit().cast("long").alias("n_hit"),
        F.array_sort(F.array_distinct(F.flatten(F.transform("hits", lambda h: h["items"])))).alias("items"),
    )
    return judged.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        sha256(F.array_join("items", ",")).alias("items_sha256"),
        decon.contaminated(F.col("n_hit"), F.col("n_words")).alias("contaminated"),
    )


def op7_lines(spark: SparkSession, folder: str) -> DataFrame:
    """What line dedup leaves of every document: number and digest of its lines."""
    docs = read(spark, folder, "documents").select("doc_id", "text")
    return line_templates.drop_recurring_lines(docs).select(
        "doc_id",
        F.size(F.split(F.coalesce("text", F.lit("")), "\n", -1)).cast("long").alias("n_lines"),
        sha256(F.coalesce("text", F.lit(""))).alias("text_sha256"),
    )


def op8_secrets(spark: SparkSession, folder: str) -> DataFrame:
    docs = read(spark, folder, "documents").select("doc_id", "text")
    ledger = secrets.Ledger(spark, staging_path(spark, "secret-ledger"))
    secrets.update(docs, ledger)
    base = [r.kind for r in secrets.BASE]
    found = secrets.findings_by_path(docs, ledger, ["doc_id"]).withColumn(
        "base", F.filter("findings", lambda f: f["kind"].isin(base))
    )
    return found.select(
        "doc_id",
        *[n_of_kind("base", kind) for kind in base],
        sha256(spans_text("base")).alias("base_sha256"),
        spans_text("findings").alias("spans"),
    )


def op9_quality(spark: SparkSession, folder: str) -> DataFrame:
    docs = read(spark, folder, "documents").select("doc_id", "text")
    base = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    judged = quality.with_verdict(docs, known=base)
    failed = (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))
    return judged.select(
        F.col("row.doc_id").alias("doc_id"),
        *[F.col(k).cast("long").alias(k) for k in base],
        failed.alias("base_failed"),
        (~failed & F.col("rejected_by").isNull()).alias("kept"),
    )


def op10_near_duplicates(spark: SparkSession, folder: str) -> DataFrame:
    labelled = near_duplicates.with_components(read(spark, folder, "documents"))
    return labelled.select(
        "doc_id",
        "n_shingles",
        F.col("component").alias("component_id"),
        F.coalesce(F.col("component") == F.col("doc_id"), F.lit(True)).alias("kept"),
    )


def op11_quality_classifier(spark: SparkSession, folder: str) -> DataFrame:
    """Scores of a machine that never sees the labels of held-out rows; of the documents' columns it reads the text and
    ``n_chars``."""
    docs = read(spark, folder, "documents").select("doc_id", "text", "n_chars")
    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 3 == 1, F.lit(False))
    known = read(spark, folder, "labels").where(~held_out)
    machine = factorisation.train(docs, known, label="quality", metadata=("n_chars",))
    return factorisation.score(docs, machine, metadata=("n_chars",)).select(
        "doc_id", held_out.alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted")
    )


def op12_alignment(spark: SparkSession, folder: str) -> DataFrame:
    docs = read(spark, folder, "documents")
    a, b = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
    return alignment.align_documents(docs, a, b)[0]


def op13_search(spark: SparkSession, folder: str) -> DataFrame:
    return lexical_search.search(read(spark, folder, "documents"), read(spark, folder, "benchmark"))


QUERIES = {
    "op1_licenses": op1_licenses,
    "op2_bpe": op2_bpe,
    "op3_token_files": op3_token_files,
    "op4_pii": op4_pii,
    "op5_urls": op5_urls,
    "op6_decontaminate": op6_decontaminate,
    "op7_lines": op7_lines,
    "op8_secrets": op8_secrets,
    "op9_quality": op9_quality,
    "op10_near_duplicates": op10_near_duplicates,
    "op11_quality_classifier": op11_quality_classifier,
    "op12_alignment": op12_alignment,
    "op13_search": op13_search,
}
