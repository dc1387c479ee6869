"""Secret scans with an incremental ledger of blobs.

Every version of every path is addressed by the SHA-256 of its content. The ledger, a Parquet table, holds for each blob
the rule versions it was scanned with and what they found. A run scans each blob once, with those rules only whose
version the ledger does not list for it, appends the findings, and joins the ledger back to all paths that hold the
blob. A changed rule has another version, so only that rule is run again.

* NULL text is the empty blob, which has no findings. Repeated rows each get the findings of their blob.
* Rules work on whole texts; places count code points, ends are exclusive. Rules may overlap, one rule does not.
* An empty table gives an empty result and leaves the ledger as it is. Columns that are not asked for are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewatch.llm.text import matches, once, whole
from tidewatch.sources.staging import stage

FINDINGS = "array<struct<kind:string,start:int,end:int>>"
#: Most unseen blobs whose addresses are sent to every task (64 bytes each); beyond that texts are dealt out by address.
MAX_UNSEEN = 100_000
LEDGER = f"blob string, versions array<string>, findings {FINDINGS}"


@dataclass(frozen=True)
class Rule:
    """A match counts if its ``group`` has at least ``least`` characters. ``keyword`` must occur in the text for the
    pattern to be tried at all."""

    kind: str
    pattern: str
    group: int = 0
    least: int = 1
    keyword: str = ""

    @property
    def version(self) -> str:
        said = "\0".join([self.kind, self.pattern, str(self.group), str(self.least), self.keyword])
        return f"{self.kind}-{hashlib.sha256(said.encode()).hexdigest()[:12]}"

    def findings(self, text: Column) -> Column:
        spans = F.filter(matches(text, self.pattern, self.group), lambda m: F.char_length(m["value"]) >= self.least)
        found = F.transform(
            spans, lambda m: F.struct(F.lit(self.kind).alias("kind"), m["start"].alias("start"), m["end"].alias("end"))
        )
        tried = text.rlike(self.pattern)
        if self.keyword:
            tried = F.contains(text, F.lit(self.keyword)) & tried
        return F.when(tried, found).otherwise(F.array().cast(FINDINGS)).cast(FINDINGS)


#: Kinds in the order in which findings at one place are listed. The patterns of the first three are fixed values.
BASE = (
    Rule(
        "assign",
        r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
        group=2,
        least=6,
    ),
    Rule("access", r"AKIA[A-Z0-9]+", least=20, keyword="AKIA"),
    # Runs are maximal, so asking for 24 characters in the pattern drops the same runs as counting them afterwards.
    Rule("hex", r"[0-9a-f]{24,}", least=24),
)
MORE = (
    # A class with a bound: repeated groups recurse in Java's engine.
    Rule("private_key", r"-----BEGIN (?:[A-Z0-9 ]{1,64} )?PRIVATE KEY(?: BLOCK)?-----", keyword="-----BEGIN "),
    Rule("github", r"\b(?:gh[pousr]_[A-Za-z0-9]{36,}|github_pat_[A-Za-z0-9_]{60,})", keyword="gh"),
    Rule("gitlab", r"\bglpat-[A-Za-z0-9_-]{20,}", keyword="glpat-"),
    Rule("slack", r"\bxox[abeoprs]-[A-Za-z0-9-]{20,}", keyword="xox"),
    Rule("stripe", r"\b[rs]k_live_[A-Za-z0-9]{20,}", keyword="k_live_"),
    Rule("google", r"\bAIza[A-Za-z0-9_-]{35}", keyword="AIza"),
    Rule("sendgrid", r"\bSG\.[A-Za-z0-9_-]{16,}\.[A-Za-z0-9_-]{32,}", keyword="SG."),
    Rule("npm", r"\bnpm_[A-Za-z0-9]{36,}", keyword="npm_"),
    Rule("jwt", r"\beyJ[A-Za-z0-9_-]{10,}\.eyJ[A-Za-z0-9_-]{10,}\.[A-Za-z0-9_-]{10,}", keyword="eyJ"),
    Rule("bearer", r"\bBearer [A-Za-z0-9._~+/-]{20,}=*", keyword="Bearer "),
    Rule("url_login", r"\b[a-z][a-z0-9+]{1,15}://[^\s:/@]{1,64}:[^\s:/@]{3,64}@[A-Za-z0-9.-]+", keyword="://"),
    Rule("temporary_access", r"\bASIA[A-Z0-9]{16,}", keyword="ASIA"),
)
RULES = BASE + MORE


class Ledger:
    """Parquet table of scanned blobs at a path that all executors reach."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path

    def exists(self) -> bool:
        """Whether a run was written."""
        there = self.spark._jvm.org.apache.hadoop.fs.Path(self.path)
        files = there.getFileSystem(self.spark._jsc.hadoopConfiguration())
        return files.exists(there)

    def read(self) -> DataFrame:
        """The table as it is; empty before the first run."""
        if not self.exists():
            return self.spark.createDataFrame([], LEDGER)
        return self.spark.read.schema(LEDGER).parquet(self.path)

    def append(self, rows: DataFrame) -> None:
        rows.write.mode("append").parquet(self.path)


def update(docs: DataFrame, ledger: Ledger, rules: Sequence[Rule] = RULES, text: str = "text") -> None:
    """Scan what the ledger does not know yet and append it."""
    versions = F.array(*[F.lit(r.version) for r in rules])
    known = (
        ledger.read()
        .select("blob", F.explode("versions").alias("version"))
        .where(F.array_contains(versions, F.col("version")))
        .groupBy("blob")
        .agg(F.collect_set("version").alias("known"))
    )
    texts = docs.select(whole(text).alias("text")).select(F.sha2("text", 256).alias("blob"), "text")
    if ledger.exists():
        # Addresses are dealt out before texts: where few blobs are new, no other text leaves its task.
        done = known.where(F.size("known") == len({r.version for r in rules})).select("blob")
        unseen = stage(texts.select("blob").distinct().join(done, "blob", "left_anti"), "unseen-blobs")
        if unseen.count() <= MAX_UNSEEN:
            texts = texts.join(F.broadcast(unseen), "blob", "left_semi")
    blobs = (
        texts.dropDuplicates(["blob"])
        .join(known, "blob", "left")
        .withColumn("versions", F.array_except(versions, F.coalesce("known", F.array().cast("array<string>"))))
        .where(F.size("versions") > 0)
    )
    found = [
        F.when(F.array_contains("versions", r.version), r.findings(F.col("text"))).otherwise(F.array().cast(FINDINGS))
        for r in rules
    ]
    ledger.append(blobs.select("blob", "versions", F.concat(*found).cast(FINDINGS).alias("findings")))


def findings_by_path(
    docs: DataFrame, ledger: Ledger, keep: Sequence[str], rules: Sequence[Rule] = RULES, text: str = "text"
) -> DataFrame:
    """The ``keep`` columns of every row, its blob and the ledger's findings by the given rules, by start, then by the
    order of the rules."""
    kinds = F.array(*[F.lit(r.kind) for r in rules])
    versions = F.array(*[F.lit(r.version) for r in rules])
    held = (
        ledger.read()
        .where(F.arrays_overlap("versions", versions) & (F.size("findings") > 0))
        .groupBy("blob")
        .agg(F.flatten(F.collect_list(F.filter("findings", lambda f: F.array_contains(kinds, f["kind"])))).alias("found"))
    )
    order = F.transform(
        "found",
        lambda f: F.struct(
            f["start"].alias("start"),
            F.array_position(kinds, f["kind"]).alias("rank"),
            f["end"].alias("end"),
            f["kind"].alias("kind"),
        ),
    )
    # Sets of structs compare all pairs; in order, equal ones are neighbours.
    distinct = once(F.sort_array(order), lambda o: F.filter(o, lambda f, i: (i == 0) | (f != F.get(o, i - 1))))
    sorted_findings = F.transform(
        distinct,
        lambda f: F.struct(f["kind"].alias("kind"), f["start"].alias("start"), f["end"].alias("end")),
    )
    return (
        docs.select(*keep, F.sha2(whole(text), 256).alias("blob"))
        .join(held, "blob", "left")
        .select(*keep, "blob", F.coalesce(sorted_findings, F.array().cast(FINDINGS)).cast(FINDINGS).alias("findings"))
    )
