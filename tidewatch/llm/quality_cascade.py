"""Quality rules as a short-circuit cascade.

Each rule is a condition that rejects a document. A bounded sample tells what a rule costs and what share of documents
it rejects; the rules are then asked in the order of rejections per cost, and a document that one rule rejects is not
shown to the next. The order changes the work and never the verdict: a document is kept if no rule rejects it.

* NULL or empty text: no words; the rules decide (the default ones reject it for its few words).
* Repeated rows and repeated ids are judged one by one; further columns stay as they are.
* A rule that is NULL for a document does not reject it. An empty table gives an empty table.
* Different words grow slower than a text, so their share is a mean over stretches of ``VARIETY`` words that cover the text.
* Scripts without spaces have no words of their own: ``UNSPACED`` characters do not count for the longest mean word, and
  ``UNSPACED_WORD`` of them count as one word where words are asked to be many enough.
"""

from __future__ import annotations

import time
from collections.abc import Mapping, Sequence
from string import ascii_uppercase

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewatch.llm.text import BLANKS, covered, n_words, spaced, whole, windows, words
from tidewatch.sources.staging import stage

WINDOW = 8
SYMBOLS = "#*$%&|<>"
#: Words over which different words are counted.
VARIETY = 10_000
#: Characters of scripts written without spaces: Thai, Lao, Tibetan, Burmese, Khmer, Kana, Han and their punctuation.
UNSPACED = (
    r"[\x{0E00}-\x{0FFF}\x{1000}-\x{109F}\x{1780}-\x{17FF}\x{3000}-\x{30FF}\x{31F0}-\x{31FF}\x{3400}-\x{4DBF}"
    r"\x{4E00}-\x{9FFF}\x{F900}-\x{FAFF}\x{FF00}-\x{FFEF}\x{20000}-\x{3FFFF}]+"
)
UNSPACED_WORD = 2
#: Rows of the sample that orders the rules; they never influence a verdict.
SAMPLE_ROWS = 2000


def n_characters(text: Column, characters: str) -> Column:
    """Occurrences of any of the characters."""
    return F.char_length(text) - F.char_length(F.translate(text, characters, ""))


def word_characters(text: Column) -> Column:
    """Code points that are not ASCII white space."""
    return F.char_length(F.translate(text, " \t\n\x0b\x0c\r", ""))


def n_unspaced(text: Column) -> Column:
    """Code points of scripts without spaces."""
    return F.char_length(text) - F.char_length(F.regexp_replace(text, UNSPACED, ""))


def n_distinct_words(tokens: Column, length: int = VARIETY) -> Column:
    """Different words of every stretch of so many words, added up; the last stretch may be shorter."""

    def added(all_words: Column) -> Column:
        starts = F.sequence(F.lit(1), F.greatest(F.size(all_words), F.lit(1)), F.lit(length))
        return F.aggregate(
            starts, F.lit(0), lambda n, at: n + F.size(F.array_distinct(F.slice(all_words, at, F.lit(length))))
        )

    return F.get(F.transform(F.array(tokens), added), 0)


def lines(text: Column) -> Column:
    """Lines that hold a word."""
    return F.filter(F.split(text, "\n", -1), lambda line: line.rlike(r"[^\x20\x09-\x0D]"))


def n_duplicate_lines(text: Column) -> Column:
    """Lines that equal an earlier line."""
    return F.size(lines(text)) - F.size(F.array_distinct(lines(text)))


def repeated_starts(spaced_text: Column, width: int = WINDOW) -> Column:
    """Where windows start that occur at least twice among the words, ascending, in words.

    Most texts have none, which a hash set of the windows tells; otherwise windows are sorted and compared with their
    neighbours.
    """
    all_windows = F.transform(F.array(windows(spaced_text, width)), recurring)
    return F.flatten(all_windows)


def recurring(found: Column) -> Column:
    def starts(ordered: Column) -> Column:
        at = lambda k: F.get(ordered, k)["window"]
        same = F.filter(
            F.sequence(F.lit(0), F.size(ordered) - 1),
            lambda k: F.coalesce(at(k) == at(k - 1), F.lit(False)) | F.coalesce(at(k) == at(k + 1), F.lit(False)),
        )
        return F.sort_array(F.transform(same, lambda k: F.get(ordered, k)["start"]))

    ordered = F.sort_array(F.transform(found, lambda w, i: F.struct(w.alias("window"), i.alias("start"))))
    return F.when(
        F.size(F.array_distinct(found)) < F.size(found), F.flatten(F.transform(F.array(ordered), starts))
    ).otherwise(F.array().cast("array<int>"))


def n_repeated_words(spaced_text: Column, width: int = WINDOW) -> Column:
    """Words inside windows that occur at least twice, the first occurrence included."""
    starts = repeated_starts(spaced_text, width)
    return covered(F.transform(starts, lambda i: F.struct(i.alias("start"), (i + width).alias("end"))))


def measures() -> dict[str, Column]:
    """What the default rules ask of ``text`` and of its words in ``spaced``."""
    text, tokens = F.col("text"), F.col("spaced")
    return {
        "n_words": n_words(tokens),
        "word_chars": word_characters(text),
        "n_symbols": n_characters(text, SYMBOLS),
        "n_exclamations": n_characters(text, "!"),
        "n_capitals": n_characters(text, ascii_uppercase),
        "n_lines": F.size(lines(text)),
        "n_dup_lines": n_duplicate_lines(text),
        "n_distinct_words": n_distinct_words(words(tokens)),
        "n_unspaced": n_unspaced(text),
        "n_repeat_words": n_repeated_words(tokens),
    }


def default_rules(known: Mapping[str, Column] | None = None) -> dict[str, Column]:
    """The default rules; a rule evaluates only the measures that it names. ``known`` replaces measures."""
    m = measures() | dict(known or {})
    # Asked only where the words alone are too few, so nearly all texts are spared the search for other scripts.
    all_words = m["n_words"] + m["n_unspaced"] / UNSPACED_WORD
    return {
        "few_words": (m["n_words"] < 20) & (all_words < 20),
        "repeated_windows": 100 * m["n_repeat_words"] > 30 * m["n_words"],
        "symbols": (2 * m["n_symbols"] > m["n_words"]) & (2 * m["n_symbols"] > all_words),
        "exclamations": (2 * m["n_exclamations"] > m["n_words"]) & (2 * m["n_exclamations"] > all_words),
        "capitals": 2 * m["n_capitals"] > m["word_chars"],
        "duplicate_lines": 2 * m["n_dup_lines"] > m["n_lines"],
        "word_length": (m["word_chars"] < 2 * m["n_words"])
        | ((m["word_chars"] > 15 * m["n_words"]) & (m["word_chars"] - m["n_unspaced"] > 15 * m["n_words"])),
        "few_distinct_words": 10 * m["n_distinct_words"] < m["n_words"],
    }


def with_words(df: DataFrame, text: str = "text") -> DataFrame:
    """The working columns ``text`` and ``spaced`` of the rules."""
    return df.select(whole(text).alias("text")).withColumn("spaced", spaced(F.col("text"), BLANKS))


def ordered_rules(df: DataFrame, rules: Mapping[str, Column], sample_rows: int = SAMPLE_ROWS) -> list[str]:
    """Names of the rules by rejections per second on a sample, ties by their given order.

    The sample is a random share of the rows that aims at ``sample_rows`` and is cut there; it is written once.
    """
    total = df.count()
    if not total:
        return list(rules)
    share = min(1.0, 1.2 * sample_rows / total)
    sample = stage(with_words(df.sample(share, seed=1).limit(sample_rows)), "cascade-sample")
    rejected = sample.agg(*[F.avg(F.coalesce(r, F.lit(False)).cast("int")).alias(k) for k, r in rules.items()]).first()

    def seconds(condition: Column) -> float:
        begin = time.perf_counter()
        sample.agg(F.count_if(condition)).collect()
        return time.perf_counter() - begin

    seconds(n_words(F.col("spaced")) < 0)
    scan = min(seconds(n_words(F.col("spaced")) < 0) for _ in range(2))
    cost = {k: max(seconds(r) - scan, 1e-3) for k, r in rules.items()}
    return sorted(rules, key=lambda k: -(rejected[k] or 0.0) / cost[k])


def cascade(rules: Mapping[str, Column], order: list[str]) -> Column:
    """Name of the first rule in the order that rejects, else NULL. Later rules are not evaluated then."""
    condition = F
    for name in order:
        condition = condition.when(rules[name], F.lit(name))
    return condition.otherwise(F.lit(None).cast("string"))


def reject_low_quality(
    docs: DataFrame, rules: Mapping[str, Column] | None = None, text: str = "text", sample_rows: int = SAMPLE_ROWS
) -> DataFrame:
    """The documents that no rule rejects, with their columns as they were."""
    return with_verdict(docs, rules, text, sample_rows).where("rejected_by IS NULL").select("row.*")


def with_verdict(
    docs: DataFrame,
    rules: Mapping[str, Column] | None = None,
    text: str = "text",
    sample_rows: int = SAMPLE_ROWS,
    *,
    known: Sequence[str] = (),
) -> DataFrame:
    """(row, text, spaced, rejected_by): the document as a struct, the working columns, the first rejecting rule.

    ``known`` names measures that the caller wants as columns anyway; the default rules then read those columns.
    """
    rules = default_rules() if rules is None else rules
    order = ordered_rules(docs.select(text), rules, sample_rows)
    rows = (
        docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))
        .withColumn("text", whole(F.col("row").getField(text)))
        .withColumn("spaced", spaced(F.col("text"), BLANKS))
    )
    if known:
        every = measures()
        rows = rows.withColumns({k: every[k] for k in known})
        rules = default_rules({k: F.col(k) for k in known})
    return rows.withColumn("rejected_by", cascade(rules, order))
