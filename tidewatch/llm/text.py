"""Words, lines and match positions as JVM expressions."""

from __future__ import annotations

from collections.abc import Callable
from string import ascii_lowercase, ascii_uppercase

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: What separates words: anything in ASCII but letters and digits.
SEPARATORS = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
#: What separates words where punctuation belongs to them: ASCII white space.
BLANKS = r"[\x20\x09-\x0D]+"
#: Items whose lengths are added up in one piece.
PIECE = 256


def whole(text: str | Column) -> Column:
    """The text, empty where it is NULL."""
    return F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit(""))


def lower_ascii(text: Column) -> Column:
    """A-Z in lower case and nothing else changed; texts without other letters take the fast way."""
    return F.when(F.octet_length(text) == F.char_length(text), F.lower(text)).otherwise(
        F.translate(text, ascii_uppercase, ascii_lowercase)
    )


def spaced(text: Column, separators: str = SEPARATORS) -> Column:
    """The words of a text, each followed by one space; empty for NULL and for texts without words."""
    joined = F.trim(F.regexp_replace(whole(text), separators, " "))
    return F.when(joined == "", "").otherwise(F.concat(joined, F.lit(" ")))


def n_words(spaced_text: Column) -> Column:
    return F.char_length(spaced_text) - F.char_length(F.replace(spaced_text, F.lit(" ")))


def words(spaced_text: Column) -> Column:
    """The words as an array."""
    return F.array_remove(F.split(spaced_text, " "), "")


def windows(spaced_text: Column, width: int) -> Column:
    """All windows of so many consecutive words, each word followed by a space, in order of their start.

    One regular expression per text, with the window in a lookahead, is several times faster than a lambda over places.
    """
    return F.regexp_extract_all(spaced_text, F.lit("(?=(" + "[^ ]+ " * width + "))[^ ]+ "), F.lit(1))


def every(spaced_text: Column, width: int, step: int) -> Column:
    """The windows that start at word 0, step, 2 * step, ...; ``step`` is not less than ``width``."""
    rest = "".join("(?:[^ ]+ " for _ in range(step - width)) + ")?" * (step - width)
    return F.regexp_extract_all(spaced_text, F.lit("(" + "[^ ]+ " * width + ")" + rest), F.lit(1))


def matches(text: Column, pattern: str, group: int = 0) -> Column:
    """Leftmost non-overlapping matches as an array of (start, end, value).

    Positions count code points, the end is exclusive, ``value`` is the given group. The text between matches comes
    from a split by the same pattern, so adding up the lengths of both gives the places. Patterns must not match the
    empty string.
    """
    gaps = F.split(text, pattern, -1)
    pairs = F.arrays_zip(
        F.slice(gaps, 1, F.size(gaps) - 1).alias("gap"),
        F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("found"),
        F.regexp_extract_all(text, F.lit(pattern), F.lit(group)).alias("value"),
    )
    return placed(pairs)


def running(items: Column, length: Callable[[Column], Column], piece: int = PIECE) -> Column:
    """The items as (before, item), ``before`` being the sum of ``length`` over all earlier items.

    Appending to an array copies it. So the items are cut into pieces, and what is appended to is the list of the
    pieces' sums and the list of sums inside one piece, which keeps the work of an item in bounds.
    """

    def sums(values: Column, start: Column) -> Column:
        """``start`` and the sums up to each of the values."""
        zero = F.struct(start.alias("at"), F.array(start).alias("all"))

        def step(acc: Column, value: Column) -> Column:
            at = acc["at"] + value
            return F.struct(at.alias("at"), F.concat(acc["all"], F.array(at)).alias("all"))

        return F.aggregate(values, zero, step, lambda acc: acc["all"])

    def paired(part: Column, start: Column) -> Column:
        before = F.slice(sums(F.transform(part, length), start), 1, F.size(part))
        return F.zip_with(part, before, lambda item, at: F.struct(at.alias("before"), item.alias("item")))

    def joined(parts: Column) -> Column:
        totals = F.transform(parts, lambda part: F.aggregate(part, F.lit(0), lambda total, item: total + length(item)))
        starts = F.slice(sums(totals, F.lit(0)), 1, F.size(parts))
        return F.flatten(F.zip_with(parts, starts, paired))

    return once(pieces(items, piece), joined)


def pieces(items: Column, piece: int = PIECE) -> Column:
    """The items as an array of arrays of at most ``piece`` items, in order; one empty piece if there are none."""

    def cut(every_item: Column) -> Column:
        firsts = F.sequence(F.lit(1), F.greatest(F.size(every_item), F.lit(1)), F.lit(piece))
        return F.transform(firsts, lambda first: F.slice(every_item, first, F.lit(piece)))

    return once(items, cut)


def once(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)``, the value worked out once however often it is used."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def placed(pairs: Column) -> Column:
    """Places of ``found`` from (gap, found, value) in order of occurrence."""
    told = running(pairs, lambda p: F.char_length(p["gap"]) + F.char_length(p["found"]))

    def place(r: Column) -> Column:
        start = r["before"] + F.char_length(r["item"]["gap"])
        end = start + F.char_length(r["item"]["found"])
        return F.struct(start.alias("start"), end.alias("end"), r["item"]["value"].alias("value"))

    return F.coalesce(F.transform(told, place), F.array().cast("array<struct<start:int,end:int,value:string>>"))


def covered(spans: Column) -> Column:
    """How many places lie in any of the (start, end) spans; starts and ends ascend together."""
    zero = F.struct(F.lit(0).alias("end"), F.lit(0).alias("n"))

    def step(acc: Column, span: Column) -> Column:
        end = F.greatest(acc["end"], span["end"])
        return F.struct(end.alias("end"), (acc["n"] + end - F.greatest(acc["end"], span["start"])).alias("n"))

    return F.aggregate(spans, zero, step, lambda acc: acc["n"])
