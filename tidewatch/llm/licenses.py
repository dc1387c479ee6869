"""License scans: ordered signature rules over the words of a text.

A rule is a regular expression over the lower-case words, a keyword without which it is not tried, a priority and a
confidence. Rules are written as license names and as the forms in which a name is stated (tag, grant, address, title),
besides sentences of license bodies. What two rules find in the same place is resolved by intervals: a detection inside
another one of the same or a better priority is dropped.

* NULL and empty texts have no words and no detections. Repeated rows are scanned one by one.
* Of detections of one place and priority the rule listed first stays. An empty table gives an empty table.
* Texts without any of the few stems in ``STEMS`` are not looked at again; every keyword contains a stem.
"""

from __future__ import annotations

import json
import re
from collections.abc import Sequence
from dataclasses import asdict, dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewatch.llm.text import lower_ascii, n_words, once, pieces, running, spaced, whole

#: (label, keyword, name as a regular expression over words). The name is what forms are built around.
NAMES = (
    ("apache-2.0", "apache", r"apache(?: software)?(?: license| licence)?(?: version| v)? ?v?2(?: 0)?"),
    ("apache-2.0", " asl", r"asl(?: software)?(?: license| licence)?(?: version| v)? ?v?2(?: 0)?"),
    ("apache-1.1", "apache", r"apache(?: software)?(?: license| licence)?(?: version| v)? ?v?1 1"),
    ("apache-1.0", "apache", r"apache(?: software)?(?: license| licence)?(?: version| v)? ?v?1 0"),
    ("mit", "licen", r"(?:mit|expat|x11)(?: style)? licen[cs]e"),
    ("mit-0", "licen", r"mit (?:no attribution|0) licen[cs]e"),
    ("bsd-2-clause", "bsd", r"(?:bsd 2 clause|2 clause bsd|simplified bsd|freebsd)(?: license| licence)?"),
    ("bsd-3-clause", "bsd", r"(?:bsd 3 clause|3 clause bsd|new bsd|modified bsd|revised bsd)(?: license| licence)?"),
    ("bsd-4-clause", "bsd", r"(?:bsd 4 clause|4 clause bsd|original bsd|old bsd)(?: license| licence)?"),
    ("bsd", "bsd", r"bsd(?: style)?(?: license| licence)"),
    ("0bsd", "bsd", r"(?:0bsd|zero clause bsd|bsd zero clause)(?: license| licence)?"),
    ("isc", "isc licen", r"isc licen[cs]e"),
    ("zlib", "zlib", r"zlib(?: libpng)?(?: license| licence)"),
    ("libpng", "libpng", r"libpng(?: license| licence)"),
    ("unlicense", "unlicense", r"(?:the )?unlicense"),
    ("wtfpl", "wtfpl", r"wtfpl(?: version| v)?(?: ?2)?"),
    ("bsl-1.0", "boost", r"boost software license(?: version)?(?: 1 0)?"),
    ("gpl-1.0", "general public", r"(?:gnu )?general public license(?: version| v)? ?v?1(?: 0)?"),
    ("gpl-2.0", "general public", r"(?:gnu )?general public license(?: version| v)? ?v?2(?: 0)?"),
    ("gpl-3.0", "general public", r"(?:gnu )?general public license(?: version| v)? ?v?3(?: 0)?"),
    ("gpl-2.0", "gpl", r"(?:gnu )?gpl ?(?:version|v)? ?v?2(?: 0)?"),
    ("gpl-3.0", "gpl", r"(?:gnu )?gpl ?(?:version|v)? ?v?3(?: 0)?"),
    ("lgpl-2.0", "general public", r"(?:gnu )?(?:lesser|library) general public license(?: version| v)? ?v?2(?: 0)?"),
    ("lgpl-2.1", "lesser", r"(?:gnu )?lesser general public license(?: version| v)? ?v?2 1"),
    ("lgpl-3.0", "lesser", r"(?:gnu )?lesser general public license(?: version| v)? ?v?3(?: 0)?"),
    ("lgpl-2.1", "lgpl", r"(?:gnu )?lgpl ?(?:version|v)? ?v?2 1"),
    ("lgpl-3.0", "lgpl", r"(?:gnu )?lgpl ?(?:version|v)? ?v?3(?: 0)?"),
    ("agpl-3.0", "affero", r"(?:gnu )?affero general public license(?: version| v)?(?: ?v?3)?(?: 0)?"),
    ("agpl-3.0", "agpl", r"(?:gnu )?agpl ?(?:version|v)? ?v?3(?: 0)?"),
    ("gfdl", "free documentation", r"(?:gnu )?free documentation license(?: version| v)?(?: 1 [123])?"),
    ("mpl-1.1", "mozilla public", r"mozilla public license(?: version| v)? ?v?1 1"),
    ("mpl-2.0", "mozilla public", r"mozilla public license(?: version| v)?(?: ?v?2)?(?: 0)?"),
    ("mpl-2.0", " mpl", r"mpl ?(?:version|v)? ?v?2(?: 0)?"),
    ("epl-1.0", "eclipse public", r"eclipse public license(?: version| v)? ?v?1(?: 0)?"),
    ("epl-2.0", "eclipse public", r"eclipse public license(?: version| v)? ?v?2(?: 0)?"),
    ("edl-1.0", "eclipse distribution", r"eclipse distribution license(?: version| v)?(?: 1 0)?"),
    ("cddl-1.0", "common development", r"common development and distribution license(?: version| v)?(?: 1 [01])?"),
    ("cpl-1.0", "common public", r"common public license(?: version| v)?(?: 1 0)?"),
    ("eupl-1.2", "european union public", r"european union public licen[cs]e(?: version| v)?(?: 1 2)?"),
    ("artistic-1.0", "artistic", r"artistic license(?: version| v)? ?1(?: 0)?"),
    ("artistic-2.0", "artistic", r"artistic license(?: version| v)? ?2(?: 0)?"),
    ("afl-3.0", "academic free", r"academic free license(?: version| v)?(?: 3 0)?"),
    ("osl-3.0", "open software", r"open software license(?: version| v)?(?: 3 0)?"),
    ("ofl-1.1", "open font", r"(?:sil )?open font license(?: version| v)?(?: 1 1)?"),
    ("python-2.0", "python software", r"python software foundation license(?: version| v)?(?: 2)?"),
    ("php-3.01", "php license", r"php license(?: version| v)?(?: 3 01?)?"),
    ("ruby", "ruby license", r"ruby license"),
    ("postgresql", "postgresql", r"postgresql license"),
    ("openssl", "openssl", r"openssl license"),
    ("curl", "curl license", r"curl license"),
    ("ncsa", "ncsa", r"(?:university of illinois )?ncsa open source license"),
    ("upl-1.0", "universal permissive", r"universal permissive license(?: version| v)?(?: 1 0)?"),
    ("mulan-2.0", "mulan", r"mulan (?:permissive software license|psl)(?: version| v)?(?: ?2)?"),
    ("ms-pl", "microsoft public", r"microsoft public license"),
    ("ms-rl", "microsoft reciprocal", r"microsoft reciprocal license"),
    ("sspl-1.0", "server side public", r"server side public license(?: version| v)?(?: 1)?"),
    ("busl-1.1", "business source", r"business source license(?: version| v)?(?: 1 1)?"),
    ("elastic-2.0", "elastic license", r"elastic license(?: version| v)?(?: 2(?: 0)?)?"),
    ("odbl-1.0", "open database", r"open database license(?: version| v)?(?: 1 0)?"),
    ("odc-by-1.0", "open data commons attribution", r"open data commons attribution license"),
    ("pddl-1.0", "public domain dedication", r"public domain dedication and licen[cs]e"),
    ("cc0-1.0", "cc0", r"cc0(?: 1 0)?(?: universal)?"),
    ("cc-by-4.0", "cc by", r"cc by 4 0"),
    ("cc-by-3.0", "cc by", r"cc by 3 0"),
    ("cc-by-sa-4.0", "cc by sa", r"cc by sa 4 0"),
    ("cc-by-sa-3.0", "cc by sa", r"cc by sa 3 0"),
    ("cc-by-nc-4.0", "cc by nc", r"cc by nc 4 0"),
    ("cc-by-nc-sa-4.0", "cc by nc sa", r"cc by nc sa 4 0"),
    ("cc-by-nd-4.0", "cc by nd", r"cc by nd 4 0"),
    ("cc-by-nc-nd-4.0", "cc by nc nd", r"cc by nc nd 4 0"),
    ("cc-by", "creative commons", r"creative commons attribution(?: [1-4] 0)?(?: international)?(?: license)?"),
    ("cc-by-sa", "creative commons", r"creative commons attribution share ?alike(?: [1-4] 0)?(?: international)?"),
    ("cc-by-nc", "creative commons", r"creative commons attribution non ?commercial(?: [1-4] 0)?(?: international)?"),
)

#: Forms around a name: (what it is, priority, confidence, prefix, suffix). Tags are built from the labels.
FORMS = (
    (
        "grant",
        2,
        0.95,
        r"(?:re)?(?:licensed|released|distributed|available|provided|published|issued|covered|offered)"
        r"(?: to you)? (?:under|by|with)(?: the| an?)?(?: terms(?: and conditions)? of)?(?: the| an?)? ",
        r"(?: only| or later| or any later version)?",
    ),
    ("see", 3, 0.85, r"(?:see|read|copy of|subject to|terms of|according to|compatible with) (?:the |an? )?", r""),
    ("title", 4, 0.7, r"", r""),
)

#: Sentences of license bodies and notices: (label, priority, confidence, keyword, regular expression over words).
SENTENCES = (
    ("mit", 1, 0.98, "permission is hereby", r"permission is hereby granted free of charge to any person obtaining a copy"),
    ("mit", 2, 0.9, "licensed under", r"licensed under (?:the )?mit"),
    ("mit", 2, 0.9, "permission notice", r"above copyright notice and this permission notice shall be included"),
    ("isc", 1, 0.98, "permission to use", r"permission to use copy modify and or distribute this software for any purpose"),
    ("bsd", 2, 0.9, "redistribution and use", r"redistribution and use in source and binary forms with or without"),
    ("bsd-3-clause", 1, 0.95, "neither the name", r"neither the name of .{1,80}? nor the names of its contributors may be used to"),
    ("bsd-4-clause", 1, 0.95, "advertising materials", r"all advertising materials mentioning features or use of this"),
    ("gpl", 2, 0.9, "free software", r"is free software you can redistribute it and or modify it under the terms of the"),
    ("gpl-2.0-or-later", 1, 0.97, "any later version", r"either version 2 (?:of the license )?or at your option any later version"),
    ("gpl-3.0-or-later", 1, 0.97, "any later version", r"either version 3 (?:of the license )?or at your option any later version"),
    ("lgpl-2.1-or-later", 1, 0.97, "any later version", r"either version 2 1 (?:of the license )?or at your option any later version"),
    ("apache-2.0", 1, 0.98, "in compliance with", r"you may not use this file except in compliance with the license"),
    ("apache-2.0", 1, 0.98, "apache org", r"(?:www )?apache org licenses license 2 0"),
    ("mit", 1, 0.95, "opensource org", r"opensource org licenses? mit"),
    ("bsd-3-clause", 1, 0.95, "opensource org", r"opensource org licenses? bsd 3 clause"),
    ("gpl", 2, 0.9, "gnu org", r"(?:www )?gnu org licenses"),
    ("mpl-2.0", 1, 0.97, "mozilla public", r"this source code form is subject to the terms of the mozilla public license v 2 0"),
    ("mpl-2.0", 1, 0.95, "mozilla org", r"mozilla org mpl 2 0"),
    ("zlib", 2, 0.9, "implied warranty", r"provided as is without any express or implied warranty in no event will the authors"),
    ("unlicense", 1, 0.97, "public domain", r"free and unencumbered software released into the public domain"),
    ("bsl-1.0", 1, 0.95, "boost org", r"(?:www )?boost org license 1 0 txt"),
    ("cc-by-4.0", 1, 0.97, "creativecommons org", r"creativecommons org licenses by 4 0"),
    ("cc-by-sa-4.0", 1, 0.97, "creativecommons org", r"creativecommons org licenses by sa 4 0"),
    ("cc-by-nc-4.0", 1, 0.97, "creativecommons org", r"creativecommons org licenses by nc 4 0"),
    ("cc0-1.0", 1, 0.97, "creativecommons org", r"creativecommons org publicdomain zero 1 0"),
    ("public-domain", 3, 0.7, "public domain", r"(?:in|into|to) the public domain"),
    ("proprietary", 3, 0.8, "rights reserved", r"all rights reserved"),
    ("proprietary", 2, 0.9, "proprietary and", r"proprietary and confidential"),
    ("proprietary", 2, 0.9, "unauthori", r"unauthori[sz]ed (?:copying|use|distribution|reproduction)"),
    ("copyright-notice", 4, 0.5, "copyright", r"copyright (?:c )?(?:19|20)[0-9]{2}"),
    ("warranty-disclaimer", 4, 0.4, "without warrant", r"without warrant(?:y|ies) (?:of any kind|or conditions of any kind)"),
)

#: Labels and words of the base phrases, fixed values.
PHRASES = (("mit", "mit license"), ("apache", "apache license"), ("gpl", "general public license"))

#: Every keyword contains one of these.
STEMS = (
    *("licen", "apache", " asl", "bsd", "zlib", "libpng", "wtfpl", "boost", "public", "gpl", "lesser", "affero"),
    *("free documentation", " mpl", "eclipse", "common development", "artistic", "academic free", "open software"),
    *("open font", "open data", "python software", "postgresql", "openssl", "ncsa", "permissi", "mulan", "reciprocal"),
    *("business source", "cc0", "cc by", "creative", "redistribution", "neither the name", "advertising"),
    *("free software", "later version", "compliance", "gnu org", "opensource", "mozilla", "warrant", "reserved"),
    *("proprietary", "unauthori", "copyright"),
)


@dataclass(frozen=True)
class Signature:
    rule: str
    label: str
    priority: int
    confidence: float
    keyword: str
    pattern: str


def signatures() -> tuple[Signature, ...]:
    """All rules in their order: sentences, tags, then every name in every form."""
    listed = [
        Signature(f"{label}/sentence-{k}", label, p, c, keyword, f" {words}(?= )")
        for k, (label, p, c, keyword, words) in enumerate(SENTENCES)
    ]
    for label in dict.fromkeys(label for label, _, _ in NAMES):
        words = re.sub(r"[^a-z0-9]+", " ", label)
        tag = f" spdx license identifier {words}(?: only| or later)?(?= )"
        listed.append(Signature(f"{label}/tag", label, 1, 0.99, "spdx license identifier", tag))
    for form, priority, confidence, before, after in FORMS:
        listed += [
            Signature(f"{label}/{form}-{k}", label, priority, confidence, keyword, f" {before}{name}{after}(?= )")
            for k, (label, keyword, name) in enumerate(NAMES)
        ]
    return tuple(listed)


RULES = signatures()
PRIORITIES = 4
DETECTIONS = "array<struct<start:int,end:int,label:string,rule:string,priority:int,confidence:double>>"


def _rule_table(rules: Sequence[Signature]) -> Column:
    """The rules as one constant of the plan."""
    kind = "array<struct<rank:int,rule:string,label:string,priority:int,confidence:double,keyword:string,pattern:string>>"
    return F.from_json(F.lit(json.dumps([{"rank": k} | asdict(r) for k, r in enumerate(rules)])), kind)


def places(padded: Column, pattern: Column | str) -> Column:
    """(start, end) in words of every match in a text whose words all have a space before them."""
    gaps = F.split(padded, pattern, -1)
    found = F.regexp_extract_all(padded, F.lit(pattern) if isinstance(pattern, str) else pattern, F.lit(0))
    pairs = F.zip_with(found, gaps, lambda m, g: F.struct(n_words(g).alias("gap"), n_words(m).alias("found")))
    told = running(once(pairs, lambda p: F.slice(p, 1, F.size(p) - 1)), lambda p: p["gap"] + p["found"])

    def place(r: Column) -> Column:
        start = r["before"] + r["item"]["gap"]
        return F.struct(start.alias("start"), (start + r["item"]["found"]).alias("end"))

    return F.transform(told, place)


def detections(padded: Column, rules: Sequence[Signature] = RULES) -> Column:
    """Everything that any rule finds, unresolved; the place of a rule in the list is its ``rank``."""
    tried = F.filter(_rule_table(rules), lambda r: F.contains(padded, r["keyword"]) & F.rlike(padded, r["pattern"]))
    return F.flatten(
        F.transform(
            tried,
            lambda r: F.transform(
                places(padded, r["pattern"]),
                lambda s: F.struct(
                    s["start"].alias("start"),
                    (-s["end"]).alias("minus_end"),
                    r["priority"].alias("priority"),
                    r["rank"].alias("rank"),
                    r["label"].alias("label"),
                    r["rule"].alias("rule"),
                    r["confidence"].alias("confidence"),
                ),
            ),
        )
    )


def resolved(found: Column) -> Column:
    """Detections that lie in no other one of the same or a better priority, by start.

    Sorted by start, longest first, a container precedes what it contains; so the largest end seen so far for each
    priority and all better ones tells whether a detection is contained.
    """
    zero = F.struct(
        F.array(*[F.lit(-1)] * PRIORITIES).alias("ends"), F.array().cast(f"array<{DETECTIONS}>").alias("kept")
    )

    def step(acc: Column, d: Column) -> Column:
        end = -d["minus_end"]
        ends = F.transform(acc["ends"], lambda e, k: F.when(k + 1 >= d["priority"], F.greatest(e, end)).otherwise(e))
        row = F.struct(
            d["start"].alias("start"),
            end.alias("end"),
            d["label"].alias("label"),
            d["rule"].alias("rule"),
            d["priority"].alias("priority"),
            d["confidence"].alias("confidence"),
        )
        inside = F.get(acc["ends"], d["priority"] - 1) >= end
        kept = F.when(inside, acc["kept"]).otherwise(F.concat(acc["kept"], F.array(row).cast(DETECTIONS)))
        return F.struct(ends.alias("ends"), kept.cast(DETECTIONS).alias("kept"))

    def whole_piece(acc: Column, piece: Column) -> Column:
        begun = F.struct(acc["ends"].alias("ends"), F.array().cast(DETECTIONS).alias("kept"))
        return once(
            F.aggregate(piece, begun, step),
            lambda done: F.struct(
                done["ends"].alias("ends"), F.concat(acc["kept"], F.array(done["kept"])).alias("kept")
            ),
        )

    # Appending copies the list, so each piece has a list of its own.
    return F.aggregate(pieces(F.sort_array(found)), zero, whole_piece, lambda acc: F.flatten(acc["kept"]))


def scan(docs: DataFrame, rules: Sequence[Signature] = RULES, text: str = "text") -> DataFrame:
    """(row, words, n_words, detections): the document as a struct, its words with a space on either side, their
    number, and the resolved detections with starts and ends in words."""
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")).withColumn(
        "spaced", spaced(lower_ascii(whole(F.col("row").getField(text))))
    )
    padded = F.concat(F.lit(" "), F.col("spaced"))
    possible = F.lit(False)
    for stem in STEMS:
        possible = possible | F.contains(F.col("words"), F.lit(stem))
    return (
        rows.withColumn("words", padded)
        .withColumn("found", F.when(possible, detections(F.col("words"), rules)))
        .select(
            "row",
            "words",
            n_words(F.col("spaced")).alias("n_words"),
            F.when(F.size("found") > 0, resolved(F.col("found"))).otherwise(F.array().cast(DETECTIONS)).cast(DETECTIONS).alias("detections"),
        )
    )


def phrase_places(padded: Column, phrase: str) -> Column:
    """(n, first, last) of the places where the words of a phrase stand consecutively."""
    pattern = f" {phrase}(?= )"
    width = len(phrase.split())

    def measured(parts: Column) -> Column:
        n = F.size(parts) - 1
        first = n_words(F.get(parts, F.lit(0)))
        # The text ends with a space that belongs to no word.
        last = n_words(padded) - 1 - (n_words(F.element_at(parts, -1)) - 1) - width
        return F.when(
            n > 0, F.struct(n.alias("n"), first.alias("first"), last.alias("last"))
        ).otherwise(F.lit(None).cast("struct<n:int,first:int,last:int>"))

    return F.get(F.transform(F.array(F.split(padded, pattern, -1)), measured), F.lit(0))
