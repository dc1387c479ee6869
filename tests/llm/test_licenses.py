import re
import re._parser as parser

from llm_odd import ODD, table  # noqa: F401
from pyspark.sql import functions as F

from tidewatch.llm import licenses
from tidewatch.llm.text import lower_ascii, spaced

APACHE = "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in compliance with the License."
TEXTS = [
    *ODD,
    "The MIT License. mit license! MIT LICENSE",
    APACHE,
    "SPDX-License-Identifier: GPL-3.0-or-later",
    "This work is licensed under the GNU General Public License, version 3.",
    "mit dem Hund; example simple mpl",
    "All rights reserved. " * 300,
    "Licensed under CC BY-NC 4.0.",
]


def words(text):
    lower = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower)


def test_rules_are_many_and_gated():
    assert len(licenses.RULES) > 200
    assert len({r.rule for r in licenses.RULES}) == len(licenses.RULES)
    for rule in licenses.RULES:
        assert any(stem in rule.keyword for stem in licenses.STEMS), rule
        re.compile(rule.pattern)


def test_phrases_against_brute_force(table):
    padded = F.concat(F.lit(" "), spaced(lower_ascii(F.coalesce("text", F.lit("")))))
    for _, phrase in licenses.PHRASES:
        want, parts = {}, phrase.split()
        for i, text in enumerate(TEXTS):
            w = words(text)
            at = [k for k in range(len(w)) if w[k : k + len(parts)] == parts]
            want[i] = (len(at), at[0], at[-1]) if at else None
        rows = table(TEXTS).select("doc_id", licenses.phrase_places(padded, phrase).alias("p")).collect()
        assert {r["doc_id"]: tuple(r["p"]) if r["p"] else None for r in rows} == want


def resolved(detections):
    """The rule of suppression, pair by pair."""
    out = []
    for d in detections:
        inside = [
            e
            for e in detections
            if e is not d and e[0] <= d[0] and e[1] >= d[1] and e[2] <= d[2]
            and ((e[1] - e[0] > d[1] - d[0]) or (e[2], e[3]) < (d[2], d[3]))
        ]
        if not inside:
            out.append(d[:3])
    return sorted(out)


def test_detections_against_brute_force(table):
    rows = {r["row"]["doc_id"]: r for r in licenses.scan(table(TEXTS)).collect()}
    for i, text in enumerate(TEXTS):
        padded = "".join(f" {w}" for w in words(text)) + " "
        found = [
            (padded[: m.start()].count(" "), padded[: m.end()].count(" "), r.priority, k)
            for k, r in enumerate(licenses.RULES)
            if len(text or "") < 10_000
            for m in re.finditer(r.pattern, padded)
        ]
        got = sorted((d["start"], d["end"], d["priority"]) for d in rows[i]["detections"])
        assert got == resolved(found), text
    labels = lambda i: {d["label"] for d in rows[len(ODD) + i]["detections"]}
    assert labels(1) == {"apache-2.0"} and "gpl-3.0" in labels(2) and labels(4) == set() and labels(6) == {"cc-by-nc-4.0"}


def test_empty_table(table):
    assert licenses.scan(table(["a"]).where("false")).count() == 0


def alternatives(parsed):
    """Texts that match a parsed pattern: every branch, every optional part with and without, the ends of every set."""
    out = [""]
    for kind, what in parsed:
        match str(kind):
            case "LITERAL":
                more = [chr(what)]
            case "BRANCH":
                more = [t for branch in what[1] for t in alternatives(branch)]
            case "SUBPATTERN":
                more = alternatives(what[3])
            case "MAX_REPEAT" | "MIN_REPEAT":
                more = ([""] if what[0] == 0 else []) + [t * max(what[0], 1) for t in alternatives(what[2])]
            case "IN":
                more = [chr(c) for k, v in what for c in ([v] if str(k) == "LITERAL" else v)]
            case "ANY":
                more = ["q"]
            case other:
                raise ValueError(other)
        out = [begin + end for begin in out for end in more]
    return out


def test_every_alternative_holds_its_keyword():
    rules = [(r[1], r[2]) for r in licenses.NAMES] + [(r[3], r[4]) for r in licenses.SENTENCES]
    for keyword, pattern in rules:
        for text in alternatives(parser.parse(f" {pattern} ")):
            assert re.fullmatch(f" {pattern} ", text) and keyword in text, (pattern, text)


def test_gated_names_are_found(table):
    texts = {
        "licensed under the GNU Library General Public License v2": "lgpl-2.0",
        "GNU Lesser General Public License 2.0": "lgpl-2.0",
        "Unauthorised copying of this file": "proprietary",
        "unauthorized use": "proprietary",
        "ASL 2.0": "apache-2.0",
        "released under the ASL v2": "apache-2.0",
    }
    rows = {r["row"]["doc_id"]: {d["label"] for d in r["detections"]} for r in licenses.scan(table(list(texts))).collect()}
    assert [rows[i] for i in range(len(texts))] == [{label} for label in texts.values()]


def test_every_rule_is_found_as_without_gates(table):
    """One text for every rule, with all of its alternatives up to a bound."""
    texts = []
    for rule in licenses.RULES:
        found = alternatives(parser.parse(rule.pattern.removesuffix("(?= )")))
        step = max(1, len(found) // 12)
        texts.append(" | ".join(found[::step][:40]))
    rows = {r["row"]["doc_id"]: r for r in licenses.scan(table(texts)).collect()}
    for i, text in enumerate(texts):
        padded = "".join(f" {w}" for w in words(text)) + " "
        found = [
            (padded[: m.start()].count(" "), padded[: m.end()].count(" "), r.priority, k)
            for k, r in enumerate(licenses.RULES)
            for m in re.finditer(r.pattern, padded)
        ]
        got = sorted((d["start"], d["end"], d["priority"]) for d in rows[i]["detections"])
        assert got == resolved(found), licenses.RULES[i]


def test_twenty_thousand_matches(table):
    docs = table(["mit license " * 20_000, "mit license " * 256, ""])
    padded = F.concat(F.lit(" "), spaced(lower_ascii(F.coalesce("text", F.lit("")))))
    rows = docs.select("doc_id", licenses.places(padded, " mit license(?= )").alias("at")).collect()
    got = {r["doc_id"]: [tuple(s) for s in r["at"]] for r in rows}
    assert got == {i: [(2 * k, 2 * k + 2) for k in range(n)] for i, n in enumerate([20_000, 256, 0])}
    sizes = licenses.scan(docs).select("row.doc_id", F.size("detections")).collect()
    assert {r[0]: r[1] for r in sizes} == {0: 20_000, 1: 256, 2: 0}
