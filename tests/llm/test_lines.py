from collections import defaultdict

import pytest
from llm_odd import DATA, ODD, table  # noqa: F401

from tidewatch.llm import line_templates

LONG = "this boilerplate line of many plain words was written once and copied into every single page we have"
OWN = ["alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu {}".format("omega " * k) for k in range(1, 9)]


def texts_of(frame):
    return {r["doc_id"]: r["text"] for r in frame.collect()}


def test_recurring_lines_leave_the_first(table):
    docs = table([f"{OWN[k]}\n{LONG}\nown {k}" for k in range(4)] + [f"{LONG}", *ODD])
    got = line_templates.drop_recurring_lines(docs)
    assert got.columns == docs.columns
    kept = texts_of(got)
    assert kept[0] == f"{OWN[0]}\n{LONG}\nown 0"
    assert all(kept[k] == f"{OWN[k]}\nown {k}" for k in (1, 2, 3))
    assert kept[4] == ""
    assert [kept[5 + i] for i in range(len(ODD))] == ODD
    fallen = texts_of(line_templates.drop_recurring_lines(docs, drop_share=80))
    assert 4 not in fallen and len(fallen) == len(kept) - 1  # nothing of its own


def by_hand(docs, min_docs=3, min_docs_short=10):
    """Lines that stay of (key, text), by comparing every line's tokens outside each field."""
    where = defaultdict(list)
    for key, text in docs:
        for at, line in enumerate((text or "").split("\n")):
            w = line.encode().split()
            n = len(w)
            if n < 4:
                continue
            m = [b"<*>" if any(48 <= c <= 57 for c in x) else x for x in w]
            wide = 3 if n >= 12 else 4
            ends = [(2 * n // 3, n), (n // 3, 2 * n // 3)] if wide == 3 else [(n - n // 4, n), ((n - n // 4) // 2, (n - n // 4) // 2 + n // 4)]
            names = [(n, a, tuple(m[:a] + m[b:])) for a, b in ends if 2 * sum(x != b"<*>" for x in m[:a] + m[b:]) > n]
            if not names:
                names = [(n, -1, tuple(m if 2 * sum(x != b"<*>" for x in m) > n else w))]
            for name in names:
                where[name].append((key, at))
    gone, staying = set(), set()
    for name, places in where.items():
        if len({k for k, _ in places}) >= (min_docs if name[0] >= 12 else min_docs_short):
            gone |= set(places)
            staying.add(min(places))
    gone -= staying
    kept = {k: "\n".join(x for at, x in enumerate(t.split("\n")) if (k, at) not in gone) if t else t for k, t in docs}
    return kept, staying


@pytest.mark.parametrize("how", [{}, {"min_docs": 2, "min_docs_short": 2}])
def test_documents_by_hand(spark, how):
    docs = spark.read.parquet(f"{DATA}/documents.parquet").repartition(4)
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    want, _ = by_hand(rows, **how)
    assert texts_of(line_templates.drop_recurring_lines(docs, **how)) == want


def test_short_lines_have_a_field_behind_their_leading_tokens(table):
    names = ["alice", "bob", "carol", "dave", "erin", "frank", "grace", "heidi", "ivan", "judy", "ken"]
    texts = [f"{OWN[k % 8]} {n * 2}\nuser logged in from {n}\nthe account of {n} was closed again" for k, n in enumerate(names)]
    kept = texts_of(line_templates.drop_recurring_lines(table(texts)))
    assert sum("logged" in t for t in kept.values()) == 1 == sum("account" in t for t in kept.values())
    assert texts_of(line_templates.drop_recurring_lines(table(texts[:9]))) == dict(enumerate(texts[:9]))


@pytest.mark.parametrize("share", [None, 80])
def test_every_template_keeps_a_line(table, share):
    """Logs whose lines are nearly all dropped: the documents that hold what stays are never dropped themselves."""
    log = lambda k, n: f"error number {n} was seen by the disk service of host {k} at the usual place today"
    texts = ["\n".join([f"own line {'abc'[k]} of this log", *(log(k, n) for n in range(60))]) for k in range(3)]
    texts += ["\n".join([LONG, f"{LONG} once more", f"own {k}"]) for k in range(4)]
    kept = texts_of(line_templates.drop_recurring_lines(table(texts), drop_share=share))
    _, staying = by_hand(list(enumerate(texts)))
    assert staying
    for k, at in staying:
        assert texts[k].split("\n")[at] in kept[k].split("\n")
    assert sum("error number" in t for t in kept.values()) == 1
    assert len(kept) == (7 if share is None else 2)


def test_very_many_lines(table):
    """Work grows with the lines: 100,000 in each of three documents, half of them shared."""
    texts = ["\n".join(f"row {j if j % 2 else f'{j}{chr(97 + k)}'} " + "abcdefghij"[j % 10] * (1 + j // 10) for j in range(1000)) for k in range(3)]
    many = ["\n".join(["one line of many words that every one of the documents holds again and again", f"own {k} {k}"] * 50_000) for k in range(3)]
    kept = texts_of(line_templates.drop_recurring_lines(table(texts + many)))
    assert [kept[k] for k in range(3)] == texts
    assert kept[3].count("one line") == 1 and "one line" not in kept[4] and kept[5].count("own") == 50_000


def test_variable_fields(table):
    numbers = [f"order number {k} was sent to the customer on day {k}{k} of this very long year {OWN[k]}" for k in range(5)]
    tails = [f"{LONG} {' '.join(f'tail{chr(97 + k)}{chr(97 + j)}' for j in range(9))}" for k in range(5)]
    middles = [" ".join(["lead"] * 6 + [f"m{chr(97 + k)}{chr(97 + j)}" for j in range(6)] + ["end"] * 6) for k in range(5)]
    for lines in (tails, middles):
        docs = table([f"{line}\n{OWN[k]} {OWN[k + 1]}" for k, line in enumerate(lines)])
        kept = texts_of(line_templates.drop_recurring_lines(docs))
        assert sum(line in kept[k] for k, line in enumerate(lines)) == 1, lines
    masked = table([f"{n.split(' alpha')[0]}\n{OWN[k]} x{k}" for k, n in enumerate(numbers)])
    kept = texts_of(line_templates.drop_recurring_lines(masked))
    assert sum("order number" in t for t in kept.values()) == 1


def test_too_few_documents_and_short_lines(table):
    docs = table([f"{LONG}\na b c\n{OWN[0]}", f"{LONG}\na b c", "a b c", "a b c\n" * 20])
    assert texts_of(line_templates.drop_recurring_lines(docs)) == texts_of(docs)
    assert line_templates.drop_recurring_lines(docs.where("false")).count() == 0


def test_missing_and_repeated_keys(table):
    docs = table([f"{LONG}\n{OWN[k]} own" for k in range(5)], [None, 3, 3, 4, 5])
    kept = line_templates.drop_recurring_lines(docs)
    assert kept.count() == 5
    assert [r["doc_id"] for r in kept.collect() if LONG in r["text"]] == [None]


def test_rows_of_numbers_are_compared_unmasked(table):
    row = lambda k, n: " ".join(str(1000 * k + 7 * j) for j in range(n))
    measured = lambda k: f"temp {k}.5 humidity 4{k} wind {k} pressure 10{k} rain 0.{k} sun {k}h"
    texts = [f"{row(k, 5)}\n{row(k + 50, 14)}\n{measured(k)}\n{row(k + 90, 5)}" for k in range(12)]
    assert texts_of(line_templates.drop_recurring_lines(table(texts))) == dict(enumerate(texts))
    same = [f"{OWN[k % 8]} x{'y' * k}\n{row(1, 5)}" for k in range(12)]
    kept = texts_of(line_templates.drop_recurring_lines(table(same)))
    assert sum(row(1, 5) in t for t in kept.values()) == 1 and len(kept) == 12
    stamped = [f"{OWN[k % 8]} x{'y' * k}\nerror {k} of the disk at 1{k}:00 was seen" for k in range(12)]
    assert sum("disk" in t for t in texts_of(line_templates.drop_recurring_lines(table(stamped))).values()) == 1
