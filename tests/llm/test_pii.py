import re

import numpy as np
from llm_odd import DATA, ODD, table  # noqa: F401

from tidewatch.llm import pii

TEXTS = [
    *ODD,
    "mail a.b@c.d.e-f, and x@y no, @z.q no; a@b.c_d@e.f",
    "ip 1.2.3.4 and 256.1.1.1 and 1.2.3.4.5.6.7.8 and 0001.02.3.255",
    "card 4539 5787 6362 1486 or 4539-5787-6362-1486 bad 1234 5678 9012 3456, +1 (415) 555-2671 +12",
    "9" * 5000,
    "+1 2 3 4 5 6 7 8 9 0 1 2 3 4 5 6 7 8 and +44 20 7946 0958",
]


def brute(text):
    digits = lambda s: re.sub("[^0-9]", "", s)
    out = [(0, *m.span()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text):
        if all(len(p.lstrip("0")) <= 3 and int(p) <= 255 for p in m[0].split(".")):
            out.append((1, *m.span()))
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        d = digits(m[0])
        total = sum(sum(divmod(int(c) * (1 + i % 2), 10)) for i, c in enumerate(d[::-1]))
        if 16 <= len(d) <= 19 and total % 10 == 0:
            out.append((2, *m.span()))
    out += [(3, *m.span()) for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text) if 8 <= len(digits(m[0])) <= 15]
    return out


def test_base_spans_against_brute_force(table):
    for text in TEXTS:
        assert pii.base_spans(text or "") == brute(text or "")
    rows = pii.find(table(TEXTS), None).collect()
    assert all(r["base"] == r["spans"] for r in rows) and len(rows) == len(TEXTS)


def test_gradients_against_differences():
    model = pii.Tagger(hidden=3, vector=2)
    for k in model.p:
        model.p[k] = model.p[k].astype(np.float64)
    rng = np.random.default_rng(1)
    x, y = rng.integers(0, 90, (3, 7)), rng.integers(0, pii.TAGS, (3, 7))
    _, g = model._gradients(x, y)
    for k, v in model.p.items():
        place = tuple(int(i) for i in rng.integers(0, v.shape)) if k != "vectors" else (int(x[0, 0]), 1)
        keep, e = v[place], 1e-3
        v[place] = keep + e
        up = model._gradients(x, y)[0]
        v[place] = keep - e
        down = model._gradients(x, y)[0]
        v[place] = keep
        assert abs((up - down) / (2 * e) - g[k][place]) < 2e-4, k


def test_held_out_accuracy(spark):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    x, y = pii.labelled_windows(docs, most=700)
    assert len(x) > 300
    half = len(x) * 2 // 3
    model = pii.train(x[:half], y[:half])
    right = spans = 0
    for classes, tags in zip(x[half:], y[half:]):
        n = int((classes < pii.CLASSES).sum())
        got = model.decode(model.scores(classes[None])[0][:n])
        spans += len(want := set(pii.spans_of(tags[:n], 0)))
        right += len(want & set(pii.spans_of(got, 0)))
    assert right >= 0.9 * spans


def test_windows_are_reconciled():
    model = pii.Tagger()
    text = "x" * 200
    whole = model.tagged([text])[0]
    assert len(whole) == 200
    assert pii.spans_of(pii.tags([(1, 3, 9), (3, 9, 12)], 0, 20), 0) == [(1, 3, 9), (3, 9, 12)]


def test_empty_table(table):
    x, y = pii.labelled_windows(table(["no anchor"]))
    assert pii.train(x, y) is None
    assert pii.find(table(["a"]).where("false"), None).count() == 0


def test_added_spans_leave_base_alone(spark):
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    model = pii.train(*pii.labelled_windows(docs), steps=40)
    for row in pii.find(docs, model).collect():
        assert {tuple(b) for b in row["base"]} <= {tuple(s) for s in row["spans"]}


def test_copies_of_a_window_count_once(table):
    footer = "contact the office at office@example.com for more"
    own = [f"write to person{k}@mail{k}.example.org about matter {k}" for k in range(9)]
    x, y = pii.labelled_windows(table([footer] * 60 + own * 2), most=10)
    assert len(x) == len({row.tobytes() for row in x}) == 10 and len(y) == 10
    more, _ = pii.labelled_windows(table([footer, *own]), most=50)
    assert sorted(r.tobytes() for r in more) == sorted(r.tobytes() for r in x)


def test_long_runs_of_digits_take_linear_time():
    run, rest = "9" * 1_000_000, f" 1.2.3.4 {'1.' * 1000}"
    assert pii.base_spans(run + rest) == [(kind, len(run) + s, len(run) + e) for kind, s, e in brute(rest)]
