import re

from llm_odd import ODD, table  # noqa: F401
from pyspark.sql import functions as F

from tidewatch.llm import decontaminate as d
from tidewatch.llm.text import n_words

ITEM = "one two three four five six seven eight nine ten eleven twelve thirteen fourteen fifteen"
SHORT = "alpha beta gamma"
ITEMS = [(1, ITEM), (2, SHORT), (3, None), (4, " .,"), (5, ITEM.upper()), (6, "solo"), (7, "x y x y x y x y x y x y x y x")]
TEXTS = [
    *ODD,
    f"start {ITEM} end",
    "Alpha, BETA -- gamma!",
    f"{SHORT} {SHORT} other {SHORT}",
    "one two three four five six seven eight nine ten eleven twelve",
    f"k {ITEM} l m {ITEM.title()} n",
    "x y " * 20,
    "solo solo and more words " + "z " * 60,
]


def words(text):
    lower = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower)


def brute(text):
    tokens, hit, items = words(text), set(), set()
    for item, item_text in ITEMS:
        w = words(item_text)
        n = min(13, len(w))
        for i in range(len(w) - n + 1 if w else 0):
            for k in range(len(tokens) - n + 1):
                if tokens[k : k + n] == w[i : i + n]:
                    hit |= set(range(k, k + n))
                    items.add(str(item))
    return len(tokens), len(hit), sorted(items)


def found(judged):
    rows = judged.select(
        F.col("row.doc_id"), n_words(F.col("spaced")), d.n_hit(), F.flatten(F.transform("hits", lambda h: h["items"]))
    ).collect()
    return {r[0]: (r[1], r[2], sorted(set(r[3]))) for r in rows}


def test_hits_on_both_ways(spark, table):
    items = spark.createDataFrame(ITEMS, "item_id bigint, text string")
    want = {i: brute(t) for i, t in enumerate(TEXTS)}
    assert found(d.with_hits(table(TEXTS), items)) == want
    assert found(d.with_hits(table(TEXTS), items, max_windows=0)) == want


def test_no_items_no_documents(spark, table):
    items = spark.createDataFrame(ITEMS, "item_id bigint, text string")
    assert all(not r["hits"] for r in d.with_hits(table(TEXTS), items.where("false")).collect())
    assert d.drop_contaminated(table(TEXTS).where("false"), items).count() == 0


def test_drop_and_remove(spark, table):
    items = spark.createDataFrame(ITEMS[:2], "item_id bigint, text string")
    docs = table([f"keep {ITEM} this, " + "w " * 400, f"a {ITEM}", "clean text", None])
    kept = d.drop_contaminated(docs, items)
    assert kept.columns == docs.columns
    # 15 words of 417 are under a twentieth.
    assert sorted(r["doc_id"] for r in kept.collect()) == [0, 2, 3]
    removed = {r["doc_id"]: r["text"] for r in d.remove_spans(docs, items).collect()}
    assert removed[2] == "clean text" and removed[3] is None
    assert "seven" not in removed[0] and removed[0].startswith("keep ") and "this, w" in removed[0]
    assert removed[1].strip() == "a"


def test_items_without_an_id_on_both_ways(spark, table):
    items = spark.createDataFrame([(None, ITEM), (None, SHORT), (3, SHORT), (None, "solo")], "item_id bigint, text string")
    want = {i: brute(t)[:2] for i, t in enumerate(TEXTS)}
    want[len(ODD) + 5] = (40, 0)  # no item of x and y here
    one, two = (found(d.with_hits(table(TEXTS), items, max_windows=m)) for m in (d.MAX_WINDOWS, 0))
    assert one == two and {i: w[:2] for i, w in one.items()} == want
    assert {i for i, w in one.items() if w[2] == ["3"]} == {len(ODD) + 1, len(ODD) + 2}
    for m in (d.MAX_WINDOWS, 0):
        kept = d.drop_contaminated(table(TEXTS), items, max_windows=m)
        assert {r["doc_id"] for r in kept.collect()} == {i for i, (n, hit) in want.items() if not hit or 20 * hit < n}


def test_kept_documents(spark, table):
    items = spark.createDataFrame([(None, ITEM), (2, SHORT)], "item_id bigint, text string")
    docs = table([f"keep {ITEM} this, " + "w " * 400, f"a {ITEM}", "clean text", None])
    for m in (d.MAX_WINDOWS, 0):
        kept = d.drop_contaminated(docs, items, max_windows=m)
        assert sorted(r["doc_id"] for r in kept.collect()) == [0, 2, 3]
