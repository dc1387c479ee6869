from llm_odd import DATA, ODD, table  # noqa: F401
from pyspark.sql import functions as F

from tidewatch.llm import quality_cascade as q
from tidewatch.llm.catalog import op9_quality

GOOD = " ".join(f"word{chr(97 + i % 26)}{chr(97 + i // 26)}" for i in range(60))


def test_order_changes_no_verdict(table):
    docs = table([*ODD, GOOD, GOOD + " !!! $$$", "x! " * 40, ("some words that repeat here all the time " * 9)])
    rules = q.default_rules()
    names = list(rules)
    one = docs.select(F.col("doc_id"), F.col("text")).transform(
        lambda d: q.with_words(d, "text").select("text", q.cascade(rules, names).alias("by"))
    )
    two = q.with_words(docs.select("text")).select("text", q.cascade(rules, names[::-1]).alias("by"))
    kept = lambda d: sorted(str(r["text"]) for r in d.where("by IS NULL").collect())
    assert kept(one) == kept(two) == sorted(str(r["text"]) for r in q.reject_low_quality(docs).collect())
    assert GOOD in kept(one)


def test_columns_stay_and_empty_tables(table):
    docs = table([GOOD, None])
    out = q.reject_low_quality(docs)
    assert out.columns == docs.columns and [r["doc_id"] for r in out.collect()] == [0]
    assert q.reject_low_quality(docs.where("false")).count() == 0


def test_repeated_words_against_brute_force(table):
    texts = [*ODD[:-1], "a b c d e f g h " * 2, "a b c d e f g h x a b c d e f g h", "q " * 20, "z y " * 9 + "end"]
    rows = q.with_words(table(texts).select("doc_id", "text"))
    got = {r[0]: r[1] for r in rows.select("text", q.n_repeated_words(F.col("spaced"))).collect()}
    for text in texts:
        tokens = [t for t in (text or "").replace("\n", " ").replace("\t", " ").split(" ") if t]
        windows = [tuple(tokens[i : i + 8]) for i in range(len(tokens) - 7)]
        hit = {i + k for i, w in enumerate(windows) if windows.count(w) > 1 for k in range(8)}
        assert got[text or ""] == len(hit), text


def test_ordering_prefers_rejections_per_cost(table):
    docs = table([GOOD] * 6 + ["x"] * 6).select("text")
    rules = {"never": F.col("text") == "nothing", "often": q.default_rules()["few_words"]}
    assert q.ordered_rules(docs, rules) == ["often", "never"]


def test_query_has_all_rows(spark):
    assert op9_quality(spark, DATA).count() == spark.read.parquet(f"{DATA}/documents.parquet").count()


def test_length_alone_rejects_nothing(table):
    # 200,000 words, 15,000 different ones: a share of 7.5 % over the whole text, of 60 % and more in any stretch.
    long = " ".join(f"w{(i * 7919 + i * i % 101) % 15_000}x" for i in range(200_000))
    poor = " ".join(f"w{i * i % 701}" for i in range(30_000))
    assert 10 * len(set(long.split())) < 200_000 and 10 * len(set(poor.split())) < 30_000
    docs = table([long, poor, GOOD])
    assert sorted(r["doc_id"] for r in q.reject_low_quality(docs).collect()) == [0, 2]


def test_distinct_words_against_brute_force(table):
    texts = [*ODD[:-1], "a b a b c c " * 7, "x " * 25, GOOD]
    rows = q.with_words(table(texts).select("text"))
    got = {r[0]: r[1] for r in rows.select("text", q.n_distinct_words(q.words(F.col("spaced")), 10)).collect()}
    for text in texts:
        tokens = [t for t in (text or "").replace("\n", " ").replace("\t", " ").split(" ") if t]
        assert got[text or ""] == sum(len(set(tokens[i : i + 10])) for i in range(0, len(tokens), 10)), text


def test_scripts_without_spaces(table):
    han = "".join(chr(0x4E00 + 37 * i % 900) for i in range(400)) + "。"
    thai = " ".join("".join(chr(0x0E01 + (k + 7 * i) % 40) for i in range(45)) for k in range(30))
    kana = "\n".join("".join(chr(0x3042 + (3 * k + i) % 70) for i in range(60)) for k in range(25))
    docs = table([han, thai, kana, "漢字", "x" * 900, " ".join(["y" * 40 + str(k) for k in range(30)])])
    assert sorted(r["doc_id"] for r in q.reject_low_quality(docs).collect()) == [0, 1, 2]
