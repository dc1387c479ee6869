import random

import numpy as np
from llm_odd import ODD, table  # noqa: F401

from tidewatch.llm import near_duplicates as nd

r = random.Random(4)
VOCABULARY = [f"w{i}" for i in range(3000)]


def words(n):
    return [r.choice(VOCABULARY) for _ in range(n)]


def edited(base, n):
    out = list(base)
    for at in r.sample(range(len(out)), n):
        out[at] = r.choice(VOCABULARY) + "x"
    return out


def texts():
    out = list(ODD[:-1])
    hot = words(120)
    out += [" ".join(edited(hot, k % 5)) for k in range(60)]  # near copies at many distances
    chain = words(200)
    for _ in range(12):  # neighbours are similar, the ends are not
        chain = edited(chain, 3)
        out.append(" ".join(chain))
    out += [" ".join(words(50)) for _ in range(20)]
    shared = words(60)
    out += [" ".join(shared + words(60)) for _ in range(15)]  # a common passage, below the threshold
    out += ["A b C d", "a B c D", "a b c d e", "a b c d e f", "A  B\nc d\te"]
    return out


def brute(rows):
    sets = {}
    for i, text in rows:
        tokens = (text or "").encode().lower().split()
        sets[i] = {tuple(tokens[k : k + 5]) for k in range(max(1, len(tokens) - 4))} if tokens else set()
    parent = {i: i for i in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    ids = sorted(sets)
    for k, a in enumerate(ids):
        for b in ids[k + 1 :]:
            both = len(sets[a] & sets[b])
            if both and 100 * both >= 75 * (len(sets[a]) + len(sets[b]) - both):
                x, y = find(a), find(b)
                parent[max(x, y)] = min(x, y)
    return {i: (len(sets[i]), find(i)) for i in ids}


def test_components_against_all_pairs(table):
    rows = list(enumerate(texts()))
    r.shuffle(rows)
    docs = table([t for _, t in rows], [i for i, _ in rows])
    got = {x["doc_id"]: (x["n_shingles"], x["component"]) for x in nd.with_components(docs).collect()}
    assert got == brute(rows)


def test_keep_one_and_edges(table):
    docs = table(["same text", "same text", None, "", "x y", "X Y", "x y"], [3, 1, 2, 5, None, 7, 7])
    kept = nd.keep_one_of_each(docs)
    assert kept.columns == docs.columns
    assert sorted(str(x["doc_id"]) for x in kept.collect()) == ["1", "2", "5", "7", "7", "None"]
    assert nd.keep_one_of_each(docs.where("false")).count() == 0
    assert nd.with_components(table([None, ""])).count() == 2


def test_signature_estimates_similarity():
    a = np.unique(np.random.default_rng(1).integers(0, 2**63, 1000).astype(np.uint64))
    b = np.concatenate([a[:900], np.random.default_rng(2).integers(0, 2**63, 100).astype(np.uint64)])
    one, two = (nd.band_keys(x, bands=512, rows=1) for x in (a, b))
    assert abs((one == two).mean() - 900 / 1100) < 0.06
    assert (nd.band_keys(a) == nd.band_keys(a.copy())).all()
