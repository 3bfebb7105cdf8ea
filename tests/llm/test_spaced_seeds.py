"""Spaced masks alone must hit every leak: each window they need lies in the run that a leak leaves whole."""

import random

from cartolux.llm import leakage as L


def test_every_mask_fits_the_run_of_its_items():
    for n in range(1, 400):
        for k in {n // 10, n // 5}:
            key = L.weight(n, k)
            run = -(-(n - k) // (k + 1))
            assert all(len(m) == key and m[0] == m[-1] == "1" for m in L.MASKS[key])
            assert key == 1 or key <= run
            assert n < L.RUN or key <= L.RUN
    assert all("0" in m for key, ms in L.MASKS.items() if key >= 3 for m in ms)


def edited(words, k, draw):
    out = list(words)
    for _ in range(k):
        i = draw.randrange(len(out))
        how = draw.randrange(3)
        out[i : i + 1] = [[out[i] + "x"], [], [out[i], "put"]][how]
    return out


def test_against_brute_force(spark):
    """All pairs by brute force: leaks of runs of 14, 15 and 16 words and of whole items with as many changes as
    allowed and one more, in items of 1 to 60 words."""
    draw = random.Random(11)
    pool = [f"w{i}" for i in range(4000)]
    items = {i: [draw.choice(pool) for _ in range(n)] for i, n in enumerate([1, 2, 3, 4, 5, 6, 9, 10, 11, 12, 15, 19, 20, 29, 30, 39, 40, 50, 59, 60])}
    items[99] = items[0]
    docs = {}
    for i, w in items.items():
        k = len(w) // 10
        for j in range(14):
            body = edited(w, k + (j % 7 == 6), draw)
            if j >= 9 and len(w) >= 17:
                size = 14 + j % 3
                at = draw.randrange(len(w) - size + 1)
                body = w[at : at + size]
            docs[1000 * i + j] = [draw.choice(pool) for _ in range(draw.randrange(40))] + body + [draw.choice(pool) for _ in range(draw.randrange(40))]
    want = set()
    for d, doc in docs.items():
        for i, item in items.items():
            k = len(item) // 10
            run = any(f" {' '.join(item[a : a + 15])} " in f" {' '.join(doc)} " for a in range(len(item) - 14))
            if run or L.within_edits(doc, item, k):
                want.add((d, i))
    dd = spark.createDataFrame([(d, " ".join(w)) for d, w in docs.items()], "doc_id long, text string")
    ii = spark.createDataFrame([(i, " ".join(w)) for i, w in items.items()], "item_id long, text string")
    got = [tuple(r) for r in L.leaked(dd, ii).collect()]
    assert len(got) == len(set(got)) and set(got) == want and len(want) > 200


def test_one_word_item_in_many_documents(spark):
    docs = spark.range(3000).selectExpr("id AS doc_id", "repeat('alpha beta ', 40) AS text")
    items = spark.createDataFrame([(1, "Alpha"), (2, "gamma"), (3, "beta alpha")], "item_id long, text string")
    assert L.leaked(docs, items).groupBy("item_id").count().orderBy("item_id").collect() == [(1, 3000), (3, 3000)]


def test_soft_hyphens_and_decimals():
    assert L.words("exam­\n  ple and inter‐\nval") == ["example", "and", "interval"]
    assert L.changes("at 729.9 of " + "word " * 16) == 2 and L.changes(None) == 0
