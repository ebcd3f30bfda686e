"""Operator 9 against brute-force alignment."""

import random
import re

from voxlake.llm import decontaminate as D

WORDS = re.compile(rb"[0-9A-Za-z\x80-\xff]+")


def words(text):
    return WORDS.findall((text or "").lower().encode())


def brute_score(item, doc):
    if not item:
        return 0.0
    up, best = [0] * (len(doc) + 1), 0
    for w in item:
        now = [0]
        for j, v in enumerate(doc, 1):
            now.append(max(0, up[j - 1] + (2 if w == v else -1), up[j] - 1, now[-1] - 1))
        best, up = max(best, max(now)), now
    return best / (2 * len(item))


def edited(rng, text, rate):
    out = []
    for w in text.split():
        x = rng.random()
        if x < rate:
            out += rng.choice(([], ["zzq"], [w, "extra"]))
        else:
            out.append(w)
    return " ".join(out)


def fixture():
    rng = random.Random(8)
    vocab = ["".join(rng.choice("aeioustrn") for _ in range(rng.randint(2, 6))) for _ in range(150)] + ["été", "x2"]
    text = lambda n: " ".join(rng.choice(vocab) for _ in range(n))
    items = [(i, text(rng.randint(8, 50))) for i in range(25)] + [(30, "zwei worte"), (31, None), (32, ""), (None, text(9)), (5, text(20))]
    docs = [(i, text(rng.randint(1, 300))) for i in range(60)]
    for i in range(60, 160):
        item = rng.choice(items[:25])[1]
        docs.append((i, f"{text(rng.randint(0, 200))} {edited(rng, item, rng.choice((0, 0.05, 0.15)))}, {text(rng.randint(0, 80))}"))
    return items, docs + [(200, None), (201, ""), (202, "so zwei, WORTE hier"), (None, items[0][1]), (203, items[1][1].upper().replace(" ", ".\n"))]


def test_against_brute_force(spark):
    items, docs = fixture()
    d = spark.createDataFrame(docs, "doc_id long, text string").selectExpr("*", "1 as score", "2 as start").repartition(4)
    b = spark.createDataFrame(items, "item_id long, text string").selectExpr("*", "3 as doc_id")
    got = {(r.doc_id, r.item_id): r.score for r in D.leaks(d, b).collect()}
    want = {}
    for i, t in docs:
        for j, u in items:
            if i is not None and j is not None:
                s = brute_score(words(u), words(t))
                if s >= D.THRESHOLD:
                    want[i, j] = max(s, want.get((i, j), 0))
    assert set(got) == set(want) and all(abs(got[k] - want[k]) < 1e-9 for k in got)
    for block in (1, 7):
        assert {(r.doc_id, r.item_id): r.score for r in D.leaks(d, b, block=block).collect()} == got


def test_items_of_one_stem(spark):
    """Items that share most of their words: all links, however the items are put into blocks."""
    word = lambda k, n: [f"w{k}x{i}" for i in range(n)]
    stem = word("stem", 21)
    items = [(i, " ".join(stem + word(i, 8))) for i in range(8)]
    docs = [(i, " ".join(word(f"d{i}", 30) + stem + word(f"e{i}", 30))) for i in range(8)]
    d, b = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    for block in (1, 3, 8):
        assert sorted((r.doc_id, r.item_id, r.score) for r in D.leaks(d, b, block=block).collect()) == [(i, j, 21 / 29) for i in range(8) for j in range(8)]


def test_ties_and_very_long_text(spark):
    item = "alpha beta gamma delta epsilon zeta eta theta"
    text = "filler words " * 150_000 + item + " and more " + item
    d = spark.createDataFrame([(1, text)], "doc_id long, text string")
    r = D.leaks(d, spark.createDataFrame([(1, item)], "item_id long, text string")).collect()
    assert [(x.start, x.end, x.score) for x in r] == [(1_950_000, 1_950_000 + len(item), 1.0)]


def test_spans_and_empty(spark):
    d = spark.createDataFrame([(1, "Vorher etwas. Der gute alte Text steht hier, ganz! Nachher.")], "doc_id long, text string")
    b = spark.createDataFrame([(7, "der gute alte text steht hier ganz")], "item_id long, text string")
    r = D.leaks(d, b).collect()[0]
    assert "Vorher etwas. Der gute alte Text steht hier, ganz! Nachher."[r.start : r.end] == "Der gute alte Text steht hier, ganz" and r.score == 1.0
    assert D.leaks(d.limit(0), b).count() == 0 and D.leaks(d, b.limit(0)).count() == 0


def test_every_passage_that_reaches_the_threshold(spark):
    """Items that share a long prompt, and heavily edited copies: all are found, with the scores of brute force."""
    rng = random.Random(4)
    word = lambda: "".join(rng.choice("bcdfglmaeiou") for _ in range(7))
    common = [word() for _ in range(12)]
    prompt = " ".join(word() for _ in range(38))
    items = [(i, f"{prompt} {word()} {word()}") for i in range(6)]
    items += [(10 + i, " ".join(rng.choice(common) if rng.random() < 0.4 else word() for _ in range(rng.randint(3, 40)))) for i in range(25)]
    noise = lambda n: " ".join(rng.choice(common) if rng.random() < 0.5 else word() for _ in range(n))
    docs = [(0, f"{noise(20)} {items[0][1].rsplit(' ', 1)[0]} other {noise(9)}"), (1, f"{noise(5)} {prompt} two others {noise(9)}")]
    docs += [(2, " x ".join(items[20][1].split())), (3, f"{noise(3)} " + " ".join(prompt.split()[:21]))]
    docs += [(10 + i, f"{noise(30)} {edited(rng, edited(rng, rng.choice(items)[1], 0.3), rng.choice((0, 0.2)))} {noise(30)}") for i in range(150)]
    d, b = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    want = {(i, j): s for i, t in docs for j, u in items if (s := brute_score(words(u), words(t))) >= D.THRESHOLD}
    assert {(0, 0), (1, 0), (1, 5), (2, items[20][0]), (3, 0)} <= set(want) and sum(s < 0.6 for s in want.values()) > 10
    assert {(r.doc_id, r.item_id): r.score for r in D.leaks(d, b).collect()} == want
