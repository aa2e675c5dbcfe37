import random

from chronopanel.llm import decontaminate as D

from .helpers import AWKWARD, documents, words


def shingles(text):
    w = words((text or "").lower())
    return {tuple(w[i:i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())


def brute(docs, items):
    d, q = {}, {}
    for rows, into in ((docs, d), (items, q)):
        for i, t in rows:
            if i is not None:
                into.setdefault(i, set()).update(shingles(t))
    return sorted((i, j, len(s & t), len(t)) for i, s in d.items() for j, t in q.items() if t and 100 * len(s & t) >= 75 * len(t))


def run(spark, docs, items):
    d = documents(spark, [(i, t, None, None) for i, t in docs])
    b = spark.createDataFrame([(i, t, 1, "x") for i, t in items], "item_id long, text string, h int, need string")
    return sorted((r["doc"], r["item"], r["n_common"], r["q"]) for r in D.leaks(d, b).collect())


def test_random_overlaps_against_brute_force(spark):
    g = random.Random(2)
    vocabulary = [f"w{i}" for i in range(300)]
    items = [(i, " ".join(g.choices(vocabulary, k=g.choice([6, 9, 14, 40, 90])))) for i in range(25)]
    docs = []
    for i in range(80):
        body = g.choices(vocabulary, k=g.randint(0, 400))
        if i % 2:
            w = g.choice(items)[1].split()
            for _ in range(g.randint(0, 3)):
                w[g.randrange(len(w))] = "changed"
            cut = g.randint(0, len(w) // 3)
            body[len(body) // 2: len(body) // 2] = w[cut:] if g.random() < .5 else w
        docs.append((i, " ".join(body)))
    got = run(spark, docs, items)
    assert got == brute(docs, items) and len(got) > 10


def test_awkward_rows(spark):
    items = [(0, "ONE two three four five six seven"), (1, None), (2, ""), (3, "short text"), (3, "short text"), (4, "same row"), (None, "no id here"),
             (5, "never seen words at all here"), (6, "a b c d e f g"), (6, "one two three four five six")]
    docs = [(i, t) for i, t, *_ in AWKWARD]
    assert run(spark, docs, items) == brute(docs, items)


def test_empty_tables(spark):
    docs = [(i, t) for i, t, *_ in AWKWARD]
    empty = documents(spark).limit(0)
    items = spark.createDataFrame([(1, "a b c d e f")], "item_id long, text string")
    assert D.leaks(empty, items).collect() == []
    assert D.leaks(documents(spark, [(i, t, None, None) for i, t in docs]), items.limit(0)).collect() == []


def test_no_python_in_the_plan(spark):
    items = spark.createDataFrame([(1, "a b c d e f")], "item_id long, text string")
    plan = D.leaks(documents(spark), items)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Cartesian" not in plan and "NestedLoop" not in plan


def test_without_broadcast(spark, monkeypatch):
    monkeypatch.setattr(D, "BROADCAST_ROWS", 0)
    items = [(0, "one two three four five six seven")]
    docs = [(i, t) for i, t, *_ in AWKWARD]
    assert run(spark, docs, items) == brute(docs, items)
