from collections import Counter

from pyspark.sql import functions as F

from chronopanel.llm import quality_rules as Q

from .helpers import AWKWARD, documents, words


def base(text):
    w, t = words(text), text or ""
    lines = [x for x in t.split("\n") if words(x)]
    wins = Counter(tuple(w[i:i + 5]) for i in range(len(w) - 4))
    hit = {j for i in range(len(w) - 4) if wins[tuple(w[i:i + 5])] > 1 for j in range(i, i + 5)}
    n, sym, dup = len(w), sum(c in "#*$%&|<>" for c in t), len(lines) - len(set(lines))
    chars, failed = sum(map(len, w)), n < 10 or 100 * len(hit) > 20 * n
    bad = chars < 2 * n or chars > 15 * n or 100 * sym > 10 * chars or (dup >= 3 and 100 * dup > 30 * len(t.split("\n")))
    return (n, chars, sym, dup, len(hit), failed, not failed and not bad)


EXTRA = [
    (20, "a b c d e f a b c d e g h i j k l m", None, None),
    (21, "one two\n" * 12, None, None),
    (22, "x y z w v " * 400, None, None),
    (23, "### *** some words with a lot of $$$ symbols <> in || them %%% here &&&", None, None),
    (24, "a a a a a a a a a a a a", None, None),
]


def test_against_brute_force(spark):
    rows = AWKWARD + EXTRA
    out = Q.quality_table(documents(spark, rows)).collect()
    got = sorted(((r["doc_id"] is None, r["doc_id"]), tuple(r)[1:]) for r in out)
    assert got == sorted(((i is None, i), base(t)) for i, t, *_ in rows)


def test_order_does_not_change_the_verdict(spark):
    docs = documents(spark, AWKWARD + EXTRA)
    given = Q.rules()
    t = F.col("text")
    verdicts = [[r[0] for r in docs.select(Q.passes(t, Q.words(t), order)).collect()] for order in (given, given[::-1])]
    assert verdicts[0] == verdicts[1]
    assert [r[0] for r in docs.select(Q.cascade(docs)).collect()] == verdicts[0]


def test_order_by_rejections_per_cost():
    given = [Q.Rule(n, None) for n in "abc"]
    m = [{"rule": "a", "cost": 1.0, "rejects": 0.1}, {"rule": "b", "cost": 0.1, "rejects": 0.1}, {"rule": "c", "cost": 0.01, "rejects": 0.0}]
    assert [r.name for r in Q.ordered(given, m)] == ["b", "a", "c"]


def test_empty_table(spark):
    docs = documents(spark).limit(0)
    assert Q.quality_table(docs).collect() == []
    assert docs.where(Q.cascade(docs)).collect() == []


def test_no_python_in_the_plan(spark):
    plan = Q.quality_table(documents(spark))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Exchange" not in plan
