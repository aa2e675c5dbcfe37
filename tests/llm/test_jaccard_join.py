import random

import numpy as np

from chronopanel.llm import jaccard_join as J

from .helpers import AWKWARD, documents, link_components, shingle_set


def corpus(seed=1, n=150):
    g = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(400)]
    passage = g.choices(vocabulary, k=40)
    out = []
    for i in range(n):
        kind = i % 5
        if kind == 0 or not out:
            w = g.choices(vocabulary, k=g.randint(3, 200))
        elif kind == 1:
            w = passage + g.choices(vocabulary, k=g.randint(0, 60))
        else:
            w = g.choice(out)[1].split()
            for _ in range(g.randint(0, max(1, len(w) // 25))):
                w[g.randrange(len(w))] = g.choice(vocabulary)
            w = w[: len(w) - g.randint(0, len(w) // 20)] or w
        out.append((i, " ".join(w)))
    return out


def run(spark, rows, **how):
    return J.near_components(documents(spark, [(i, t, None, None) for i, t in rows]), **how).collect()


def check(rows, got):
    comps = link_components(rows)
    assert sorted(((r["doc_id"] is None, r["doc_id"] or 0), r["n_shingles"], r["component_id"] is None or r["component_id"]) for r in got) == sorted(
        ((i is None, i or 0), len(shingle_set(t)), i is None or comps[i]) for i, t in rows)


def test_against_brute_force(spark):
    for seed in (1, 2):
        rows = corpus(seed)
        got = run(spark, rows)
        check(rows, got)
        assert len({r["component_id"] for r in got}) < len(rows) - 20


def test_large_cells_are_split_exactly(spark, monkeypatch):
    """With tiny units every cell goes through the pivots' balls and blocks."""
    monkeypatch.setattr(J, "CELL_DOCS", 3)
    rows = corpus(3, 120)
    check(rows, run(spark, rows, unit=150))


def test_large_cell_without_its_pivot(spark, monkeypatch):
    """The pivots 0 to 9 are halves of longer texts: they share regions with
    them, but the slices tell them apart and they leave their cells."""
    monkeypatch.setattr(J, "FREQUENT", 10 ** 6)
    rows = []
    for k in range(10):
        base = [f"b{k}x{i}" for i in range(100)]
        rows.append((k, " ".join(base[:50])))
        rows += [(100 + 10 * k + i, " ".join([*base[:90], f"x{i}", *base[91:]])) for i in range(4)]
    check(rows, run(spark, rows, unit=150))


def test_cells_use_one_centre(spark):
    """Members without their pivot, and a centre whose id has two texts."""
    g = np.random.default_rng(5)
    x, y = (np.sort(g.integers(0, 2 ** 63, 100).astype(np.uint64)) for _ in range(2))
    sets = {1: [x, y], 2: [x], 3: [y], 4: [np.sort(g.integers(0, 2 ** 63, 100).astype(np.uint64))]}
    members = spark.createDataFrame([(0, d, 100) for d in sets], "pivot long, doc long, n long")
    rows = spark.createDataFrame([(d, bytearray(s.tobytes())) for d, ss in sets.items() for s in ss], "doc long, set binary")
    got = J.components(J.join_cells(members, rows, unit=150)).collect()
    assert {r["node"]: r["component"] for r in got} == {2: 1, 3: 1}
    links, _ = J.split_large(members, rows, 150)
    assert {(r["a"], r["b"]) for r in links.collect()} in ({(1, 2)}, {(1, 3)})


def test_one_hot_group(spark):
    g = random.Random(9)
    base = [f"b{i}" for i in range(80)]
    rows = []
    for i in range(250):
        w = list(base)
        for _ in range(g.randint(0, 5)):
            w[g.randrange(80)] = f"x{g.randrange(10 ** 6)}"
        rows.append((i, " ".join(w)))
    check(rows, run(spark, rows))


def test_awkward_rows(spark):
    rows = [(i, t) for i, t, *_ in AWKWARD] + [(40, "Same ROW"), (41, "ends differ a b c"), (41, "one two three four five six seven eight nine ten eleven twelve")]
    check(rows, run(spark, rows))


def test_id_with_a_copied_and_a_unique_text(spark):
    one, two = ([f"{k}{i}" for i in range(60)] for k in "ab")
    rows = [(3, " ".join(one)), (5, " ".join(one)), (5, " ".join(two)), (9, " ".join([*two, "more"])), (12, " ".join(two[1:]))]
    got = run(spark, rows)
    check(rows, got)
    assert {r["component_id"] for r in got} == {3}


def test_empty_table(spark):
    assert J.near_components(documents(spark).limit(0)).collect() == []


def test_prefix_and_slices_lose_no_link():
    g = np.random.default_rng(3)
    for k in range(300):
        n = int(g.integers(1, 120 if k % 10 else 6000))
        x = np.unique(g.integers(0, 2 ** 63, n).astype(np.uint64) * np.uint64(2))
        keep = x[g.random(len(x)) < g.uniform(0.7, 1)]
        y = np.unique(np.r_[keep, g.integers(0, 2 ** 63, int(g.integers(0, 20))).astype(np.uint64) * np.uint64(2)])
        i = len(np.intersect1d(x, y))
        if i and 100 * i >= 75 * (len(x) + len(y) - i):
            often = np.sort(g.choice(x, min(len(x), 10), replace=False))
            rank = g.permutation(len(often))
            assert len(np.intersect1d(J.prefix(x, often, rank), J.prefix(y, often, rank)))
            assert J.possible(np.array([len(x), len(y)]), [J.slice_counts(s) for s in (x, y)]).all()


def test_slices_lose_no_nested_set():
    """A set inside another at the threshold, with half as many slices."""
    g = np.random.default_rng(6)
    for small, large, times in ((1000, 1333, 40), (1003, 1333, 40), (1600, 2133, 40), (16000, 21333, 5)):
        assert 100 * small >= 75 * large and J.n_slices(small) < J.n_slices(large)
        for _ in range(times):
            x = np.unique(g.integers(0, 2 ** 64, large, dtype=np.uint64))
            y = np.sort(g.choice(x, small, replace=False))
            assert len(x) == large and J.possible(np.array([small, large]), [J.slice_counts(s) for s in (y, x)]).all()


def test_components(spark):
    chain = [(i, i + 1) for i in range(1, 60)] + [(100, 101), (200, 100), (7, 3), (5, 5)]
    got = {r["node"]: r["component"] for r in J.components(spark.createDataFrame(chain, "a long, b long")).collect()}
    assert got == {**{i: 1 for i in range(2, 61)}, 101: 100, 200: 100}


def met_often(strangers=16, window=24):
    """A linked pair (100, 101), and strangers with smaller ids of which each
    shares another passage with both."""
    base = [f"b{i}" for i in range(strangers * window)]
    rows = [(k, " ".join([*(f"s{k}x{i}" for i in range(len(base) - window)), *base[k * window:(k + 1) * window]])) for k in range(strangers)]
    return rows + [(100, " ".join(base)), (101, " ".join([*base, "end"]))]


def units_moved(monkeypatch, run):
    """What ``run`` gives, and (unit, doc) of all sets that it moves."""
    found, write = [], J.written

    def watched(df, name, *how):
        out = write(df, name, *how)
        if name == "near-units":
            found.extend(out.collect())
        return out

    monkeypatch.setattr(J, "written", watched)
    monkeypatch.setattr(J, "FREQUENT", 10 ** 6)
    return run(), found


def test_a_pair_met_in_many_cells_moves_once(spark, monkeypatch):
    rows = met_often()
    got, moved = units_moved(monkeypatch, lambda: run(spark, rows))
    check(rows, got)
    assert sorted(r["doc"] for r in moved) == [100, 101]


def test_partners_of_all_cells_are_one_group(spark):
    near = spark.createDataFrame([(0, 5, 10, 5), (0, 6, 10, 5), (1, 6, 10, 6), (1, 7, 12, 6), (2, 8, 90, 8), (2, 9, 90, 8), (3, 8, 90, 8), (3, 9, 90, 8)],
                                 "pivot long, doc long, n long, mate long")
    assert sorted(J.gathered(near, 1000).collect()) == [(5, 5, 10), (5, 6, 10), (5, 7, 12), (8, 8, 90), (8, 9, 90)]
    # the sets of 8 and 9 are too many for one unit: their cells stay
    assert sorted(J.gathered(near, 100).collect()) == [(2, 8, 90), (2, 9, 90), (3, 8, 90), (3, 9, 90), (5, 5, 10), (5, 6, 10), (5, 7, 12)]


def test_partners_are_grouped():
    g = np.random.default_rng(2)
    x, y = (np.unique(g.integers(0, 2 ** 64, 200, dtype=np.uint64)) for _ in range(2))
    sets = [x, y, x[:-5], y[3:], np.unique(g.integers(0, 2 ** 64, 190, dtype=np.uint64)), x[4:]]
    got = J.partners(np.array([len(s) for s in sets]), [J.slice_counts(s) for s in sets])
    assert got[0] == got[2] == got[5] >= 0 and got[1] == got[3] >= 0 and got[0] != got[1] and got[4] == -1


def test_rare_words_first_loses_no_link():
    g = np.random.default_rng(4)
    linked = 0
    for k in range(300):
        x = np.unique(g.integers(0, 2 ** 63, int(g.integers(1, 200))).astype(np.uint64))
        y = np.unique(np.r_[x[g.random(len(x)) < g.uniform(0.7, 1)], g.integers(0, 2 ** 63, int(g.integers(0, 20))).astype(np.uint64)])
        i = len(np.intersect1d(x, y))
        if i and 100 * i >= 75 * (len(x) + len(y) - i):
            linked += 1
            both = np.union1d(x, y)
            cost, often = g.integers(0, 5, len(both)).astype(np.uint16), np.sort(g.choice(both, min(len(both), 10), replace=False))
            rank = g.permutation(len(often))
            first = [J.prefix(s, often, rank, cost[np.searchsorted(both, s)]) for s in (x, y)]
            assert [len(f) for f in first] == [len(x) // 4 + 1, len(y) // 4 + 1] and len(np.intersect1d(*first))
    assert linked > 100


def test_costs_belong_to_shingles(spark):
    """A shingle costs the same in every text, and one of rarer words less."""
    rows = [(i, "the of and to in " * 3 + f"rare{i} word{i} the of and") for i in range(40)]
    _, _, cost = J.frequent(J.describe(documents(spark, [(i, t, None, None) for i, t in rows]).select("doc_id", "text")))
    paid = {}
    for _, t in [*rows, (0, rows[3][1] + " in to"), (0, "the of"), (0, "")]:
        sets, costs = J.shingles(J.Words(J.pa.array([t]), lower=True), cost)
        assert np.array_equal(sets[0], J.Words(J.pa.array([t]), lower=True).shingle_sets(J.SHINGLE)[0])
        for s, c in zip(sets[0].tolist(), costs[0].tolist()):
            assert paid.setdefault(s, c) == c
    common, = J.shingles(J.Words(J.pa.array(["the of and to in"])), cost)[1][0]
    rare, = J.shingles(J.Words(J.pa.array(["in rare7 word7 the of"])), cost)[1][0]
    assert rare < common


def test_size_classes_lose_no_link(spark):
    small = np.r_[np.arange(1, 100_000), 3 * 10 ** np.arange(5, 9)]
    large = 4 * small // 3
    assert (J.size_class(large) - J.size_class(small) <= J.SIZE_STEPS + 1).all()
    base = [f"b{i}" for i in range(1000)]
    rows = [(k, " ".join(base[:n + 4])) for k, n in enumerate((3, 4, 9, 12, 16, 21, 30, 40, 53, 400, 300, 534, 900))]
    check(rows, run(spark, rows))
