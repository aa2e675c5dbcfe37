import hashlib
import math

import duckdb
import numpy as np
import pytest

from chronopanel.llm import vector_codes as V
from chronopanel.llm.queries import op13_vector_codes

from .helpers import save

SCHEMA = "vec_id long, embedding array<float>, label int, code string, _k long, i long"


def embeddings(spark, rows):
    return spark.createDataFrame([(i, v, lab, "c", 1, 2) for i, v, lab in rows], SCHEMA)


def brute(rows, parts=8, entries=16, rounds=6, scale=4096):
    kept = [(i, [math.floor(scale * float(np.float32(c))) for c in v], lab) for i, v, lab in rows
            if v is not None and None not in v and all(math.isfinite(c) for c in v)]
    kept.sort(key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    if not kept:
        return [], None
    w = len(kept[0][1]) // parts
    cut = [[x[p * w: (p + 1) * w] for p in range(parts)] for _, x, _ in kept]
    books = [[c[p] for c in cut[:entries]] for p in range(parts)]

    def nearest(book, x):
        return min((sum((a - b) ** 2 for a, b in zip(x, e)), k) for k, e in enumerate(book))

    for _ in range(rounds):
        for p in range(parts):
            groups = {}
            for c in cut:
                groups.setdefault(nearest(books[p], c[p])[1], []).append(c[p])
            books[p] = [[sum(v) // len(groups[k]) for v in zip(*groups[k])] if k in groups else e for k, e in enumerate(books[p])]
    out, by = [], {}
    for (i, _, lab), c in zip(kept, cut):
        got = [nearest(books[p], c[p]) for p in range(parts)]
        err = sum(g[0] for g in got)
        by[lab] = by.get(lab, 0) + err
        out.append((i, "".join(f"{g[1]:02x}" for g in got), err, lab))
    sha = hashlib.sha256(",".join(str(v) for b in books for e in b for v in e).encode()).hexdigest()
    return [(i, code, err, by[lab], sha) for i, code, err, lab in out], books


def table(n=300, d=16, seed=2):
    rng = np.random.default_rng(seed)
    centre = rng.standard_normal((6, d))
    v = centre[rng.integers(0, 6, n)] + rng.standard_normal((n, d)) * 0.2
    return [(1000 - i, [float(np.float32(c)) for c in r], None if i % 11 == 0 else i % 5) for i, r in enumerate(v)]


def same(out, rows):
    key = lambda r: (r[0] is None, r[0] or 0, r[1:])
    assert sorted((tuple(r) for r in out), key=key) == sorted(brute(rows)[0], key=key)


def awkward():
    rows = table()
    rows += [(5, None, 1), (6, [None] + [0.0] * 15, 1), (7, [float("nan")] * 16, 1), (8, [float("-inf")] + [0.0] * 15, None)]
    rows += [(None, rows[3][1], 2), (1000, rows[4][1], 2), (1000, rows[5][1], 2)]   # no id, a repeated id
    return rows + [(2000 + i, rows[0][1], 9) for i in range(150)]                    # a third of the rows share vector and label


def test_codes_against_brute_force_and_sql(spark, tmp_path):
    rows = awkward()
    out = op13_vector_codes(spark, save(embeddings(spark, rows).repartition(5), tmp_path, "embeddings"))
    assert out.columns == ["vec_id", "code", "error", "label_error", "codebooks_sha256"]
    got = out.collect()
    same(got, rows)
    con = duckdb.connect()
    con.execute(f"CREATE VIEW embeddings AS SELECT * FROM '{tmp_path}/embeddings.parquet/*.parquet'")
    key = lambda r: (r[0] is None, r[0] or 0, r[1:])
    assert sorted(con.execute(V.SQL).fetchall(), key=key) == sorted((tuple(r) for r in got), key=key)


def test_many_labels_are_joined_in_salted_copies(spark, monkeypatch):
    monkeypatch.setattr(V, "sized", lambda df: df)
    rows = awkward()
    out = V.with_group_sums(V.written(V.code(embeddings(spark, rows), V.codebooks(embeddings(spark, rows)), keep=["label"]), "t"), "label", "error", "label_error")
    want = sorted((r[1:4] for r in brute(rows)[0]))
    assert sorted((r["code"], r["error"], r["label_error"]) for r in out.collect()) == want
    monkeypatch.setattr(V, "sized", lambda df: df.hint("shuffle_hash"))
    same_keys = V.with_group_sums(out.drop("label_error"), "label", "error", "label_error")
    assert sorted((r["code"], r["error"], r["label_error"]) for r in same_keys.collect()) == want


def test_cells_leave_no_nearest_entry_out():
    rng = np.random.default_rng(0)
    for trial in range(60):
        w, k = int(rng.integers(1, 6)), int(rng.integers(1, 17))
        book = rng.integers(-40, 40, (k, w))
        memo = V.CellMemo(book)
        x = rng.integers(-60, 60, (200, w))
        x[:20] = book[rng.integers(0, k, 20)]              # ties and exact hits
        d = ((x[:, None, :] - book[None]) ** 2).sum(2)
        for part in (x[:50], x):                            # cells are new, then remembered
            best, error = memo.nearest(part)
            assert (best == d[: len(part)].argmin(1)).all() and (error == d[: len(part)].min(1)).all()
        assert memo.evaluated <= 250 * k
    memo = V.CellMemo(np.array([[0, 0], [100, 100]]))
    memo.nearest(rng.integers(-5, 5, (100, 2)))
    assert memo.evaluated < 200                             # the far entry is not evaluated


def test_memo_starts_anew_and_wide_numbers_stay_exact(monkeypatch):
    monkeypatch.setattr(V, "MEMO_CELLS", 5)
    rng = np.random.default_rng(1)
    book = rng.integers(-(1 << 45), 1 << 45, (7, 3))
    x = rng.integers(-(1 << 45), 1 << 45, (100, 3))
    want = [min((sum((int(a) - int(b)) ** 2 for a, b in zip(r, e)), k) for k, e in enumerate(book)) for r in x]
    best, error = V.CellMemo(book, wide=True).nearest(x)
    assert [(e, k) for e, k in zip(error.tolist(), best.tolist())] == want


def test_small_and_empty_tables(spark):
    run = lambda rows: V.coded_embeddings(spark, embeddings(spark, rows)).collect()
    assert run([]) == [] and run([(1, None, 2)]) == []
    few = table(5, 8)
    same(run(few), few)
    equal = [(i, [1.0] * 8, None) for i in range(20)]       # equal entries: the first takes all
    same(run(equal), equal)
    with pytest.raises(ValueError, match="equal parts"):
        run([(1, [1.0] * 9, 1)])
    with pytest.raises(Exception, match="different numbers of components"):
        run([(1, [1.0] * 8, 1), (2, [1.0] * 16, 1)])
    huge = [(i, [float(2 ** 35 + i)] * 8, 1) for i in range(3)]
    same(run(huge), huge)
