import random

import corpus_pipeline as P

from .helpers import AWKWARD, documents, link_components, save
from .test_decontaminate import brute as leaks
from .test_jaccard_join import met_often, units_moved
from .test_quality_rules import base


def corpus():
    g = random.Random(8)
    vocabulary = ["".join(g.choices(["ka", "ti", "mo", "lu", "ren"], k=3)) for _ in range(300)]
    rows = [(i, " ".join(g.choices(vocabulary, k=g.randint(12, 120))), "aa", "s") for i in range(60)]
    rows += [(100 + i, rows[i][1] + " ende", "aa", "s") for i in range(20)]
    rows += [(200, "a b c d e " * 30, "aa", "s"), (201, "123 456", "aa", "s"), (202, rows[30][1], "aa", "s")]
    items = [(0, " ".join(rows[40][1].split()[:12])), (1, "nothing of this is anywhere in the corpus at all")]
    return rows, items


def stage(spark, name, rows, folder, items=()):
    spark.createDataFrame(list(items), "item_id long, text string").write.mode("overwrite").parquet(f"{folder}/benchmark.parquet")
    return dict(P.STAGES)[name](spark, documents(spark, rows, extra=False), str(folder))


def test_run_over_a_small_corpus(spark, tmp_path):
    rows, items = corpus()
    save(documents(spark, rows, extra=False), tmp_path)
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    out = P.run(spark, str(tmp_path)).collect()
    keep = [r for r in rows if any(c.isalpha() for c in r[1])]
    keep = [r for r in keep if base(r[1])[-1]]
    comps = link_components([r[:2] for r in keep])
    keep = [r for r in keep if comps[r[0]] == r[0]]
    bad = {d for d, *_ in leaks([r[:2] for r in keep], items)}
    assert bad == {40}
    assert sorted(r["doc_id"] for r in out) == sorted(r[0] for r in keep if r[0] not in bad)
    assert all(r["n_ids"] == len(r["ids"]) > 0 for r in out)


def test_stages_on_awkward_rows(spark, tmp_path):
    names = [n for n, _ in P.STAGES]
    columns = ["doc_id", "text", "lang", "source"]
    items = [(0, "ONE two three four five six seven"), (None, None)]
    for n in names[:-1]:
        out = stage(spark, n, AWKWARD, tmp_path, items)
        assert out.columns == columns
        ids = [r["doc_id"] for r in out.collect()]
        if n == "quality rules":
            assert sorted(map(str, ids)) == sorted(str(i) for i, t, *_ in AWKWARD if base(t)[-1])
        if n == "near duplicates":
            comps = link_components([r[:2] for r in AWKWARD])
            assert sorted(map(str, ids)) == sorted([str(i) for i in comps if comps[i] == i] + ["None"])
        if n == "decontamination":
            assert sorted(map(str, ids)) == sorted(str(i) for i, *_ in AWKWARD if i not in (0, 4))
    assert stage(spark, names[-1], AWKWARD, tmp_path).count() == len(AWKWARD)


def test_stages_on_an_empty_table(spark, tmp_path):
    for n, _ in P.STAGES:
        assert stage(spark, n, [], tmp_path).collect() == []


def test_rows_that_share_an_id_are_told_apart_by_text(spark, tmp_path):
    """Unlike texts of one id all stay, near copies among them do not, and
    every run keeps the same rows."""
    rows, _ = corpus()
    texts = [r[1] for r in rows]
    shared = [(7, texts[10] + " x", "aa", "s"), (7, texts[7] + " ende", "aa", "s"), (7, texts[7], "bb", "t"), (7, texts[7], "aa", "s"),
              (500, texts[41][::-1], "aa", "s"), (500, texts[42][::-1], "aa", "s"), (500, texts[42][::-1], "cc", "s"), (None, texts[3], "aa", "s")]
    given = [r for r in rows if r[0] in (7, 10, 20)] + shared
    runs = [sorted(map(tuple, stage(spark, "near duplicates", given[i:] + given[:i], tmp_path).collect()), key=str) for i in (0, 3, 5)]
    assert runs[0] == runs[1] == runs[2]
    kept = [(r[0], r[1]) for r in runs[0]]
    assert len(set(kept)) == len(kept)
    # of the group of text 7 (three rows of id 7 and its near copy) one stays,
    # and one of that of text 10; both unlike texts of id 500 stay
    assert sum(t.startswith(texts[7]) for i, t in kept) == 1 and sum(t.startswith(texts[10]) for i, t in kept) == 1
    assert {t for i, t in kept if i == 500} == {texts[41][::-1], texts[42][::-1]}
    assert (20, texts[20]) in kept and (None, texts[3]) in kept


def test_helper_tables_go_when_a_stage_is_written(spark, tmp_path):
    import os

    from chronopanel.session import checkpoint_dir
    rows, items = corpus()
    save(documents(spark, rows, extra=False), tmp_path)
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    home = checkpoint_dir(spark).removeprefix("file:")
    before = set(os.listdir(home))
    P.run(spark, str(tmp_path)).collect()
    made = set(os.listdir(home)) - before
    assert len(made) == 4 and all(m.startswith("pipeline-stage-") for m in made)


def test_near_duplicates_move_a_text_once(spark, tmp_path, monkeypatch):
    """However many cells a pair is found in."""
    rows = [(i, t, "aa", "s") for i, t in met_often()]
    out, moved = units_moved(monkeypatch, lambda: stage(spark, "near duplicates", rows, tmp_path).collect())
    assert sorted(r["doc_id"] for r in out) == [*range(16), 100]
    assert sorted(r["doc"] for r in moved) == [100, 101]
