import itertools
import random

from pyspark.sql import functions as F

from chronopanel.llm import sharding

from .helpers import AWKWARD, crc, documents


def check_law(rows, docs, shards):
    assert sorted((r["doc_id"] is None, r["doc_id"], r["size"], r["text_crc32"]) for r in rows) == sorted(
        (i is None, i, len((t or "").encode()) + 8, crc(t)) for i, t, *_ in docs)
    counts = [sum(r["shard"] == k for r in rows) for k in range(shards)]
    assert max(counts) - min(counts) <= 1
    for k in range(shards):
        assert sorted(r["slot"] for r in rows if r["shard"] == k) == list(range(counts[k]))
    assert {r["law"] for r in rows} <= {"rows"} and {r["grown_shard"] for r in rows} <= {None}


def test_awkward_rows(spark):
    check_law(sharding.sharded_documents(spark, documents(spark), shards=3).collect(), AWKWARD, 3)
    check_law(sharding.sharded_documents(spark, documents(spark)).collect(), AWKWARD, 24)


def test_empty_table(spark):
    assert sharding.sharded_documents(spark, documents(spark).limit(0)).collect() == []


def test_moves_fewest_bytes(spark):
    """Against every assignment of rows to shards, on a tiny table."""
    g = random.Random(5)
    for _ in range(4):
        rows = [(i, "y" * g.randint(0, 30), None, None) for i in range(7)]
        old = {i: g.choice([0, 0, 0, 1, 5]) for i, *_ in rows}
        size = {i: len(t) + 8 for i, t, *_ in rows}
        best = min(sum(size[i] for i, s in enumerate(a) if s != old[i]) for a in itertools.product(range(3), repeat=7)
                   if max(a.count(k) for k in range(3)) - min(a.count(k) for k in range(3)) <= 1)
        df = documents(spark, rows, extra=False).withColumn("old", F.create_map(*[F.lit(x) for kv in old.items() for x in kv])[F.col("doc_id")])
        layout = sharding.lay_out(df, F.col("old"), sharding.size_of(F.col("text")), [F.col("doc_id")], partitions=2)
        found, out = sharding.reshard(layout, 3)
        got = out.select("row.doc_id", "old", "shard", "size").collect()
        assert sum(r["size"] for r in got if r["old"] != r["shard"]) == best
        assert len(got) == 7


def test_skewed_old_layout(spark):
    rows = [(i, "z" * (i % 50), None, "hot" if i % 3 else str(i)) for i in range(500)]
    out = sharding.sharded_documents(spark, documents(spark, rows, extra=False)).collect()
    check_law(out, rows, 24)


def test_blocks_are_cut_by_bytes(spark):
    """One long row, many short ones, a hot shard and a hot size."""
    g = random.Random(9)
    rows = [(i, "a" * (40_000 if i == 7 else 100 if i % 3 == 0 else g.randint(0, 400)), None, "hot" if i % 3 else str(i % 5)) for i in range(1500)]
    docs = documents(spark, rows, extra=False)
    old = F.when(F.col("source") == "hot", 0).otherwise(F.col("source").cast("int"))
    layout = sharding.lay_out(docs, old, sharding.size_of(F.col("text")), [F.col("doc_id")], block_bytes=5000)
    sizes = layout.groupBy("block").agg(F.sum("size").alias("b"), F.count_distinct("old").alias("o"), F.max("size").alias("m")).collect()
    assert all(r["o"] == 1 and (r["b"] <= 9000 or r["m"] > 40_000) for r in sizes) and len(sizes) > 40
    found, out = sharding.reshard(layout, 6)
    got = out.select("row.doc_id", "shard", "slot").collect()
    assert sorted(r["doc_id"] for r in got) == list(range(1500))
    for k in range(6):
        assert sorted(r["slot"] for r in got if r["shard"] == k) == list(range(250))


def test_cuts_of_blocks():
    cuts, n = sharding._block_cuts([(0, 1, 4), (0, 2, 5), (0, 3, 30), (1, 1, 3), (0, 4, 2)], 10)
    assert cuts == [(0, 4, 0, 1), (0, 3, 1, 3), (0, 2, 4, 1), (0, 1, 4, 1), (1, 1, 5, 1)] and n == 6
    assert sharding._block_cuts([], 10) == ([], 0)
