"""Benchmark decontamination: size-partitioned MinHash containment search.

A test item is found in a document that holds at least ``threshold`` of the
item's distinct five-word shingles, however long the document is. Jaccard
similarity of a short item and a long document is near 0, so signatures of
fixed length cannot find it; the search is asymmetric instead.

1. Items are partitioned by size (the bit length of their shingle count q).
   An item's MinHash sketch is its k smallest shingle hashes, with
   k = q - ceil(threshold * q) + 1: a document that misses all k holds fewer
   shingles than the threshold asks for, so no match is lost.
2. A size partition bounds the documents' side: only documents with enough
   shingles for its smallest item, and of those only hashes up to the largest
   one in its sketches, are looked up. The lookup gives candidate pairs.
3. Candidates are verified: shared shingles are counted over the item's whole
   set and the document's whole set.

All steps are DataFrame operations on hashes of 64 bits.

Defined cases: words are lower-cased; an item with one to four words is its
whole sequence as one shingle, so only a document that is that sequence
matches; null, empty and wordless texts match nothing; rows without an id are
not reported (a pair needs both ids); rows that share an id are one document
or item with the union of their shingles; empty tables give no pairs; only id
and text of either table are read.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .quality_rules import _with, windows, words
from .store import sized, written

SHINGLE = 5
THRESHOLD_PERCENT = 75
BROADCAST_ROWS = 500_000  # rows of (hash, item) of at most 24 bytes each; beyond it the join shuffles


def shingles(text: Column, n: int = SHINGLE) -> Column:
    """Distinct hashes of the n-word shingles; a shorter text's whole
    sequence; nothing without words."""
    def of(w: Column) -> Column:
        return (F.when(F.size(w) == 0, F.array().cast("array<bigint>"))
                .when(F.size(w) < n, F.array(F.xxhash64(F.array_join(w, " "), F.size(w))))
                .otherwise(F.array_distinct(windows(w, n))))

    return _with(words(F.lower(text)), of)


def needed(q: Column, percent: int) -> Column:
    """Shingles of q that must be shared: the ceiling of percent/100 * q."""
    return F.floor((q * percent + 99) / 100).cast("int")


def _hashes(df: DataFrame, id_col: str, text_col: str, name: str) -> DataFrame:
    return df.select(F.col(id_col).alias(name), shingles(F.col(text_col)).alias("s")).where(F.col(name).isNotNull())


def item_tables(items: DataFrame, id_col: str, text_col: str, percent: int) -> tuple[DataFrame, DataFrame]:
    """All item shingles (item, h, q) and the sketches (item, h, need, part)."""
    every = (_hashes(items, id_col, text_col, "item").select("item", F.explode("s").alias("h")).distinct())
    sets = every.groupBy("item").agg(F.sort_array(F.collect_set("h")).alias("s")).withColumn("q", F.size("s"))
    sets = written(sets.withColumn("need", needed(F.col("q"), percent)), "benchmark-items")
    sketch = sets.select("item", "need", F.length(F.bin("q")).alias("part"), F.explode(F.slice("s", F.lit(1), F.col("q") - F.col("need") + 1)).alias("h"))
    return sets.select("item", "q", "need", F.explode("s").alias("h")), written(sketch, "benchmark-sketches")


def candidates(documents: DataFrame, sketch: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Pairs (doc, item) that share a sketch hash."""
    # one row per size partition (the bit lengths of a count: 31 at most)
    parts = sketch.groupBy("part").agg(F.max("h").alias("top"), F.min("need").alias("need")).collect()
    if not parts:
        return sketch.sparkSession.createDataFrame([], "doc long, item long")
    docs = _hashes(documents, id_col, text_col, "doc").withColumn("n", F.size("s"))
    low = F.lit(-(1 << 63))
    top = reduce(F.greatest, [F.when(F.col("n") >= p["need"], F.lit(p["top"])).otherwise(low) for p in parts])
    probes = (docs.where(F.col("n") >= min(p["need"] for p in parts)).withColumn("top", top)
              .select("doc", "n", F.explode(F.filter("s", lambda h: h <= F.col("top"))).alias("h")))
    return probes.join(sized(sketch.select("item", "need", "h"), BROADCAST_ROWS), "h").where(F.col("n") >= F.col("need")).select("doc", "item").distinct()


def verified(documents: DataFrame, every: DataFrame, pairs: DataFrame, id_col: str, text_col: str, percent: int) -> DataFrame:
    """Of the candidate pairs, those that share enough: (doc, item, n_common, q)."""
    some = documents.select(F.col(id_col).alias("doc"), F.col(text_col).alias("text")).join(sized(pairs.select("doc").distinct()), "doc", "left_semi")
    rows = _hashes(some, "doc", "text", "doc").select("doc", F.explode("s").alias("h"))
    shared = rows.join(sized(every, BROADCAST_ROWS), "h").join(pairs, ["doc", "item"], "left_semi")
    return (shared.groupBy("doc", "item").agg(F.count_distinct("h").alias("n_common"), F.first("q").cast("long").alias("q"))
            .where(100 * F.col("n_common") >= percent * F.col("q")))


def leaks(documents: DataFrame, items: DataFrame, doc_id: str = "doc_id", doc_text: str = "text", item_id: str = "item_id",
          item_text: str = "text", percent: int = THRESHOLD_PERCENT) -> DataFrame:
    """Pairs (doc, item, n_common, q) with containment of ``percent`` or more."""
    every, sketch = item_tables(items, item_id, item_text, percent)
    pairs = written(candidates(documents, sketch, doc_id, doc_text), "benchmark-candidates")
    return verified(documents, every, pairs, doc_id, doc_text, percent)


def contaminated_pairs(spark: SparkSession, documents: DataFrame, benchmark: DataFrame) -> DataFrame:
    return leaks(documents, benchmark).select(F.col("doc").alias("doc_id"), F.col("item").alias("item_id"), "n_common", F.col("q").alias("n_item"))


SQL = r"""
WITH tok AS (SELECT 'd' AS kind, doc_id AS id, regexp_extract_all(lower(coalesce(text, '')), '[^\x20\x09-\x0D]+') AS ws FROM documents
  UNION ALL SELECT 'i', item_id, regexp_extract_all(lower(coalesce(text, '')), '[^\x20\x09-\x0D]+') FROM benchmark),
sh AS (SELECT DISTINCT kind, id, g FROM (
  SELECT kind, id, array_to_string(ws[i:i+4], ' ') AS g FROM (SELECT kind, id, ws, unnest(range(1, len(ws) - 3)) AS i FROM tok)
  UNION ALL SELECT kind, id, len(ws) || ':' || array_to_string(ws, ' ') FROM tok WHERE len(ws) BETWEEN 1 AND 4)),
q AS (SELECT id, count(*) AS n FROM sh WHERE kind = 'i' GROUP BY id),
c AS (SELECT d.id AS doc_id, i.id AS item_id, count(*) AS n_common FROM sh d JOIN sh i ON d.g = i.g AND d.kind = 'd' AND i.kind = 'i' GROUP BY d.id, i.id)
SELECT doc_id, item_id, n_common, n AS n_item FROM c JOIN q ON q.id = c.item_id WHERE 100 * n_common >= 75 * n
"""
