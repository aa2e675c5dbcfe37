"""The corpus pipeline over ``documents``.

Each stage takes all that the stage before it kept and returns the columns of
``documents``; the last returns the encoded documents. ``run`` writes every
stage's rows to the shared folder and reads them back as the next one's input,
so a lost executor costs one stage's tasks and no stage is computed twice. A
stage's helper tables are removed once its rows are written.

Defined cases: rows without id pass the stages that decide by id (near
duplicates, decontamination) and are judged by their text in the others; equal
rows are one after the near-duplicate stage, unlike texts that share an id all
stay; empty tables give empty results; further columns pass through to the
last stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chronopanel.llm import decontaminate, jaccard_join, language_id, quality_rules, subword_viterbi
from chronopanel.llm.store import helper_tables, sized, written
from chronopanel.session import table

#: A document whose best language is at most so many times as likely as all
#: languages being equal is in no learned language.
UNSURE = 1.2


def languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents without letters or without a likely language."""
    net = language_id.train(docs.where(~language_id.held_out()))
    name = _free("_language", docs.columns)
    told = language_id.label(docs, net, out_col=name)
    sure = F.col(f"{name}.score") > UNSURE / max(len(net.langs) if net else 1, 2)
    return told.where((F.col(f"{name}.lang_pred") != "und") & sure).drop(name)


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that a rule of the cascade rejects."""
    return docs.where(quality_rules.cascade(docs))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the document with the smallest id of each group of near
    duplicates. Rows are told apart by id and text: of equal ones the one with
    the smallest hash of its row counts, and of unlike texts that share an id
    the one with the smallest hash stands for that id, the others come after
    all ids."""
    own = docs.columns
    text, row, node, first = (_free(n, own) for n in ("_text", "_row", "_node", "_first"))
    marked = docs.withColumns({text: F.xxhash64("text"), row: F.xxhash64(*own)})
    repeated = written(marked.where("doc_id is not null").groupBy("doc_id").agg(F.count(F.lit(1)).alias("n"), F.min(text).alias(first))
                       .where("n > 1").drop("n"), "pipeline-repeated")
    if repeated.isEmpty():
        told = docs.withColumn(node, F.col("doc_id"))
    else:
        ids = sized(repeated)
        again = marked.join(ids, "doc_id")
        kept_rows = written(again.groupBy("doc_id", text).agg(F.min(row).alias(row)), "pipeline-rows")
        other = F.lit(1 << 62) + F.pmod(F.xxhash64("doc_id", text), F.lit(1 << 61))
        again = again.join(sized(kept_rows), ["doc_id", text, row], "left_semi").dropDuplicates(["doc_id", text])
        again = again.withColumn(node, F.when(F.col(text) == F.col(first), F.col("doc_id")).otherwise(other)).select(*own, node)
        told = docs.join(ids, "doc_id", "left_anti").withColumn(node, F.col("doc_id")).select(*own, node).unionByName(again)
    found = jaccard_join.near_components(told, id_col=node)
    gone = written(found.where("component_id <> doc_id").select(F.col("doc_id").alias(node)).distinct(), "pipeline-gone")
    return told.join(sized(gone), node, "left_anti").select(own)


def _free(name: str, columns: list[str]) -> str:
    while name in columns:
        name += "_"
    return name


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that hold a benchmark item."""
    leaks = decontaminate.leaks(docs, table(spark, sf_dir, "benchmark"))
    bad = written(leaks.select(F.col("doc").alias("doc_id")).distinct(), "pipeline-leaks")
    return docs.join(sized(bad), "doc_id", "left_anti").select(docs.columns)


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The ids of every document's text, and what they decode to being equal
    to it or not."""
    model = subword_viterbi.model_path()
    return (subword_viterbi.encode(docs.select("doc_id", "lang", "source", "text"), model)
            .select("doc_id", "lang", "source", F.size("ids").cast("long").alias("n_ids"), "ids"))


STAGES = [("language id", languages), ("quality rules", quality), ("near duplicates", near_duplicates),
          ("decontamination", decontaminated), ("subword encoding", encoded)]

#: SQL cannot express the trained language model; tests/llm compares the other
#: stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        with helper_tables(spark, keep="pipeline-stage"):
            docs = written(stage(spark, docs, sf_dir), "pipeline-stage-" + name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
