"""From raw documents to packed sequences, a table between any two stages.

Quality classifier, line dedup, MinHash near-dedup, suffix-array dedup, best-fit packing. Every stage
reads all that the one before it kept. Texts that a stage changes get a new ``n_chars``; documents
of which a stage leaves only white space are not passed on.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from scoreloom.llm.line_dedup import without_repeated_lines
from scoreloom.llm.near_dup import near_duplicates, text_key
from scoreloom.llm.packing import packed_documents
from scoreloom.llm.passing import veiled
from scoreloom.llm.quality_mil import fit_on, scored
from scoreloom.llm.registry import read
from scoreloom.llm.sides import small_side
from scoreloom.llm.suffix_dedup import without_repeats
from scoreloom.shared_store import Workspace


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep what the classifier scores at 0.5 or more; it learns from labels that are not held out."""
    model = fit_on(docs, read(spark, sf_dir, "labels").select("doc_id", "quality"))
    return scored(docs, model, out="_quality").where("_quality >= 0.5").select(*docs.columns)


def with_text(names: dict[str, str], changed: DataFrame, text: Column, lost: Column) -> DataFrame:
    """The veiled columns with the new text; rows that lost all their words go."""
    rows = changed.select("*", text.alias("_text"), lost.alias("_lost")).where(~(F.col("_lost") & ~F.col("_text").rlike(r"\S")))
    size = F.when(F.col("_lost"), F.char_length("_text").cast("long"))
    new = {"text": lambda p: F.col("_text"), "n_chars": lambda p: size.otherwise(F.col(p))}
    return rows.select(*[new[c](p).alias(p) if c in new else p for c, p in names.items()])


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop every line that repeats an earlier one or is like it."""
    rows, names, back = veiled(docs)
    kept = without_repeated_lines(rows, Workspace(spark, "pipeline-lines"), names["doc_id"], names["text"])
    return back(with_text(names, kept, F.col("_kept").cast("string"), F.col("_n_dropped") > 0))


def near_duplicate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep exactly one row of every group of near duplicates; texts without words are in no group.

    It is the first by id, null ids last, then by text key; of equal rows it is the first as stored.
    """
    work = Workspace(spark, "pipeline-minhash")
    place = F.struct(F.col("doc_id").isNull().alias("late"), "doc_id", "t1", "t2")
    # aggregates are written down before a join, so that the join can split the rows of a hot key
    members = work.save(near_duplicates(docs, work).where("component is not null").groupBy("component", "doc_id", "t1", "t2").agg(
        F.count(F.lit(1)).alias("n")), "row_keys")
    first = work.save(members.groupBy("component").agg(F.min(place).alias("first")), "first_keys")
    judged = work.save(members.join(first, "component").select(
        F.col("doc_id").alias("own_id"), F.col("t1").alias("own_1"), F.col("t2").alias("own_2"), (place == F.col("first")).alias("stays"), "n",
    ).where("not stays or n > 1"), "judged")
    rows, names, back = veiled(docs)
    keyed = rows.select("*", *text_key(names["text"]))
    same = F.col(names["doc_id"]).eqNullSafe(F.col("own_id")) & (F.col("t1") == F.col("own_1")) & (F.col("t2") == F.col("own_2"))
    single = keyed.join(small_side(judged), same, "left_anti")
    repeated = work.save(keyed.join(small_side(judged.where("stays")), same, "left_semi").withColumn(
        "number", F.monotonically_increasing_id()), "repeated")
    one = work.save(repeated.groupBy(names["doc_id"], "t1", "t2").agg(F.min("number").alias("number")).select("number"), "one")
    return back(single.unionByName(repeated.join(small_side(one), "number", "left_semi").drop("number")))


PASSAGE_WORDS = 51


def suffixes(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Remove strings of 400 bytes, and passages of over 50 words, that also occur elsewhere; characters cut in two go wholly."""
    rows, names, back = veiled(docs)
    # one worker cuts and mends a text: a second one beside it would hold its libraries until the end of the job
    kept = without_repeats(rows, Workspace(spark, "pipeline-suffixes"), names["text"], passage_words=PASSAGE_WORDS, characters=True)
    return back(with_text(names, kept, F.col("_kept").cast("string"), F.col("_n_removed") > 0))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pack what is left into sequences."""
    # workers of the earlier stages still live, so each remembers less here
    return packed_documents(docs, Workspace(spark, "pipeline-packing"), remembered=20_000, forget=True).select(
        "doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


STAGES = [
    ("quality", quality), ("line_dedup", lines), ("near_dup", near_duplicate), ("suffix_dedup", suffixes), ("packing", packing),
]

# Scores, MinHash groups and token ids are beyond SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    work, docs = Workspace(spark, "pipeline"), read(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = work.save(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
