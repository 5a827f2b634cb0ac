"""A pipeline over ``documents``: quality rules, near-duplicates, repeated passages, secrets, packing.

Each stage takes ``(spark, docs, sf_dir)`` and works on all that its predecessor
kept; all but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.llm import neardup, packing, quality, secrets, store, suffixes
from ledgerloom.llm.queries import table, tokenizer_path
from ledgerloom.operators import windows


def counted(docs: DataFrame) -> DataFrame:
    """``n_chars`` of the texts as they are now, if ``docs`` has that column."""
    return docs.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else docs


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the rules or the line labels reject go. Null and empty texts have no words and go; rows with a null or
    repeated id are judged each; whole texts, however long, are read; further columns stay; an empty table stays empty."""
    return quality.keep_quality(docs, table(spark, sf_dir, "labels"))


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group one document stays, that with the smallest id; five-word shingles, similarity 0.8 or more. Where rows share
    an id, each is judged by its own text: the verdict is on the row, and of rows with one id and text one stays. Rows with a null
    id stay, as do null and empty texts, which are like nothing; texts of any length are compared whole; further columns, of any
    type and name, stay; an empty table stays empty."""
    known = docs.filter("doc_id IS NOT NULL")
    if not known.groupBy("doc_id").count().filter("count > 1").limit(1).count():
        gone = neardup.near_duplicates(docs, shingle_words=5, percent=80).filter("NOT kept").select("doc_id").distinct()
        return docs.join(gone, "doc_id", "left_anti").select(*docs.columns)
    sha = F.coalesce(F.sha2("text", 256), F.lit(""))
    # Of such rows the one stays whose further columns come first as text, which columns of any type have.
    further = F.to_json(F.struct(F.lit(0), *[c for c in docs.columns if c.lower() not in ("doc_id", "text")]))
    one = known.groupBy("doc_id", sha.alias("sha")).agg(F.min_by(F.struct(*docs.columns), further).alias("row"))
    # Numbers in the order of the ids stand for them, so that no two texts are one node.
    number = secrets.unused(docs, "number")
    rows = store.save(windows.global_position(one, ["doc_id", "sha"], "number").select(F.col("number").alias(number), "row.*"), "numbered")
    verdicts = neardup.near_duplicates(rows.select(F.col(number).alias("doc_id"), "text"), shingle_words=5, percent=80)
    kept = rows.join(verdicts.filter("NOT kept").select(F.col("doc_id").alias(number)), number, "left_anti")
    return kept.select(*docs.columns).unionByName(docs.filter("doc_id IS NULL"))


def repeated_passage_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages of 50 bytes or more that a document with a smaller id has are cut out. All rows stay, also those with null ids or
    texts or none of their text left; texts may be of any length; ``n_chars``, where there is one, is counted anew; other columns,
    of any type and name, stay; an empty table stays empty."""
    return counted(suffixes.remove_repeats(docs, span=50))


def secret_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets are replaced by a mark. All rows stay; null and empty texts hold none; whole texts, however long, are searched;
    ``n_chars``, where there is one, is counted anew; other columns stay; an empty table stays empty."""
    return counted(secrets.redact(docs))


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of sequences of 2048 tokens. Null and empty texts are their end token alone; rows with null or repeated ids are packed
    each; texts of any length are cut over sequences; further columns are left out; an empty table gives no pieces."""
    return packing.pack(docs, tokenizer_path()).drop("ids")


STAGES = [
    ("quality rules", quality_stage),
    ("near-duplicates", near_duplicate_stage),
    ("repeated passages", repeated_passage_stage),
    ("secret scans", secret_stage),
    ("packing", packing_stage),
]

#: SQL cannot train the line model or tokenize; the tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = store.save(stage(spark, docs, sf_dir), name.replace(" ", "_"))
    return STAGES[-1][1](spark, docs, sf_dir)
