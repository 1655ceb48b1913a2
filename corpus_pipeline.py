"""A training corpus from raw documents, in five stages: toxicity, line dedup, near dedup, source mixing, encoding."""

from __future__ import annotations

import uuid
from functools import wraps

from pyspark.sql import DataFrame, SparkSession, functions as F

from boxloom.llm import sentence_pieces, toxicity
from boxloom.llm.common import table
from boxloom.llm.curriculum import mix
from boxloom.llm.line_dedup import dedup_lines
from boxloom.llm.near_dedup import near_duplicates
from boxloom.session import ensure_checkpoint_dir


DOCUMENT = ("doc_id", "text", "lang", "source", "n_chars")


def _apart(stage):
    """Columns beyond those of documents go through a stage under names of their own, so that none can clash."""

    @wraps(stage)
    def run(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        others = {c: f"_extra_{k}" for k, c in enumerate(docs.columns) if c not in DOCUMENT}
        out = stage(spark, docs.withColumnsRenamed(others), sf_dir)
        back = {v: k for k, v in others.items()}
        made = {c for c in out.columns if c not in back}
        return out.select(*[F.col(c).alias(back.get(c, c)) for c in out.columns if back.get(c) not in made])

    return run


@_apart
def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the random field, fitted to the labelled ones among them, scores 0.5 or more go.

    A table without usable labels loses nothing unless every label says toxic. Null texts count as empty and stay.
    """
    model = toxicity.train(docs, table(spark, sf_dir, "labels"))
    return toxicity.score_toxicity(docs, model).filter("predicted = 0").select(*docs.columns)


@_apart
def drop_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines of 20 or more characters that 3 or more documents hold stay in one of them; no document goes."""
    return dedup_lines(docs).withColumn("n_chars", F.length("text").cast("long")).select(*docs.columns)


@_apart
def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group linked by a similarity of 0.8 on five-word shingles, the document with the smallest doc_id stays.

    Of rows that share this doc_id all stay: they are one document here. Documents without words are in no group.
    """
    groups = near_duplicates(docs).select(F.col("doc_id").alias("_id"), "kept").groupBy("_id").agg(F.max("kept").alias("_kept"))
    return docs.join(groups, F.col("doc_id").eqNullSafe(F.col("_id")), "left").filter("_kept").select(*docs.columns)


@_apart
def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row per pass that the curriculum makes over a document, in the order of the training position.

    The mix takes a source's last document in part to meet the target exactly; here a pass of which half or more is
    taken is a whole row and any other is none, since documents are not cut. Documents without words have nothing to
    take and leave.
    """
    mixed = mix(docs).filter("taken > 0").groupBy("doc_id", "source", "size").agg(
        F.sum("taken").alias("taken"), F.count(F.lit(1)).alias("rows"), F.min("position").alias("position"), F.min("repeat_position").alias("repeat")
    )
    # passes over the document, from the mean of the rows that share its id and size
    passes = F.floor(F.col("taken") / (F.col("size") * F.col("rows")) + 0.5).cast("int")
    at = F.slice(F.array("position", F.coalesce("repeat", "position")), 1, passes)
    chosen = mixed.select(F.col("doc_id").alias("_id"), F.col("source").alias("_source"), "size", F.explode(at).alias("_at"))
    sized = docs.withColumn("_size", F.coalesce(F.regexp_count("text", F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)))
    same = F.col("doc_id").eqNullSafe(F.col("_id")) & F.col("source").eqNullSafe(F.col("_source")) & (F.col("_size") == F.col("size"))
    return sized.join(chosen, same).orderBy("_at", "doc_id").select(*docs.columns)


@_apart
def encode_pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every row with its token_ids, their number, and whether decoding them gives the text again."""
    coded = sentence_pieces.encode(docs, verify=True)
    return coded.select(*docs.columns, F.size("token_ids").alias("n_tokens"), "token_ids", "round_trip")


STAGES = [
    ("toxicity", drop_toxic), ("line dedup", drop_lines), ("near dedup", drop_near_duplicates), ("mix sources", mix_sources), ("encode", encode_pieces),
]

#: Two stages (a fitted model, a tokenizer) have no SQL; tests hold the pipeline against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over `documents`; each but the last is written to the shared folder and read again.

    A stage's folder goes once the next one is written; the last of them is what the result is read from.
    """
    ensure_checkpoint_dir(spark)
    folder = f"{spark.sparkContext.getCheckpointDir()}/corpus-{uuid.uuid4().hex}"
    docs = table(spark, sf_dir, "documents")
    for k, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs.write.parquet(f"{folder}/{k}")
            docs = spark.read.parquet(f"{folder}/{k}")
            if k:
                past = spark._jvm.org.apache.hadoop.fs.Path(f"{folder}/{k - 1}")
                past.getFileSystem(spark._jsc.hadoopConfiguration()).delete(past, True)
    return docs
