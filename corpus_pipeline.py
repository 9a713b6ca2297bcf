"""The corpus pipeline: five stages over ``documents``, each written and read again.

toxicity -> near dedup -> substring dedup -> mixing -> packing.  All but
the last return the columns of documents; the last returns the packed
pieces with their ids.  Columns that a stage does not know travel in one
struct, so that names which an operator adds cannot clash with them.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from recruitflow.llm import minhash, mixing, packing, substring_dedup, toxicity
from recruitflow.llm.common import Scope, read, written

OWN = ("doc_id", "text", "source")
#: Words of a shingle in the near-dedup stage: the general rule for near copies (the 4 of op10 are that query's own).
SHINGLE = 5


def _tucked(docs: DataFrame) -> tuple[DataFrame, list[str]]:
    """The columns the operators use, and all others in one struct; and the order of all."""
    rest = [F.col(f"`{c}`") for c in docs.columns if c not in OWN]
    held = F.struct(*rest) if rest else F.struct(F.lit(True).alias("none"))
    return docs.select(*OWN, held.alias("held_columns")), docs.columns


def _as_documents(rows: DataFrame, columns: list[str]) -> DataFrame:
    """The columns of documents again; n_chars follows the text."""
    def out(c: str):
        if c in OWN:
            return F.col(c)
        if c == "n_chars":
            return F.length(F.coalesce("text", F.lit(""))).cast("long").alias(c)
        return F.col(f"held_columns.`{c}`").alias(c)

    return rows.select(*[out(c) for c in columns])


def clean(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity model rejects go."""
    held, columns = _tucked(docs)
    model = toxicity.train(docs, read(spark, sf_dir, "labels"))
    kept = toxicity.score(held, model).where(F.col("predicted") == 0)
    return kept.select(*[F.col(c) if c in OWN else F.col(f"held_columns.`{c}`").alias(c) for c in columns])


def distinct(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays: the first row.

    Rows get numbers of their own in a written copy, so that repeated or
    missing ids neither keep nor lose a row too many.
    """
    held, columns = _tucked(docs)
    rows = written(held.withColumn("row_number", F.monotonically_increasing_id()), "pipeline-rows")
    kept = minhash.near_classes(rows, key="row_number", size=SHINGLE).where("kept").select("row_number")
    rows = rows.join(kept, "row_number", "left_semi")
    return rows.select(*[F.col(c) if c in OWN else F.col(f"held_columns.`{c}`").alias(c) for c in columns])


def without_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeated passages go; every document stays with the text that is left."""
    held, columns = _tucked(docs)
    left = substring_dedup.remove_repeats(held)
    changed = F.when(F.col("n_removed") > 0, F.col("kept_text")).otherwise(F.col("text"))
    return _as_documents(left.withColumn("text", changed), columns)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources at their target weights: a document taken twice is two rows, one taken in part is cut."""
    held, columns = _tucked(docs)
    return _as_documents(mixing.in_order(mixing.mix(held)), columns)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the mixed documents, with ids, in sequences of 4096 tokens."""
    return packing.pack(docs.select(*OWN), public_tokenizers.path("word_bpe_49k.json"))


#: What each stage's operators wrote on their way, in the order of the stages.
SCOPES = [Scope() for _ in range(5)]


def _scoped(place: int, stage):
    """The stage; what the stage before it wrote on its way goes first, if that one's rows are written and read again by now."""
    def run(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        if place:
            SCOPES[place - 1].close(still=docs)
        SCOPES[place] = Scope()
        with SCOPES[place]:
            return stage(spark, docs, sf_dir)

    return run


STAGES = [(name, _scoped(k, stage)) for k, (name, stage) in enumerate([
    ("toxicity", clean),
    ("near_dedup", distinct),
    ("substring_dedup", without_repeats),
    ("mixing", mixed),
    ("packing", packed),
])]

#: The stages learn, draw and tokenize, which SQL cannot express; tests hold them against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
