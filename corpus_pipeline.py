"""The training-corpus pipeline: language ID, line dedup, SimHash near-dedup, benchmark
decontamination, best-fit packing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; ``run`` writes each
result as Parquet in the shared checkpoint folder and reads it again for the next. All
stages but the last return the columns of documents.

- language: documents are judged by prediction and score alone, by a filter learned from
  labelled documents of the other half (halves by a hash of the text, so that no text
  vouches for itself or its copies); a document whose score is under FLOOR (in none of the
  learned languages, or no language at all), or whose given language is another one than
  predicted with a score of CONFIDENT, is rejected
- lines: boilerplate lines of a source go, copies of a text counted as one page, so that
  near_dedup finds them whole; n_chars follows the text
- near_dedup: the document with the smallest id of each group stays
- decontamination: documents with a benchmark passage go
- packing: one row per piece of a document, with its place in a sequence

Edge cases are those of the operators; columns of documents beyond the five of the
table pass through the first four stages. A missing n_chars column is not added.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pricewise.llm import decontaminate, langid, linededup, packing, simhash
from pricewise.llm.common import cut_lineage, table
from pricewise.llm.queries import word_tokenizer

#: Corrected share of trigrams below which a text is in none of the learned languages.
FLOOR = 0.4
#: Corrected share of trigrams from which a prediction outweighs a document's own label.
CONFIDENT = 0.75
#: Different trigrams that a filter must have been learned from before it may reject.
ENOUGH = 1000


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in one of the learned languages that do not contradict their label.

    A null label contradicts nothing. Where the other half has fewer than ENOUGH trigrams
    to judge by, only documents without a letter are rejected.
    """
    half = F.crc32(F.coalesce(F.col("text"), F.lit("")).cast("binary")) % 2
    halves = [docs.where(half == k) for k in (0, 1)]
    models = [langid.learn(h) for h in halves]
    kept = []
    for rows, model in zip(halves, reversed(models)):
        if model.trigrams < ENOUGH:
            kept.append(rows.where(F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False))))
            continue
        judged = langid.predict(rows.withColumnRenamed("lang_pred", "__lang_pred").withColumnRenamed("score", "__score"), model)
        contradicts = F.coalesce(F.col("lang_pred") != F.col("lang"), F.lit(False)) & (F.col("score") >= CONFIDENT)
        judged = judged.where((F.col("lang_pred") != langid.UNKNOWN) & (F.col("score") >= FLOOR) & ~contradicts)
        kept.append(judged.drop("lang_pred", "score").withColumnRenamed("__lang_pred", "lang_pred").withColumnRenamed("__score", "score").select(*docs.columns))
    return kept[0].unionByName(kept[1])


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without their source's boilerplate lines; a text counts once a source."""
    named = docs.withColumnRenamed("n_lines", "__n_lines").withColumnRenamed("n_dropped", "__n_dropped")
    out = linededup.drop_boilerplate(named, copies_once=True).drop("n_lines", "n_dropped")
    out = out.withColumnRenamed("__n_lines", "n_lines").withColumnRenamed("__n_dropped", "n_dropped")
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.char_length("text").cast(docs.schema["n_chars"].dataType))
    return out.select(*docs.columns)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash group."""
    return simhash.keep_one(docs, simhash.cluster(docs)).select(*docs.columns)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a benchmark item."""
    return decontaminate.drop_contaminated(docs, table(spark, sf_dir, "benchmark")).select(*docs.columns)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32, sequence_id, offset) of every piece."""
    pieces = packing.token_pieces(docs, word_tokenizer()).select("doc_id", "piece", "start", "length", F.crc32("ids").alias("ids_crc32"))
    return packing.pack(pieces, ["doc_id", "piece", "ids_crc32"])


STAGES = [("language", language), ("lines", lines), ("near_dedup", near_dedup), ("decontamination", decontamination), ("packing", pack)]

#: No SQL: language ID, SimHash and the tokenizer cannot be written in it.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents table."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = cut_lineage(stage(spark, docs, sf_dir), name)
    return docs
