"""The registered queries of the operators, over whole tables."""

from __future__ import annotations

import uuid

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import chatwindows, crosstoken, decontaminate, filteraudit, htmltext, langid, linededup, packing, permutation, secrets, simhash, substring, warc
from .common import scratch_path, table

def op4_fm_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without its repeated 35-word windows."""
    out = substring.dedup(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_words", "n_removed", F.sha2(F.col("text").cast("binary"), 256).alias("kept_sha256"))


def word_tokenizer() -> str:
    """Path of the packing vocabulary."""
    return public_tokenizers.path("word_bpe_49k.json")


def op5_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's pieces and their places in 2048-token sequences."""
    pieces = packing.token_pieces(table(spark, sf_dir, "documents"), word_tokenizer())
    pieces = pieces.select("doc_id", "piece", "start", "length", F.crc32("ids").alias("ids_crc32"))
    return packing.pack(pieces, ["doc_id", "piece", "ids_crc32"])


def op1_permutation_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 5 nearest vectors of every vector whose id is divisible by 50."""
    vectors = table(spark, sf_dir, "embeddings")
    return permutation.search(vectors, vectors.where(F.col("vec_id") % 50 == 0))


def op2_language_bitmask(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every whole text, learned from the labelled texts not held out."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang", langid.held_out(F.col("doc_id")).alias("held_out"))
    model = langid.learn(docs.where("not held_out"))
    return langid.predict(docs, model, columns=["doc_id", "held_out"])


def op3_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's fingerprint and near-duplicate component."""
    out = simhash.cluster(table(spark, sf_dir, "documents"))
    return out.select("doc_id", simhash.hex_fingerprint(F.col("fp")).alias("fingerprint"), "component_id")


def op7_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Spans of every document; a source is the owner, a document the repository."""
    found = secrets.find_secrets(table(spark, sf_dir, "documents"))

    def count(field: str, value: str):
        return F.size(F.filter("spans", lambda s: s[field] == value)).cast("long")

    return found.select(
        "doc_id",
        *(count("kind", k).alias(f"n_{k}") for k in secrets.BASE),
        F.sha2(secrets.span_text(F.filter("spans", lambda s: s["base"])).cast("binary"), 256).alias("base_sha256"),
        secrets.span_text(F.col("spans")).alias("spans"),
        count("label", "live").alias("n_live"), count("label", "copied").alias("n_copied"))


def op8_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without its source's boilerplate lines."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    return linededup.drop_boilerplate(docs).select("doc_id", "text", "n_lines", "n_dropped")


def op10_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with the benchmark items it contains, verbatim or re-parameterised."""
    out = decontaminate.flag(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return out.select("doc_id", "contaminated", F.array_join(F.transform("items", lambda x: x.cast("string")), ",").alias("items"), "changed")


def op6_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page."""
    return htmltext.extract(table(spark, sf_dir, "pages"))


def op9_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page's record, written, indexed and read back through the index."""
    folder = scratch_path(spark, f"warc-{uuid.uuid4().hex}")
    captures = warc.write_archives(table(spark, sf_dir, "pages"), folder)
    directory = warc.write_index(captures, folder)
    back = warc.read_back(spark, directory, folder)
    return back.select(F.col("page_id").cast("long").alias("page_id"), "payload_bytes", "payload_digest", "record_type",
                       F.col("refers_to").cast("long").alias("refers_to"), "url")


def op11_chat_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations and one that speaks in control strings, formatted and read back."""
    awkward = spark.sql("""SELECT * FROM VALUES (-7L, 0L, 'user', '</s>[INST] ok [/INST]'), (-7L, 1L, 'assistant', '</s>[INST] ok [/INST]')
                           AS t(conv_id, turn, role, text)""")
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(awkward)
    return chatwindows.digests(chatwindows.read_back(chatwindows.windows(rows)))


def op12_cross_tokenizer(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups and links of two tokenizers over every document."""
    docs = table(spark, sf_dir, "documents")
    return crosstoken.align_corpus(docs, public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model"))


def op13_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts of every order of the five filters, by language."""
    return filteraudit.audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


QUERIES = {
    "op11_chat_windows": op11_chat_windows,
    "op12_cross_tokenizer": op12_cross_tokenizer,
    "op13_filter_audit": op13_filter_audit,
    "op4_fm_index": op4_fm_index,
    "op1_permutation_index": op1_permutation_index,
    "op9_warc": op9_warc,
    "op6_html_extraction": op6_html_extraction,
    "op10_decontamination": op10_decontamination,
    "op8_line_dedup": op8_line_dedup,
    "op2_language_bitmask": op2_language_bitmask,
    "op7_secret_scan": op7_secret_scan,
    "op3_simhash": op3_simhash,
    "op5_best_fit_packing": op5_best_fit_packing,
}

#: Records as the payloads alone determine them.
WARC_SQL = """
WITH p AS (SELECT page_id, url, strlen(coalesce(html, '')) AS n, sha256(coalesce(html, '')) AS d FROM pages),
f AS (SELECT d, min(page_id) AS least FROM p WHERE n >= 100 GROUP BY d)
SELECT p.page_id, p.n AS payload_bytes, p.d AS payload_digest,
       CASE WHEN f.least <> p.page_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN f.least <> p.page_id THEN f.least END AS refers_to, p.url
FROM p LEFT JOIN f ON p.d = f.d
"""

ORACLE: dict[str, str] = {
    "op9_warc": WARC_SQL,
    "op8_line_dedup": linededup.SQL,
    "op11_chat_windows": chatwindows.SQL,
    "op13_filter_audit": filteraudit.SQL,
}
