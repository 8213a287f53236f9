"""From raw documents to token ids: five stages, each written to Parquet and read by the next.

1. Language identification: documents without letters go, and those that are like no language of the labelled ones.
2. Near duplicates: one document of each class stays.
3. Repeated paragraphs and passages: all but the first of each group are cut out, as in `op2_paragraph_dedup`.
4. Decontamination: documents that hold a benchmark item go.
5. Byte-level BPE: what is left becomes token ids, with the digest of the text that they decode to.

Rows with nulls: a null text has no letters and goes in stage 1; a null id stays a document of its own.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quotelake.llm.bpe import encode_documents
from quotelake.llm.decontaminate import drop_contaminated
from quotelake.llm.language_id import UNDETERMINED, fit, identify
from quotelake.llm.near_dedup import drop_near_duplicates
from quotelake.llm.paragraph_dedup import trim_documents
from quotelake.llm.shared import free_names, ship, stored
from quotelake.plans.catalog.registry import Tables

VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")
LEAST_PROBABILITY = 0.5
#: Nats an n-gram that a text may be less likely than the labelled texts of its language. Fitted on the given tables:
#: clean documents come to 1.8 at most (a hex token among few words), other languages and random letters to 3.0 at least.
MOST_DISTANCE = 2.4


def keep_languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is determined; a missing `lang` is filled in.

    Without any labelled document nothing can be learned, and nothing is rejected but texts without letters.
    """
    ship(spark)
    model = fit(docs)
    if model is None:
        return docs.where(F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False)))
    [name] = free_names(docs, "found")
    found = F.col(name)
    marked = docs.withColumn(name, identify(docs, model))
    probable = (found["score"] >= LEAST_PROBABILITY) & (found["distance"] <= MOST_DISTANCE)
    kept = marked.where((found["lang"] != UNDETERMINED) & probable)
    return kept.withColumn("lang", F.coalesce("lang", found["lang"])).select(*[F.col(f"`{c}`") for c in docs.columns])


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship(spark)
    return drop_near_duplicates(docs)


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship(spark)
    return trim_documents(docs)


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship(spark)
    return drop_contaminated(docs, Tables(spark, sf_dir).benchmark)


def to_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """`doc_id, n_tokens, ids, decoded_sha256`; ids as little-endian unsigned 32-bit integers."""
    ship(spark)
    encoded = encode_documents(docs, VOCABULARY)
    return encoded.select("doc_id", "n_tokens", "ids", F.sha2(F.encode("decoded", "UTF-8"), 256).alias("decoded_sha256"))


STAGES = [
    ("language identification", keep_languages),
    ("near-duplicate removal", drop_near_copies),
    ("paragraph deduplication", cut_repeats),
    ("benchmark decontamination", drop_leaks),
    ("byte-level BPE", to_tokens),
]

#: Stages with learned models, components and tokens have no SQL; tests hold them against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages one after another over `documents`."""
    docs = Tables(spark, sf_dir).documents
    for _, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), "stage")
    return docs
