"""The corpus pipeline: toxic documents go, of equal and of similar ones one stays, personal data is replaced, the rest
is packed into training sequences. Each stage is written and read again before the next."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lindero.llm import chunk_dedup, jaccard_groups, packing, surrogates, toxicity
from lindero.llm.common import joined, numbered, table, written
from lindero.llm.queries import tokenizer_path

#: Near-duplicate stages take five-word shingles and a similarity of 0.8 or more.
SHINGLE_WORDS, SIMILAR_PERCENT = 5, 80


#: The column that tells rows apart within a stage: a doc_id may be null or stand on several rows.
ROW = "_row"


def _kept(rows: DataFrame, decided: DataFrame) -> DataFrame:
    """``rows`` without those that ``decided`` does not keep; one join strategy at every size."""
    return joined(rows, decided.filter("not kept").select(ROW), [ROW], "left_anti").drop(ROW)


def without_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that the classifier, fitted on all labels of ``sf_dir``, does not call toxic."""
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"), F.lit(True))
    return toxicity.score(docs, model, keep=True).filter("predicted = 0").select(docs.columns)


def without_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of rows with equal normalised texts the one with the smallest doc_id, one without an id only if none has one."""
    rows = numbered(docs, ROW)
    return _kept(rows, chunk_dedup.exact_groups(rows, row=ROW)).select(docs.columns)


def without_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of rows that links of similar texts connect, the one with the smallest doc_id, one without an id only if none has
    one. Texts without words all stay."""
    rows = numbered(docs, ROW)
    return _kept(rows, jaccard_groups.similarity_components(rows, SHINGLE_WORDS, SIMILAR_PERCENT, row=ROW)).select(docs.columns)


def with_surrogates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents with personal data replaced; n_chars is that of the new text."""
    out = surrogates.with_surrogates(docs)
    return out.withColumn("n_chars", F.char_length("text").cast("long")).select(docs.columns)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of the documents in sequences of 4096 tokens."""
    return packing.pack(docs, tokenizer_path("word_bpe_49k.json"), end_id=2, capacity=4096)


Stage = Callable[[SparkSession, DataFrame, str], DataFrame]
STAGES: list[tuple[str, Stage]] = [
    ("toxicity", without_toxic),
    ("exact_dedup", without_copies),
    ("near_dedup", without_near_copies),
    ("pii", with_surrogates),
    ("packing", packed),
]

#: The stages' decisions (a fitted classifier, keyed replacements, a tokenizer) have no SQL form.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
