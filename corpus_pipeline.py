"""From raw documents to packed sequences: five stages, each applying one operator.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame that is
written as Parquet and read again as the next one's docs. All but the last
return the columns of documents.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from prosemill.llm.packing import pack_documents
from prosemill.llm.queries import tokenizer_file
from prosemill.llm.runtime import checkpoint_root, cut, table
from prosemill.llm.secrets import blob_findings, redact, scan_versions
from prosemill.llm.simhash import few_by_broadcast, similar_groups
from prosemill.llm.suffixes import remove_repeats
from prosemill.llm.toxicity import fit_ngrams, ngram_score


def _columns(docs: DataFrame) -> list[Column]:
    return [F.col(f"`{c}`") for c in docs.columns]


def _with_text(docs: DataFrame, row: str, text: Column) -> list[Column]:
    """The columns of docs out of a struct, with a new text and its length."""
    new = {"text": text.alias("text"), "n_chars": F.length(text).cast("long").alias("n_chars")}
    return [new.get(c, F.col(f"{row}.`{c}`")) for c in docs.columns]


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier, fitted on all labels, does not call toxic.

    Null texts are scored as empty. Rows that repeat an id or a text are each
    judged by their text; an empty table stays empty, and all columns are kept.
    """
    model = fit_ngrams(docs, table(spark, sf_dir, "labels"))
    return docs.filter(ngram_score(model, F.col("text")) < 0.5)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies the document with the least id.

    Near copies have a Jaccard similarity of 0.8 or more on five-word shingles;
    candidates come from multi-index SimHash, and each link is verified. Rows of
    one id are one document and stay together; rows without an id stay. Null and
    blank texts are copies of each other. An empty table stays empty, and all
    columns are kept.
    """
    groups = similar_groups(docs)
    gone = cut(groups.filter(F.col("doc_id") != F.col("component_id")).select(F.col("doc_id").alias("gone")).distinct())
    return docs.join(few_by_broadcast(gone), docs["doc_id"] == gone["gone"], "left_anti").select(*_columns(docs))


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the characters that lie wholly in strings of 50 bytes that a document with a smaller id has.

    A text may end up empty, and a null one becomes empty. Rows of one id are one
    document, rows without an id come after all others. An empty table stays
    empty, and all columns are kept, n_chars as the new length.
    """
    kept = remove_repeats(docs, 50, characters=True, carry=docs.columns)
    return kept.select(*_with_text(docs, "row", F.col("kept").cast("string")))


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with [SECRET] in place of every secret.

    Null texts stay null. Repeated rows are each rewritten; an empty table stays
    empty, and all columns are kept, n_chars as the new length.
    """
    found = blob_findings(scan_versions(docs)[1])
    blob = F.sha2(F.coalesce("text", F.lit("")), 256)
    rows = docs.select(F.struct(*_columns(docs)).alias("row"), F.col("text"), blob.alias("own"))
    marked = rows.join(found, F.col("own") == F.col("blob"), "left")
    text = F.when(F.col("found").isNull(), F.col("text")).otherwise(redact(F.col("text"), F.col("found")))
    return marked.withColumn("new", text).select(*_with_text(docs, "row", F.col("new")))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents with their token ids and places in sequences of 1024.

    A null text is an empty one, which is its end id. Rows that repeat an id are
    packed each; an empty table gives no rows, and other columns are not read.
    """
    return pack_documents(docs, tokenizer_file("byte_bpe_50k.json"))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", drop_toxic),
    ("simhash_near_dedup", drop_near_copies),
    ("suffix_dedup", cut_repeats),
    ("secret_scan", redact_secrets),
    ("packing", pack),
]

#: SQL has neither the classifier nor the tokenizer; tests/llm/test_against_brute_force.py compares every stage with a slow version of it.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages applied to documents; what each returns but the last is written to the shared folder and read again."""
    docs = table(spark, sf_dir, "documents")
    root = f"{checkpoint_root(spark)}/pipeline-{uuid.uuid4().hex}"
    for number, (name, stage) in enumerate(STAGES[:-1]):
        path = f"{root}/{number}-{name}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)
