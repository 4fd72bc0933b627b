import hashlib
import re

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from prosemill.llm import queries, simhash
from prosemill.llm.packing import byte_bpe
from prosemill.llm.queries import tokenizer_file

COLUMNS = {
    "op1": "doc_id held_out score predicted",
    "op2": "doc_id start length ids_crc32 doc_tokens sequence_id offset",
    "op3": "doc_id n_pieces ids_crc32 decoded_sha256",
    "op4": "page_id payload_bytes payload_digest record_type refers_to",
    "op5": "doc_id n_chars edited_sha256 fingerprint edited_fingerprint near_edited near_next",
    "op6": "doc_id n_assign n_access n_hex base_sha256 spans",
    "op7": "vec_id n_links component_id kept",
    "op8": "doc_id fingerprint component_id",
    "op9": "doc_id n_bytes n_removed n_spans kept_sha256",
    "op10": "doc_id held_out score predicted",
}


@pytest.mark.parametrize("name", sorted(queries.queries()))
def test_queries_return_a_row_for_each_of_theirs(spark, sf_dir, name):
    op = name.split("_")[0]
    out = queries.queries()[name](spark, sf_dir)
    assert out.columns == COLUMNS[op].split()
    tables = {"op4": "pages", "op7": "embeddings"}
    rows = spark.read.parquet(f"{sf_dir}/{tables.get(op, 'documents')}.parquet").count()
    assert out.select(out.columns[0]).distinct().count() == rows
    assert op == "op2" or out.count() == rows


def test_every_operator_has_a_query():
    assert sorted(n.split("_")[0] for n in queries.queries()) == sorted(COLUMNS)


def test_decoded_texts_are_the_documents(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", F.sha2("text", 256).alias("own"))
    assert queries.op3_piece_viterbi(spark, sf_dir).join(docs, "doc_id").filter("own != decoded_sha256").count() == 0


def docs(spark):
    passage = "a passage of rather more than fifty bytes that several documents share"
    base = " ".join(f"word{i}" for i in range(200))
    rows = [(1, base + ".", "en", "s", 0), (2, base + "!", "en", "s", 0), (3, passage + " third", "en", "s", 0), (4, "fourth " + passage, "fr", "s", 0), (5, "é token = abcdefghijklmnop end", "en", "s", 0), (6, None, "en", None, None), (7, "", None, "s", 0)]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")


def test_near_copies(spark):
    out = corpus_pipeline.drop_near_copies(spark, docs(spark).withColumn("gone", F.lit(1)), "")
    # 3 and 4 share 8 of 10 shingles, which is 0.8, so 4 goes; a stage at four bits of 64 once kept it.
    assert sorted(r["doc_id"] for r in out.collect()) == [1, 3, 5, 6]
    assert out.columns[-1] == "gone"


def test_few_copies_leave_without_an_exchange_of_the_documents(spark, monkeypatch):
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        few = corpus_pipeline.drop_near_copies(spark, docs(spark), "")
        monkeypatch.setattr(simhash, "_FEW", 0)
        many = corpus_pipeline.drop_near_copies(spark, docs(spark), "")
        plans = [df._jdf.queryExecution().executedPlan().toString() for df in (few, many)]
        assert "BroadcastHashJoin" in plans[0] and "SortMergeJoin" not in plans[0] and "SortMergeJoin" in plans[1]
        assert sorted(map(str, few.collect())) == sorted(map(str, many.collect()))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)


def test_repeats(spark):
    out = {r["doc_id"]: r for r in corpus_pipeline.cut_repeats(spark, docs(spark), "").collect()}
    assert out[4]["text"] == "fourth " and out[4]["n_chars"] == 7 and out[4]["lang"] == "fr"
    assert out[6]["text"] == "" and out[3]["text"].endswith("third") and len(out) == 7


def test_secrets(spark):
    out = {r["doc_id"]: r for r in corpus_pipeline.redact_secrets(spark, docs(spark), "").collect()}
    assert out[5]["text"] == "é [SECRET] end" and out[5]["n_chars"] == 14
    assert out[6]["text"] is None and out[4]["text"].startswith("fourth") and len(out) == 7


def test_stages_on_an_empty_table(spark, sf_dir):
    none = docs(spark).limit(0)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, none, sf_dir).count() == 0


def test_the_whole_pipeline(spark, sf_dir):
    seen = spark.read.parquet(f"{sf_dir}/documents.parquet")
    columns = seen.columns
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before = seen.select("doc_id", "text").toPandas().set_index("doc_id")["text"]
        seen = stage(spark, seen, sf_dir).checkpoint()
        assert seen.columns == columns, name
        after = seen.select("doc_id", "text").toPandas().set_index("doc_id")["text"]
        assert set(after.index) <= set(before.index) and after.index.is_unique
    assert re.search(r"AKIA[A-Z0-9]{14}", " ".join(after)) is None
    pieces = corpus_pipeline.run(spark, sf_dir).toPandas()
    encode = byte_bpe(tokenizer_file("byte_bpe_50k.json"))
    for doc, part in pieces.groupby("doc_id"):
        ids = b"".join(part.sort_values("start")["ids"])
        expected = encode(after[doc]).tobytes() + bytes(4)
        assert hashlib.sha1(ids).digest() == hashlib.sha1(expected).digest()
    assert set(pieces["doc_id"]) == set(after.index)


@pytest.mark.parametrize("name", sorted(queries.oracle_sql()))
def test_query_equals_sql(spark, sf_dir, name):
    import duckdb

    con = duckdb.connect()
    for t in ("documents", "pages", "embeddings"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    columns = COLUMNS[name.split("_")[0]]
    expected = con.execute(f"SELECT {columns.replace(' ', ', ')} FROM ({queries.oracle_sql()[name]}) q").fetchall()
    got = [tuple(r) for r in queries.queries()[name](spark, sf_dir).collect()]
    assert sorted(map(str, got)) == sorted(map(str, expected))
