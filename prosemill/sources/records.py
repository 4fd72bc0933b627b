"""JSON-lines, taxonomy and document sources, and the sinks that go with them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

#: Canonical order of a corpus row's columns (fixed values); unknown ones follow.
CORPUS_COLUMNS = ("k", "genre", "parent", "prompt", "text", "prose", "n_tok", "seed", "stop", "ends", "verdict", "draws", "att", "review", "gates", "world", "energy", "tags", "confidence", "gate_decision", "gate_score", "gate_fails", "gate_defaulted")
CORPUS = (
    "k string, genre string, parent string, prompt string, text string, raw string, prose string, n_tok long, n_word long, seed long, stop string, ends boolean, verdict string, draws long, att long, "
    "review array<string>, gates array<string>, world string, energy string, tags array<string>, confidence string, gate_decision string, gate_score double, gate_fails array<string>, gate_defaulted array<string>"
)
LEAVES = "idx long, n string, p string"
DRAWS = "idx long, att long, text string, stop string"
VOTES = "k string, world string, energy string, tags array<string>, raw string"


def read_lines(spark: SparkSession, paths: str | list[str], schema: str) -> DataFrame:
    """Records of JSON-lines files with the file's name in ``source``. Blank lines and a torn last line are skipped."""
    rows = spark.read.schema(f"{schema}, _torn string").option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", "_torn").json(paths)
    return rows.select("*", F.col("_metadata.file_name").alias("source")).filter("_torn is null").drop("_torn")


def spread(rows: DataFrame) -> DataFrame:
    """rows dealt over all cores if they are read in fewer tasks than there are cores.

    A small file is one task whatever is computed on it. Larger inputs have
    more tasks than cores and are left as they are, without a shuffle.
    """
    cores = rows.sparkSession.sparkContext.defaultParallelism
    return rows.repartition(cores) if rows.rdd.getNumPartitions() < cores else rows


def read_array(spark: SparkSession, path: str, schema: T.DataType) -> DataFrame:
    """Elements of one JSON document that is an array, in order: (pos, value)."""
    whole = spark.read.text(path, wholetext=True)
    return whole.select(F.posexplode(F.from_json("value", T.ArrayType(schema))).alias("pos", "value"))


def append_lines(rows: DataFrame, path: str) -> None:
    """Append as JSON lines; absent values leave no key."""
    rows.write.mode("append").option("ignoreNullFields", "true").json(path)


def replace_lines(rows: DataFrame, source: str, target: str) -> None:
    """Write a new folder. Rewriting what is being read is refused."""
    if source.rstrip("/") == target.rstrip("/"):
        raise ValueError("the target must differ from the source")
    canonical(rows).write.mode("overwrite").option("ignoreNullFields", "true").json(target)


def split_write(rows: DataFrame, keep: Column, kept_path: str, reject_path: str) -> None:
    """Both sides of a condition to two folders."""
    rows.filter(keep).write.mode("append").json(kept_path)
    rows.filter(~F.coalesce(keep, F.lit(False))).write.mode("append").json(reject_path)


def canonical(rows: DataFrame) -> DataFrame:
    known = [c for c in CORPUS_COLUMNS if c in rows.columns]
    return rows.select(*known, *[c for c in rows.columns if c not in known])


def file_fingerprints(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """(path, sha8): the first 8 hex digits of each file's SHA-256."""
    files = spark.read.format("binaryFile").load(paths)
    return files.select("path", F.substring(F.sha2("content", 256), 1, 8).alias("sha8"))


def source_tag(name: Column) -> Column:
    """The tag in a file name such as bench_<tag>.jsonl: the stem without its first word."""
    return F.regexp_extract(name, r"^(?:[^_]*_)?(.+?)(?:\.[^.]*)?$", 1)


def taxonomy_names(taxonomy: DataFrame) -> DataFrame:
    """Distinct trimmed names of genres and sub-genres of 3 to 60 characters, sorted."""
    names = taxonomy.select("genre").union(taxonomy.select(F.explode("subgenres"))).select(F.trim("genre").alias("name")).distinct()
    return names.filter(F.length("name").between(3, 60)).orderBy("name")


def taxonomy_leaves(taxonomy: DataFrame, order: str = "pos") -> DataFrame:
    """(n, p) of every name: the genre itself where the name is one or comes first, else the first genre that lists it.

    order: column that gives the rows' order.
    """
    own = taxonomy.select(F.col(order).alias("at"), F.lit(-1).alias("place"), F.trim("genre").alias("n"), F.trim("genre").alias("p"))
    listed = taxonomy.select(F.col(order).alias("at"), F.posexplode("subgenres").alias("place", "n"), F.trim("genre").alias("p")).select("at", "place", F.trim("n").alias("n"), "p")
    first = own.unionByName(listed).groupBy("n").agg(F.min_by("p", F.struct("at", "place")).alias("p"))
    return first.filter(F.length("n").between(3, 60)).orderBy("n")


def leaf_index(leaves: DataFrame) -> DataFrame:
    """(idx, n, p): leaves with an index from 0 in the order of their names, numbered by first letter."""
    letter = F.ascii("n")
    sizes = {r["l"]: r["c"] for r in leaves.groupBy(letter.alias("l")).agg(F.count("*").alias("c")).collect()}
    before, total = {}, 0
    for code in sorted(sizes):
        before[code], total = total, total + sizes[code]
    if not before:
        return leaves.select(F.lit(0).cast("long").alias("idx"), "n", "p")
    start = F.create_map(*[F.lit(x) for kv in before.items() for x in kv])
    number = F.row_number().over(Window.partitionBy(letter).orderBy("n")) - 1
    return leaves.select((number + F.element_at(start, letter)).cast("long").alias("idx"), "n", "p")


def document_text(text: Column, pieces: Column) -> Column:
    """A document's text, or its pieces joined by blank lines."""
    return F.coalesce(text, F.array_join(pieces, "\n\n"))


def conversation_documents(turns: DataFrame) -> DataFrame:
    """(conv_id, text): turns in order, joined by blank lines."""
    ordered = F.transform(F.array_sort(F.collect_list(F.struct("turn", F.coalesce("text", F.lit("")).alias("text")))), lambda t: t["text"])
    return turns.groupBy("conv_id").agg(F.array_join(ordered, "\n\n").alias("text"))
