"""Secret scans over an incremental blob ledger, in DataFrame functions only.

Every version of every path is content-addressed by the SHA-256 of its text.
The ledger holds one row for each (blob, rule, rule version) that was ever
scanned, with the spans found. A run scans one representative of each blob for
the pairs that the ledger lacks, adds them, and joins the findings back to all
paths. Texts move only in the join that picks representatives, which is keyed
by blob and id, so a blob with very many paths does not gather anywhere.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from prosemill.llm.runtime import cut


@dataclass(frozen=True)
class Rule:
    """A kind of secret: leftmost non-overlapping matches of pattern whose group has at least ``least`` characters.

    needs: lower-case strings of which a text (lower-cased) must hold one for
    the pattern to match at all; empty where there are none. base: counted
    among the base spans.
    """

    kind: str
    version: int
    pattern: str
    group: int = 0
    least: int = 1
    needs: tuple[str, ...] = ()
    base: bool = True


#: Fixed patterns and lengths. A maximal run under its least length never holds a passing
#: match, so the run patterns of access and hex ask for the length themselves.
RULES = (
    Rule("assign", 1, r"""((?i)password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 12, ("passw", "secret", "token", "api_key", "apikey")),
    Rule("access", 1, r"AKIA[A-Z0-9]{14,}", needs=("akia",)),
    Rule("hex", 1, r"[0-9a-f]{16,}"),
    Rule("pem", 1, r"-----BEGIN [A-Z ]*PRIVATE KEY-----", needs=("private key-----",), base=False),
)
LEDGER = "blob string, rule string, rule_version int, spans array<struct<start: bigint, `end`: bigint>>"
_BLOCK = 256


def _may_match(rule: Rule, text: Column, lowered: Column) -> Column:
    if not rule.needs:
        return text.rlike(rule.pattern)
    return reduce(or_, [lowered.contains(n) for n in rule.needs])


def _with_spans(rows: DataFrame, rule: Rule, wanted: Column) -> DataFrame:
    """Adds column s_<kind>: the spans of the rule in column text, in code points, end exclusive; null where not wanted.

    The texts between matches and the matches alternate, so positions are sums
    of their lengths, taken by blocks to stay linear.
    """
    text, k = F.col("text"), rule.kind
    look = wanted & _may_match(rule, text, F.col("lowered"))
    none = F.array().cast("array<int>")
    parts = F.when(
        look,
        F.struct(
            F.transform(F.split(text, rule.pattern), lambda g: F.length(g)).alias("gaps"),
            F.transform(F.regexp_extract_all(text, F.lit(rule.pattern), F.lit(0)), lambda m: F.length(m)).alias("hits"),
            F.transform(F.regexp_extract_all(text, F.lit(rule.pattern), F.lit(rule.group)), lambda m: F.length(m)).alias("sizes"),
        ),
    )
    rows = rows.withColumn("parts", parts)
    n = F.size(F.coalesce("parts.hits", none))
    rows = rows.withColumn("n", n).withColumn("steps", F.when(F.col("n") > 0, F.zip_with(F.slice("parts.gaps", F.lit(1), F.col("n")), "parts.hits", lambda g, h: g.cast("long") + h)))
    blocks = F.sequence(F.lit(0), ((F.col("n") - 1) / _BLOCK).cast("int"))
    zero = F.lit(0).cast("long")

    def total(part: Column) -> Column:
        return F.aggregate(part, zero, lambda a, x: a + x)

    rows = rows.withColumn("blocks", F.when(F.col("n") > 0, F.transform(blocks, lambda b: total(F.slice("steps", b * _BLOCK + 1, F.lit(_BLOCK))))))

    def ends(b: Column) -> Column:
        start = F.struct(total(F.slice("blocks", F.lit(1), b)).alias("at"), F.array().cast("array<bigint>").alias("ends"))
        return F.aggregate(F.slice("steps", b * _BLOCK + 1, F.lit(_BLOCK)), start, lambda s, x: F.struct((s["at"] + x).alias("at"), F.array_append(s["ends"], s["at"] + x).alias("ends")), lambda s: s["ends"])

    rows = rows.withColumn("ends", F.when(F.col("n") > 0, F.flatten(F.transform(blocks, ends))))
    found = F.zip_with("ends", F.arrays_zip(F.col("parts.hits").alias("hit"), F.col("parts.sizes").alias("size")), lambda e, m: F.struct((e - m["hit"]).alias("start"), e.alias("end"), m["size"].alias("size")))
    passing = F.transform(F.filter(found, lambda s: s["size"] >= rule.least), lambda s: F.struct(s["start"], s["end"]))
    empty = F.array().cast("array<struct<start: bigint, `end`: bigint>>")
    spans = F.when(wanted, F.when(F.col("n") > 0, passing).otherwise(empty))
    return rows.withColumn(f"s_{k}", spans).drop("parts", "n", "steps", "blocks", "ends")


def _unseen(blobs: DataFrame, ledger: DataFrame | None, rules: tuple[Rule, ...]) -> DataFrame:
    """(blob, rep, todo): blobs with the rules that the ledger lacks for them."""
    pairs = F.array(*[F.struct(F.lit(r.kind).alias("rule"), F.lit(r.version).alias("rule_version")) for r in rules])
    if ledger is None:
        return blobs.withColumn("todo", F.array(*[F.lit(r.kind) for r in rules]))
    asked = blobs.select("blob", "rep", F.explode(pairs).alias("p")).select("blob", "rep", "p.*")
    left = asked.join(ledger.select("blob", "rule", "rule_version"), ["blob", "rule", "rule_version"], "left_anti")
    return left.groupBy("blob").agg(F.min("rep").alias("rep"), F.collect_set("rule").alias("todo"))


def scan_versions(versions: DataFrame, ledger: DataFrame | None = None, rules: tuple[Rule, ...] = RULES, id_col: str = "doc_id", text_col: str = "text") -> tuple[DataFrame, DataFrame]:
    """(paths, ledger): every row's (doc_id, blob), and the ledger with what this run scanned.

    A null text is the empty one. Rows may repeat an id or a text: each keeps
    its own row among the paths, and each blob enters the ledger once a rule
    version. One row of a blob is scanned, the one with the least id; rows that
    repeat both this id and the text are scanned alike, and folded. ledger=None
    starts an empty one, and an empty table adds nothing. Other columns are not
    read.
    """
    rows = versions.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text")).withColumn("blob", F.sha2("text", 256))
    paths = rows.select("doc_id", "blob")
    blobs = paths.groupBy("blob").agg(F.min("doc_id").alias("rep"))
    todo = _unseen(blobs, ledger, rules).withColumnRenamed("blob", "todo_blob")
    scanned = rows.join(todo, (F.col("blob") == F.col("todo_blob")) & F.col("doc_id").eqNullSafe(F.col("rep"))).select("blob", "text", F.lower("text").alias("lowered"), "todo")
    for rule in rules:
        scanned = _with_spans(scanned, rule, F.array_contains("todo", rule.kind))
    entries = F.array(*[F.struct(F.lit(r.kind).alias("rule"), F.lit(r.version).alias("rule_version"), F.col(f"s_{r.kind}").alias("spans")) for r in rules])
    per_blob = scanned.select("blob", F.filter(entries, lambda e: e["spans"].isNotNull()).alias("entries"))
    fresh = cut(per_blob.groupBy("blob").agg(F.first("entries").alias("entries")))
    fresh = fresh.select("blob", F.explode("entries").alias("e")).select("blob", "e.*")
    return paths, fresh if ledger is None else ledger.select(fresh.columns).unionByName(fresh)


def blob_findings(ledger: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """(blob, found) of the blobs with spans of current rules: an array of (start, order, kind, end, base), sorted."""
    order = {r.kind: i for i, r in enumerate(rules)}
    current = reduce(or_, [(F.col("rule") == r.kind) & (F.col("rule_version") == r.version) for r in rules])

    def keyed(value: dict) -> Column:
        return F.element_at(F.create_map(*[F.lit(x) for kv in value.items() for x in kv]), F.col("rule"))

    number, base = keyed(order), keyed({r.kind: r.base for r in rules})
    hits = ledger.filter(current & (F.size("spans") > 0)).select("blob", F.transform("spans", lambda s: F.struct(s["start"].alias("start"), number.alias("order"), F.col("rule").alias("kind"), s["end"].alias("end"), base.alias("base"))).alias("part"))
    return cut(hits.groupBy("blob").agg(F.array_sort(F.flatten(F.collect_list("part"))).alias("found")))


def findings(paths: DataFrame, ledger: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """(doc_id, blob, found) of every path, with an empty array where nothing was found.

    What was found is written first, so a blob of very many paths can be dealt
    over many tasks in the join.
    """
    per_blob = blob_findings(ledger, rules).withColumnRenamed("blob", "found_blob")
    none = F.array().cast("array<struct<start: bigint, order: int, kind: string, `end`: bigint, base: boolean>>")
    return paths.join(per_blob, F.col("blob") == F.col("found_blob"), "left").select("doc_id", "blob", F.coalesce("found", none).alias("found"))


def written(found: Column) -> Column:
    """kind:start:end of each span, comma-joined."""
    return F.concat_ws(",", F.transform(found, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))))


def redact(text: Column, found: Column) -> Column:
    """The text with each span replaced by [SECRET]; overlapping spans become one. A null text stays null.

    What stands between the spans is listed first and joined once.
    """
    zero = F.lit(0).cast("long")
    start = F.struct(zero.alias("at"), F.array().cast("array<struct<`from`: bigint, size: bigint>>").alias("gaps"))

    def step(s: Column, x: Column) -> Column:
        gap = F.struct(s["at"].alias("from"), (x["start"] - s["at"]).alias("size"))
        return F.struct(F.greatest(s["at"], x["end"]).alias("at"), F.when(x["start"] >= s["at"], F.array_append(s["gaps"], gap)).otherwise(s["gaps"]).alias("gaps"))

    gaps = F.aggregate(found, start, step, lambda s: F.array_append(s["gaps"], F.struct(s["at"].alias("from"), F.length(text).cast("long").alias("size"))))
    kept = F.transform(gaps, lambda g: F.substring(text, (g["from"] + 1).cast("int"), g["size"].cast("int")))
    return F.when(F.size(found) > 0, F.array_join(kept, "[SECRET]")).otherwise(text)
