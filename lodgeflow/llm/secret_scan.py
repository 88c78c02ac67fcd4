"""Secret scans over an incremental blob ledger, in DataFrame functions only.

Every version of every path is addressed by the SHA-256 of its content.  The ledger is
a table of (blob, rule@version pairs already scanned, findings); a scan looks only at
blobs and rule versions that the ledger lacks, appends what it finds, and joins the
findings of all blobs back to every path that holds them.  Copies are scanned once.

Spans are in code points, end exclusive; matches of a rule are leftmost and do not
overlap, and those that fail the rule's length are dropped after matching.

Defined results: null and empty content is the empty blob, without findings; repeated
rows each keep their findings; an empty table gives an empty result and leaves the ledger
as it is; other columns of the input come back as they are, but those named blob or findings
are replaced.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from functools import reduce
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import save, scratch_path, table_or_none, text_of


class Rule(NamedTuple):
    kind: str
    version: int
    pattern: str
    #: Group whose length counts, and its least number of characters.
    group: int
    least: int
    #: One of these stands in every text that matches.
    needs: tuple[str, ...] = ()

    @property
    def key(self) -> str:
        return f"{self.kind}@{self.version}"


#: The rules of the base scan, in their order.
BASE_RULES = (
    Rule("assign", 1, r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 6),
    Rule("access", 1, r"AKIA[A-Z0-9]+", 0, 20, ("AKIA",)),
    Rule("hex", 1, r"[0-9a-f]+", 0, 24),
)
#: Public token formats added to them.
MORE_RULES = (
    Rule("github", 1, r"gh[pousr]_[A-Za-z0-9]{36,}", 0, 40, ("ghp_", "gho_", "ghu_", "ghs_", "ghr_")),
    Rule("jwt", 1, r"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}", 0, 20, ("eyJ",)),
    Rule("pem", 1, r"-----BEGIN [A-Z ]{0,40}PRIVATE KEY-----", 0, 20, ("-----BEGIN ",)),
    Rule("slack", 1, r"xox[abprs]-[A-Za-z0-9-]{10,}", 0, 15, ("xox",)),
)
RULES = BASE_RULES + MORE_RULES

SPAN = "array<struct<start:bigint,end:bigint,rule:string>>"
FINDINGS = "array<struct<start:bigint,rank:int,end:bigint,kind:string>>"
LEDGER = f"blob string, rules array<string>, findings {SPAN}"


def screen(text: Column, rule: Rule) -> Column:
    """Whether the text can hold a finding: what fails this has none."""
    if rule.needs:
        return reduce(lambda a, b: a | b, [F.contains(text, F.lit(n)) for n in rule.needs])
    if rule.kind == "hex":
        return F.rlike(text, F.lit(f"[0-9a-f]{{{rule.least}}}"))
    return F.rlike(text, F.lit(rule.pattern))


#: Least number of elements in a block of a long array.
LEAST_BLOCK = 64


def given(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use`` of a value that is computed once, however often ``use`` names it."""
    return F.element_at(F.transform(F.array(value), use), 1)


def in_blocks(array: Column) -> Column:
    """The array in blocks of about the square root of its size.  An accumulator is copied at
    each step, so that one over n elements costs n * n; over blocks, and over elements in a
    block, it costs n to the power of 1.5."""
    def cut(whole: Column) -> Column:
        n = F.size(whole)
        size = F.greatest(F.lit(LEAST_BLOCK), F.ceil(F.sqrt(n)).cast("int"))
        blocks = F.sequence(F.lit(0), F.floor((n - 1) / size).cast("int"))
        return F.when(n > 0, F.transform(blocks, lambda k: F.slice(whole, k * size + 1, size)))

    return given(array, lambda whole: F.coalesce(cut(whole), F.slice(F.array(whole), 1, 0)))


def begins(blocks: Column, reach: Callable[[Column, Column], Column]) -> Column:
    """What ``reach`` (of the value before a block, and the block) has come to before each block."""
    zero = F.struct(F.lit(0).cast("long").alias("at"), F.array().cast("array<bigint>").alias("all"))
    return F.aggregate(blocks, zero, lambda acc, block: F.struct(
        reach(acc["at"], block).alias("at"), F.concat(acc["all"], F.array(acc["at"])).alias("all")),
        lambda acc: acc["all"])


def spans(text: Column, rule: Rule) -> Column:
    """Spans of one rule: the gaps and the matches alternate, so running sums of
    their lengths give the places."""
    none = F.array().cast(SPAN)
    gaps, hits = F.split(text, rule.pattern, -1), F.regexp_extract_all(text, F.lit(rule.pattern), F.lit(0))
    groups = F.regexp_extract_all(text, F.lit(rule.pattern), F.lit(rule.group)) if rule.group else hits
    lengths = F.transform(F.arrays_zip(gaps.alias("g"), hits.alias("m"), groups.alias("v")),
                          lambda x: F.struct(F.length(x["g"]).cast("long").alias("g"),
                                             F.coalesce(F.length(x["m"]), F.lit(0)).cast("long").alias("m"),
                                             F.length(x["v"]).cast("long").alias("v")))

    def step(acc: Column, x: Column) -> Column:
        start = acc["at"] + x["g"]
        end = start + x["m"]
        span = F.array(F.struct(start.alias("start"), end.alias("end"), F.lit(rule.key).alias("rule")))
        return F.struct(end.alias("at"), F.when(
            x["v"] >= rule.least, F.concat(acc["found"], span)).otherwise(acc["found"]).alias("found"))

    def block_spans(at: Column, block: Column) -> Column:
        zero = F.struct(at.alias("at"), none.alias("found"))
        return F.aggregate(block, zero, step, lambda acc: acc["found"])

    def reach(at: Column, block: Column) -> Column:
        return F.aggregate(block, at, lambda acc, x: acc + x["g"] + x["m"])

    found = given(in_blocks(lengths), lambda blocks: F.flatten(F.transform(
        F.arrays_zip(begins(blocks, reach).alias("at"), blocks.alias("block")),
        lambda x: block_spans(x["at"], x["block"]))))
    return F.when(screen(text, rule), found).otherwise(none)


def unseen(rules: tuple[Rule, ...], seen: Column) -> Column:
    return F.array_except(F.array(*[F.lit(r.key) for r in rules]), F.coalesce(seen, F.array().cast("array<string>")))


def scan_history(versions: DataFrame, content: str, ledger: str,
                 rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """``versions`` with columns ``blob`` and ``findings`` (spans by start, then rule),
    of the given rules in their given versions.

    ``ledger`` is a folder in the shared store; each scan appends one run to it.  A run
    that dies leaves nothing there, and the next one scans its blobs again.
    """
    spark = versions.sparkSession
    text = text_of(content)
    known = table_or_none(spark, f"{ledger}/*", LEDGER)
    blobs = versions.select(F.sha2(text, 256).alias("blob"), text.alias("text")).dropDuplicates(["blob"])
    todo = F.array(*[F.lit(r.key) for r in rules])
    if known is None:
        blobs = blobs.withColumn("todo", todo)
    else:
        # Runs of a ledger from before findings had versions are scanned again.
        known = known.where(~F.exists("findings", lambda x: x["rule"].isNull()))
        seen = known.groupBy("blob").agg(F.array_distinct(F.flatten(F.collect_list("rules"))).alias("seen"))
        blobs = (blobs.join(seen, "blob", "left").withColumn("todo", unseen(rules, F.col("seen")))
                 .where(F.size("todo") > 0).select("blob", "text", "todo"))
    each = [F.when(F.array_contains("todo", r.key), spans(F.col("text"), r)).otherwise(F.array().cast(SPAN))
            for r in rules]
    scanned = blobs.select("blob", F.col("todo").alias("rules"), F.concat(*each).alias("findings"))
    run = f"{ledger}/run-{uuid.uuid4().hex}"
    save(scanned, run)
    # Ranks and kinds are those of the wanted rules, whatever scan found them.
    rank = F.array_position(todo, F.col("f.rule")).cast("int") - 1
    kind = F.element_at(F.array(*[F.lit(r.kind) for r in rules]), rank + 1)
    rows = (spark.read.schema(LEDGER).parquet(f"{ledger}/*").where(F.size("findings") > 0)
            .select("blob", F.explode("findings").alias("f"))
            .where(F.col("f.rule").isin([r.key for r in rules]))
            .select("blob", F.struct("f.start", rank.alias("rank"), "f.end", kind.alias("kind")).alias("f")))
    by_blob = rows.groupBy("blob").agg(F.array_sort(F.collect_set("f")).alias("_found"))
    rows = versions.select(F.struct("*").alias("_row"), F.sha2(text, 256).alias("blob")).join(by_blob, "blob", "left")
    own = [F.col(f"_row.`{c}`").alias(c) for c in versions.columns if c.lower() not in ("blob", "findings")]
    return rows.select(*own, "blob", F.coalesce("_found", F.array().cast(FINDINGS)).alias("findings"))


def digest(findings: Column) -> Column:
    return F.array_join(F.transform(findings, lambda x: F.concat_ws(
        ":", x["kind"], x["start"].cast("string"), x["end"].cast("string"))), ",")


def secret_digests(documents: DataFrame, ledger: str | None = None,
                   rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """Counts and span digests of each document, by a scan into ``ledger`` (a new one if none is given)."""
    ledger = ledger or scratch_path(documents.sparkSession, "secret-ledger")
    docs = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text"))
    found = scan_history(docs, "text", ledger, rules)
    base = F.filter("findings", lambda x: x["rank"] < len(BASE_RULES))

    def count(rank: int) -> Column:
        return F.size(F.filter("findings", lambda x: x["rank"] == rank)).cast("long")

    return found.select("doc_id", count(0).alias("n_assign"), count(1).alias("n_access"), count(2).alias("n_hex"),
                        F.sha2(digest(base), 256).alias("base_sha256"), digest(F.col("findings")).alias("spans"))


def redacted(text: Column, findings: Column) -> Column:
    """The text with each stretch of findings replaced by the first one's kind in brackets.

    Each block of findings works on its own part of the text, from where the findings before it
    end; places count from the start of that part."""
    def reach(at: Column, block: Column) -> Column:
        return F.greatest(at, F.array_max(F.transform(block, lambda x: x["end"])))

    def part(at: Column, block: Column) -> Column:
        longest = F.greatest(F.lit(0).cast("long"), F.element_at(block, -1)["start"] - at)
        return F.substring(text, (at + 1).cast("int"), longest.cast("int"))

    def block_text(x: Column) -> Column:
        def step(acc: Column, f: Column) -> Column:
            ahead = f["start"] >= acc["at"]
            gap = F.substring(x["part"], (acc["at"] - x["at"] + 1).cast("int"), (f["start"] - acc["at"]).cast("int"))
            return F.struct(F.greatest(acc["at"], f["end"]).alias("at"), F.when(ahead, F.concat(
                acc["out"], gap, F.lit("["), f["kind"], F.lit("]"))).otherwise(acc["out"]).alias("out"))

        return F.aggregate(x["block"], F.struct(x["at"].alias("at"), F.lit("").alias("out")), step, lambda acc: acc["out"])

    def whole(blocks: Column) -> Column:
        rows = F.arrays_zip(begins(blocks, reach).alias("at"), blocks.alias("block"))
        parts = F.transform(rows, lambda x: F.struct(
            x["at"].alias("at"), x["block"].alias("block"), part(x["at"], x["block"]).alias("part")))
        end = F.array_max(F.transform(findings, lambda x: x["end"]))
        return F.concat(F.array_join(F.transform(parts, block_text), ""),
                        F.substring(text, (end + 1).cast("int"), F.length(text)))

    return F.when(F.size(findings) == 0, text).otherwise(given(in_blocks(findings), whole))


def without_secrets(documents: DataFrame, ledger: str | None = None,
                    rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """The documents with their secrets redacted in ``text``, all other columns as they are."""
    ledger = ledger or scratch_path(documents.sparkSession, "secret-ledger")
    rest = [F.col(c) for c in documents.columns if c != "text"]
    found = scan_history(documents.select(F.struct(*rest).alias("row"), "text"), "text", ledger, rules)
    return found.select(*[redacted(F.col("text"), F.col("findings")).alias(c) if c == "text"
                          else F.col(f"row.`{c}`").alias(c) for c in documents.columns])
