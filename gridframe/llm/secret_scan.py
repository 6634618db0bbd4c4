"""Secret scans over an incremental ledger of blobs, in DataFrame functions only.

Every version of every path is addressed by the SHA-256 of its content. The
ledger holds, for each blob, the rules (with their versions) that have been run
over it and the spans they found. A scan looks only at pairs of blob and rule
version that the ledger does not hold, once for each blob however many paths
have it, and findings are joined back to all paths.

A rule's spans are its pattern's leftmost non-overlapping matches, less those
that fail the rule's length: the text is split at the matches, and running sums
of the lengths of gaps and matches give the positions, in code points.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gridframe.operators.extent import checkpoint_once


@dataclass(frozen=True)
class Rule:
    """``least`` characters are asked of ``group``; ``hint`` matches somewhere in every text that has a span."""

    kind: str
    pattern: str
    group: int
    least: int
    hint: str
    version: int = 1

    @property
    def key(self) -> str:
        return f"{self.kind}@{self.version}"


# Kinds and patterns are fixed values: the first three as asked for, the others the public forms of these tokens.
BASE_RULES = (
    Rule("assign", r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 12, r"(?i:passw|secret|token|api_?key)"),
    # Runs are matched whole, so asking for their length here leaves the same spans.
    Rule("access", r"AKIA[A-Z0-9]{14,}", 0, 18, r"AKIA[A-Z0-9]{14}"),
    Rule("hex", r"[0-9a-f]{16,}", 0, 16, r"[0-9a-f]{16}"),
)
MORE_RULES = (
    Rule("github", r"gh[pousr]_[A-Za-z0-9]+", 0, 40, r"gh[pousr]_[A-Za-z0-9]{36}"),
    Rule("slack", r"xox[abprs]-[A-Za-z0-9-]+", 0, 20, r"xox[abprs]-[A-Za-z0-9-]{10}"),
    # A run without the two other parts matches too and fails by its length: no run is read twice.
    Rule("jwt", r"eyJ[A-Za-z0-9_-]+(\.eyJ[A-Za-z0-9_-]+\.[A-Za-z0-9_-]+)?", 1, 20, r"\.eyJ", version=2),
    Rule("private_key", r"-----BEGIN[A-Z ]*PRIVATE KEY-----[^-]*-----END[A-Z ]*PRIVATE KEY-----", 0, 60, r"PRIVATE KEY-----"),
)
RULES = BASE_RULES + MORE_RULES

LEDGER = "blob string, rules array<string>, spans array<struct<kind:string,start:bigint,stop:bigint>>"


def content_address(text: Column) -> Column:
    """Address of a version by its content; null counts as empty."""
    return F.sha2(F.coalesce(text, F.lit("")), 256)


def matches(text: Column, rule: Rule) -> Column:
    """``(gap, hit, value)`` lengths for each match of the rule's pattern, failing matches too."""
    lengths = lambda texts: F.transform(texts, lambda t: F.char_length(t))
    gaps = lengths(F.split(text, rule.pattern, -1))
    hits = lengths(F.regexp_extract_all(text, F.lit(rule.pattern), F.lit(0)))
    values = lengths(F.regexp_extract_all(text, F.lit(rule.pattern), F.lit(rule.group))) if rule.group else hits
    return F.arrays_zip(gaps.alias("gap"), hits.alias("hit"), values.alias("value"))


def scan_texts(texts: DataFrame, rules: Sequence[Rule] = RULES) -> DataFrame:
    """``blob, kind, start, stop`` of every span in rows ``blob, text, todo``; ``todo`` lists the rules to run.

    Each text is read once for each rule it has a hint of. Equal rows of a blob
    give its spans once.
    """
    due = [F.array_contains("todo", rule.key) & F.col("text").rlike(rule.hint) for rule in rules]
    found = [F.when(when, F.struct(F.lit(rule.kind).alias("kind"), F.lit(rule.least).alias("least"), matches(F.col("text"), rule).alias("matches"))) for when, rule in zip(due, rules)]
    any_due = due[0]
    for when in due[1:]:
        any_due = any_due | when
    kinds = texts.filter(any_due).select("blob", F.explode(F.array(*found)).alias("kind")).filter("kind is not null")
    rows = kinds.select("blob", "kind.kind", "kind.least", F.posexplode("kind.matches").alias("no", "m"))
    rows = rows.select("blob", "kind", "least", "no", "m.gap", "m.hit", "m.value").dropDuplicates(["blob", "kind", "no"])
    running = Window.partitionBy("blob", "kind").orderBy("no").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    stop = F.sum(F.col("gap") + F.coalesce("hit", F.lit(0))).over(running)
    placed = rows.withColumn("stop", stop).filter("value >= least")
    return placed.select("blob", "kind", (F.col("stop") - F.col("hit")).cast("bigint").alias("start"), F.col("stop").cast("bigint").alias("stop"))


def scan(versions: DataFrame, path: str = "path", text: str = "text", ledger: DataFrame | None = None, rules: Sequence[Rule] = RULES) -> tuple[DataFrame, DataFrame]:
    """New ledger rows, and ``path, blob`` of every version.

    A ledger row names the rules that it adds to its blob and what they found,
    so appending the rows to ``ledger`` makes them known to the next scan. A blob
    for which nothing is due gets no row and its text is not read again. Null
    texts are empty texts; repeated versions and versions without a path are
    versions like others.
    """
    body = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    all_versions = versions.select(F.col(f"`{path}`").alias("path"), content_address(F.col(f"`{text}`")).alias("blob"), body.alias("text"))
    paths = checkpoint_once(all_versions.select("path", "blob"))
    blobs = paths.groupBy("blob").agg(F.min("path").alias("path"))
    every = F.array(*[F.lit(rule.key) for rule in rules])
    if ledger is None:
        due = blobs.withColumn("todo", every)
    else:
        known = ledger.groupBy("blob").agg(F.flatten(F.collect_set("rules")).alias("known"))
        todo = F.array_except(every, F.coalesce("known", F.array().cast("array<string>")))
        due = blobs.join(known, "blob", "left").withColumn("todo", todo).filter(F.size("todo") > 0).drop("known")
    due = checkpoint_once(due)
    at, wanted = all_versions.alias("v"), due.alias("d")
    same = (F.col("v.blob") == F.col("d.blob")) & F.col("v.path").eqNullSafe(F.col("d.path"))
    spans = scan_texts(at.join(wanted, same).select("v.blob", "v.text", "d.todo"), rules)
    listed = F.array_sort(F.collect_list(F.struct("kind", "start", "stop"))).alias("spans")
    spans = spans.groupBy("blob").agg(listed)
    none = F.array().cast("array<struct<kind:string,start:bigint,stop:bigint>>")
    rows = due.join(spans, "blob", "left").select("blob", F.col("todo").alias("rules"), F.coalesce("spans", none).alias("spans"))
    return rows, paths


def findings(paths: DataFrame, ledger: DataFrame, rules: Sequence[Rule] = RULES) -> DataFrame:
    """``path, blob, spans`` of every version: the spans the ledger has for the given rules, by start, then by the rules' order.

    Every version has a row, with an empty list if nothing was found. Blobs with
    very many paths are joined as a skewed key, which Spark splits.
    """
    order = F.create_map(*[x for i, rule in enumerate(rules) for x in (F.lit(rule.kind), F.lit(i))])
    found = ledger.filter(F.size("spans") > 0).select("blob", F.explode("spans").alias("s")).filter(order[F.col("s.kind")].isNotNull())
    by_start = F.array_sort(F.collect_list(F.struct("s.start", order[F.col("s.kind")].alias("no"), "s.kind", "s.stop")))
    found = checkpoint_once(found.groupBy("blob").agg(by_start.alias("spans")))
    joined = paths.join(found.withColumnRenamed("blob", "__blob"), F.col("blob") == F.col("__blob"), "left").drop("__blob")
    named = F.transform("spans", lambda s: F.struct(s["kind"].alias("kind"), s["start"].alias("start"), s["stop"].alias("stop")))
    return joined.withColumn("spans", F.coalesce(named, F.array().cast("array<struct<kind:string,start:bigint,stop:bigint>>")))


def span_text(spans: Column) -> Column:
    """``kind:start:stop`` of each span, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["stop"].cast("string"))), ",")
