"""URL filter by rules and by a path-template tree, in DataFrame functions only.

Rules name a host, which they fit with all its subdomains, and the start of a
path; the longest that fits decides. The other URLs are judged by templates of
their host, learnt from all pages:

1. Segments that vary by form (numbers, hexadecimal ids) become wildcards and
   equal paths of a host are counted, so that all further work is on one row per
   host and path form.
2. Level by level, down to the last segment of any path, segments with so many
   values under their parent that they must be a variable become a wildcard:
   first the words with digits among themselves, then all. Labelled sibling
   branches whose share of blocked pages does not differ significantly from that
   of all siblings merge. Levels at which a parent has a single branch are passed
   at once, so there are as many rounds as a path has branchings.
3. A template is rejected if its labelled purity, smoothed towards the share of
   blocked pages among all labelled pages, reaches the limit. A template without
   a labelled page is not rejected.

Pages that a rule decides are the labelled ones; ``labels`` may add others.
"""

from __future__ import annotations

import string
from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridframe.operators.extent import checkpoint_once

# A position is a variable if it has more values than this, and on average fewer pages for each than that.
FEW_VALUES, PAGES_PER_VALUE = 12, 3.0
# Branches whose share is within so many standard errors of their siblings' are alike.
ALIKE = 1.96
# Weight of the overall share in a template's purity, and the purity from which a template is rejected.
PRIOR_WEIGHT, REJECT = 4.0, 0.5
WILDCARD = "*"
# A segment but for its ending: a number or hexadecimal id, and any word with a digit.
ID, DIGIT_WORD = r"\d+|(?=[^.]*\d)[0-9a-fA-F-]{8,}", r"(?=[^.]*\d)[\w-]+"


@dataclass(frozen=True)
class UrlRule:
    verdict: str
    host: str
    path: str

    @property
    def text(self) -> str:
        return self.host + self.path


def host_of(url: Column) -> Column:
    """What stands between the first ``://`` and the next ``/``, ``?`` or ``#``, A-Z lower-cased; else empty."""
    return F.translate(F.regexp_extract(_after(url), r"^([^/?#]*)", 1), string.ascii_uppercase, string.ascii_lowercase)


def path_of(url: Column) -> Column:
    """What follows the host up to ``?`` or ``#``; else empty."""
    return F.regexp_extract(_after(url), r"^[^/?#]*([^?#]*)", 1)


def _after(url: Column) -> Column:
    at = F.instr(url, "://")
    return F.when(at > 0, F.substr(url, at + 3)).otherwise("")


def fits(rule: UrlRule, host: Column, path: Column) -> Column:
    return ((host == rule.host) | host.endswith("." + rule.host)) & path.startswith(rule.path)


def path_form(path: Column) -> Column:
    """Segments of a path, numbers and ids as wildcards (their ending kept)."""
    segments = F.slice(F.split(path, "/", -1), 2, 1_000_000_000)
    return F.transform(segments, lambda s: _starred(s, ID))


def _starred(segment: Column, pattern: str) -> Column:
    return F.regexp_replace(segment, rf"^(?:{pattern})(\.\w{{1,5}})?$", r"\*$1")


def _first_difference(one: Column, other: Column) -> Column:
    """Place from 0 of the first segment in which two paths differ; null if one begins with the other."""
    both = F.least(F.size(one), F.size(other))
    same = F.zip_with(F.slice(one, F.lit(1), both), F.slice(other, F.lit(1), both), lambda a, b: a == b)
    place = F.array_position(same, False)
    return F.when(place > 0, (place - 1).cast("int"))


def learn(paths: DataFrame) -> DataFrame:
    """``host, form, template`` of every row ``host, form, n, labelled, blocked`` (counts of pages)."""
    counts = ("n", "labelled", "blocked")
    parent, branch = ["host", "template"], ["host", "template", "segment"]
    active, done = checkpoint_once(paths.withColumns({"template": F.lit(""), "rest": F.col("form")})), []

    def variable(values: str, pages: str) -> Column:
        return (F.col(values) > FEW_VALUES) & (F.col(pages) < F.col(values) * PAGES_PER_VALUE)

    def text(segments: Column) -> Column:
        return F.array_join(F.transform(segments, lambda s: F.concat(F.lit("/"), s)), "")

    while True:
        # Down to the first level at which paths of a parent differ, all have the segments of the longest.
        longest = active.groupBy(parent).agg(F.max(F.struct(F.size("rest").alias("size"), "rest"))["rest"].alias("longest"))
        differ = active.join(longest, parent).withColumn("at", _first_difference(F.col("rest"), F.col("longest")))
        steps = checkpoint_once(differ.groupBy(parent).agg(F.min("at").alias("at")))
        moved = active.join(steps, parent)
        ends = F.col("at").isNull() | (F.size("rest") <= F.col("at"))
        at = F.when(ends, F.size("rest")).otherwise(F.col("at"))
        moved = moved.select("host", "form", *counts, F.concat("template", text(F.slice("rest", F.lit(1), at))).alias("template"), F.slice("rest", at + 1, F.lit(1_000_000_000)).alias("rest"))
        moved = checkpoint_once(moved)
        done.append(moved.filter(F.size("rest") == 0))
        here = moved.filter(F.size("rest") > 0).withColumn("segment", F.get("rest", F.lit(0)))
        if here.isEmpty():
            break
        branches = here.groupBy(branch).agg(*[F.sum(c).alias(c) for c in counts]).withColumn("shape", _starred(F.col("segment"), DIGIT_WORD))
        branches = checkpoint_once(branches)
        shapes = branches.filter("shape <> segment").groupBy(*parent, "shape").agg(F.count("*").alias("alike"), F.sum("n").alias("alike_n"))
        shapes = shapes.filter(variable("alike", "alike_n")).select(*parent, "shape", F.lit(True).alias("varies"))
        shaped = branches.join(shapes, [*parent, "shape"], "left")
        shaped = shaped.withColumn("word", F.when(F.col("varies") & (F.col("shape") != F.col("segment")), F.col("shape")).otherwise(F.col("segment")))
        shaped = checkpoint_once(shaped.select(*branch, "word", *counts))
        words = shaped.groupBy(*parent, "word").agg(*[F.sum(c).alias(c) for c in counts])
        words = checkpoint_once(words)
        parents = words.groupBy(parent).agg(
            F.count("*").alias("values"), F.sum("n").alias("all_n"), F.sum("labelled").alias("all_labelled"), F.sum("blocked").alias("all_blocked")
        )
        judged = words.join(parents, parent)
        share = F.col("all_blocked") / F.col("all_labelled")
        error = F.sqrt(share * (1 - share) / F.col("labelled"))
        several = F.col("all_labelled") > F.col("labelled")
        alike = (F.col("labelled") > 0) & several & (F.abs(F.col("blocked") / F.greatest("labelled", F.lit(1)) - share) <= ALIKE * error)
        named = F.when(variable("values", "all_n"), WILDCARD).when(F.coalesce(alike, F.lit(False)), WILDCARD).otherwise(F.col("word"))
        named = judged.select(*parent, "word", named.alias("named"))
        named = checkpoint_once(shaped.select(*branch, "word").join(named, [*parent, "word"]).select(*branch, "named"))
        longer = F.concat("template", F.lit("/"), "named")
        active = here.join(named, branch).select("host", "form", *counts, longer.alias("template"), F.slice("rest", 2, 1_000_000_000).alias("rest"))
        active = checkpoint_once(active)
    return reduce(DataFrame.union, done).drop("rest")


def judge(pages: DataFrame, rules: Sequence[UrlRule], url: str = "url", labels: DataFrame | None = None) -> DataFrame:
    """``pages`` with ``host, path, rule, template, verdict``; columns of these names are replaced.

    Null URLs and those without ``://`` have an empty host and path. ``rule`` is
    the text of the longest rule that fits, else null, and its verdict counts;
    rules of one text are taken in the order given. Else the verdict is that of
    the template, ``allow`` unless it is rejected.
    ``labels`` may give further labelled pages as ``host, path, blocked`` (bool).
    Repeated rows stay and count each.
    """
    taken = ("host", "path", "rule", "template", "verdict")
    rows = pages.select(*[F.col(f"`{c}`") for c in pages.columns if c not in taken or c == url])
    address = F.col(f"`{url}`")
    rows = rows.withColumns({"__host": F.coalesce(host_of(address), F.lit("")), "__path": F.coalesce(path_of(address), F.lit(""))})
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for r in sorted(rules, key=lambda r: len(r.text)):
        fit = fits(r, F.col("__host"), F.col("__path"))
        rule, verdict = F.when(fit, r.text).otherwise(rule), F.when(fit, r.verdict).otherwise(verdict)
    rows = rows.withColumns({"__rule": rule, "__by_rule": verdict})

    count = F.col("__by_rule")
    seen = rows.select(F.col("__host").alias("host"), path_form(F.col("__path")).alias("form"), F.lit(1).alias("n"), F.when(count.isNotNull(), 1).otherwise(0).alias("labelled"), F.when(count == "block", 1).otherwise(0).alias("blocked"))
    if labels is not None:
        known = F.coalesce(F.col("blocked"), F.lit(False)).cast("int")
        seen = seen.union(labels.select("host", path_form(F.col("path")), F.lit(0), F.lit(1), known))
    paths = seen.groupBy("host", "form").agg(*[F.sum(c).alias(c) for c in ("n", "labelled", "blocked")])
    learned = learn(paths)

    templates = learned.groupBy("host", "template").agg(F.sum("labelled").alias("labelled"), F.sum("blocked").alias("blocked"))
    overall = learned.agg((F.sum("blocked") / F.greatest(F.sum("labelled"), F.lit(1))).alias("share")).first()["share"] or 0.0
    purity = (F.col("blocked") + PRIOR_WEIGHT * overall) / (F.col("labelled") + PRIOR_WEIGHT)
    templates = checkpoint_once(templates.select("host", "template", F.when((F.col("labelled") > 0) & (purity >= REJECT), "block").otherwise("allow").alias("verdict")))
    by_form = learned.select("host", "form", "template").join(templates, ["host", "template"])
    by_form = checkpoint_once(by_form.select(F.col("host").alias("__h"), F.col("form").alias("__f"), "template", F.col("verdict").alias("__by_template")))
    rows = rows.withColumn("__form", path_form(F.col("__path")))
    # Every page has a template; a host with very many pages is a skewed key, which Spark splits.
    joined = rows.join(by_form, (F.col("__host") == F.col("__h")) & (F.col("__form") == F.col("__f")), "left")
    kept = [F.col(f"`{c}`") for c in pages.columns if c not in taken or c == url]
    final = F.coalesce("__by_rule", "__by_template").alias("verdict")
    return joined.select(*kept, F.col("__host").alias("host"), F.col("__path").alias("path"), F.col("__rule").alias("rule"), "template", final)
