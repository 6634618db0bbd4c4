"""One tall values body read by many tasks.

A body is one JSON value, but Spark's text reader splits any file at a chosen
mark. Cut behind every ``]`` the pieces are small, and what a piece is follows
from counts of what lies before it: whether it begins inside a string, whether
the list of rows is open, how many rows began. Counts are summed inside a split
first and over the splits of a file then, so no task holds a body.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gridframe.functions.address import address_title
from gridframe.operators.extent import checkpoint_once
from gridframe.sources.schemas import VALUES_RECORD
from gridframe.sources.values import placed_row

# Up to the first bracket outside strings, for a piece that begins outside and inside one.
OUTSIDE = r'[^"\[]*+(?:"[^"\\]*+(?:\\.[^"\\]*+)*+"[^"\[]*+)*+\['
HEAD = {False: rf"(?s)^{OUTSIDE}", True: rf'(?s)^[^"\\]*+(?:\\.[^"\\]*+)*+"{OUTSIDE}'}
ROW_START = r"^[\s,]*\["
SPLIT = ["file", "split"]
# A split begins outside or inside a string.
WAYS = ("out", "in")
# Facts of so many splits (some 200 bytes each) are sent to every task; those of more are joined.
BROADCAST_SPLITS = 100_000
RECORD = T.StructType([field for field in VALUES_RECORD if field.name != "values"])
# Columns that _counted adds, in order.
RUNNING = ["turned", "opening", "head", *[f"{what}_{way}" for what in ("start", "end") for way in WAYS], *[f"{what}s_{way}" for what in ("start", "end") for way in WAYS]]


def read_tall_values(spark: SparkSession, path: str | list[str], positions: str = "body") -> DataFrame:
    """Grid rows of saved values responses, one body a file, each file read in as many tasks as it has splits.

    The rows are those that ``read_values`` gives. A body may be on one line or
    on many and must be saved by rows. One without values gives no rows, nor does
    a blank file. An error are: a file that ends early, a second body in it, rows
    that are not lists of plain cells, and a list of rows that only begins
    beyond the first split. The files are read twice, for the counts and for the
    rows, and first and last splits once more. A compressed file is one split.
    """
    if positions not in ("body", "range"):
        raise ValueError("positions is 'body' or 'range'")
    pieces = _pieces(spark, path)
    splits = checkpoint_once(_split_facts(_counted(pieces)))
    outer = splits.filter((F.col("split") == 0) | (F.col("ends") > 0) | (F.col("ends_before") > 0))
    bodies = checkpoint_once(_bodies(_known(_beside(_counted(pieces), outer.select(*SPLIT)), splits), splits))
    found = _known(_counted(pieces), splits.join(bodies, "file")).filter(F.col("role") == "row")
    text = F.when(F.col("opening"), _without_head()).otherwise(F.col("value"))
    keys = ["file", "workbook_id", "sheet_id", "sheet_title", "range", "row"]
    text = F.when(F.col("start"), F.regexp_replace(text, r"^[\s,]*+", "")).otherwise(text)
    parts = found.withColumn("row", F.col("rows_before") + F.col("starts") - 1).withColumn("text", text)
    # Nearly every row is one piece; only rows with a bracket inside a cell are put together.
    alone = F.col("start") & ~F.col("open")
    # Null elsewhere, so that a filter Spark moves down never parses a part of a row.
    whole = parts.filter(alone).select(*keys, F.when((F.col("role") == "row") & alone, F.col("text")).alias("text"))
    cut = parts.filter(~alone).groupBy(*keys).agg(F.array_sort(F.collect_list(F.struct("split", "at", "text"))).alias("parts"))
    joined = cut.select(*keys, F.array_join(F.transform("parts", lambda part: part["text"]), "]").alias("text"))
    rows = whole.unionAll(joined).withColumn("cells", F.from_json(F.concat("text", F.lit("]")), "array<string>", {"mode": "FAILFAST"}))
    row_idx, cells = placed_row(F.col("range"), F.col("row"), F.col("cells"), positions)
    return rows.select("workbook_id", "sheet_id", "sheet_title", row_idx.alias("row_idx"), cells.alias("cells"))


def _beside(pieces: DataFrame, facts: DataFrame) -> DataFrame:
    return pieces.join(F.broadcast(facts) if facts.count() <= BROADCAST_SPLITS else facts, SPLIT)


def _pieces(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """The text between closing brackets, with its place and what can be said of it alone."""
    read = spark.read.option("lineSep", "]").text(path)
    pieces = read.select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("split"),
        F.monotonically_increasing_id().alias("at"),
        "value",
    )
    # No escape is cut, as a bracket cannot be escaped.
    plain = F.regexp_replace("value", r"(?s)\\.", "")
    quotes = F.char_length(plain) - F.char_length(F.replace(plain, F.lit('"'), F.lit("")))
    first = F.col("split") == 0
    facts = {"odd": (quotes % 2).cast("int"), "row_like": F.rlike("value", F.lit(ROW_START))}
    for inside, pattern in HEAD.items():
        facts[f"bracket_{inside}"] = first & F.rlike("value", F.lit(pattern))
        facts[f"row_like_{inside}"] = first & F.rlike("value", F.lit(pattern + ROW_START.removeprefix("^")))
    return pieces.withColumns(facts)


def _counted(pieces: DataFrame) -> DataFrame:
    """Pieces with what their split alone tells of what lies before them, for both ways in which it may begin.

    The pieces of a split come to its task in order of ``at``, so one pass over
    them carries the counts from batch to batch; no task holds a split.
    """
    flags = [f"{what}_{way}" for what in ("start", "end") for way in WAYS]
    counts = [f"{what}s_{way}" for what in ("start", "end") for way in WAYS]
    extra = [T.StructField(name, T.BooleanType()) for name in ("turned", "opening", "head", *flags)]
    extra += [T.StructField(name, T.LongType()) for name in counts]
    schema = T.StructType([*pieces.schema.fields, *extra])
    return pieces.mapInArrow(_count_in_order, schema)


def _count_in_order(batches):
    """Running counts per split over the pieces of a task, which come split after split in order of ``at``."""
    import numpy as np
    import pyarrow as pa

    state = None
    for batch in batches:
        if batch.num_rows == 0:
            continue
        col = lambda name: batch.column(name).to_numpy(zero_copy_only=False)
        file, split = col("file"), col("split")
        odd = col("odd").astype(np.int64)
        flag = {name: col(name).astype(bool) for name in ("row_like", "bracket_True", "bracket_False", "row_like_True", "row_like_False")}
        n = batch.num_rows
        out = {name: np.zeros(n, bool) for name in ("turned", "opening", "head", "row_like")}
        out |= {f"{what}_{way}": np.zeros(n, bool) for what in ("start", "end") for way in WAYS}
        out |= {f"{what}s_{way}": np.zeros(n, np.int64) for what in ("start", "end") for way in WAYS}
        # Runs of one split within the batch.
        cut = np.flatnonzero((file[1:] != file[:-1]) | (split[1:] != split[:-1])) + 1
        for lo, hi in zip(np.concatenate(([0], cut)), np.concatenate((cut, [n])), strict=True):
            key = (file[lo], split[lo])
            if state is None or state["key"] != key:
                state = {"key": key, "odd": 0, "opened": False, "starts_out": 0, "starts_in": 0, "ends_out": 0, "ends_in": 0}
            part = slice(lo, hi)
            odd_before = state["odd"] + np.concatenate(([0], np.cumsum(odd[part])[:-1]))
            turned = odd_before % 2 == 1
            bracket = np.where(turned, flag["bracket_True"][part], flag["bracket_False"][part])
            seen = np.cumsum(bracket) > 0
            seen_before = np.concatenate(([state["opened"]], seen[:-1] | state["opened"])) if hi > lo else seen
            opening = bracket & ~seen_before
            head = (split[lo] == 0) & ~(seen | state["opened"])
            row_like = np.where(opening, np.where(turned, flag["row_like_True"][part], flag["row_like_False"][part]), flag["row_like"][part])
            out["turned"][part], out["opening"][part], out["head"][part], out["row_like"][part] = turned, opening, head, row_like
            for way, outside in zip(WAYS, (~turned, turned), strict=True):
                stands = ~head & (opening | outside)
                start, end = stands & row_like, stands & ~row_like
                out[f"start_{way}"][part], out[f"end_{way}"][part] = start, end
                out[f"starts_{way}"][part] = state[f"starts_{way}"] + np.cumsum(start)
                out[f"ends_{way}"][part] = state[f"ends_{way}"] + np.cumsum(end) - end
                state[f"starts_{way}"] += int(start.sum())
                state[f"ends_{way}"] += int(end.sum())
            state["odd"] += int(odd[part].sum())
            state["opened"] = state["opened"] or bool(seen[-1])
        columns = {name: batch.column(name) for name in batch.schema.names if name != "row_like"}
        columns["row_like"] = pa.array(out.pop("row_like"))
        columns |= {name: pa.array(values) for name, values in out.items()}
        yield pa.RecordBatch.from_pydict({name: columns[name] for name in [*batch.schema.names, *RUNNING]})


def _split_facts(counted: DataFrame) -> DataFrame:
    """Per split: whether it begins inside a string, its own ends, and the rows and ends that lie before it."""
    total = lambda name: F.sum(F.col(name).cast("int")).alias(name)
    sums = counted.groupBy(*SPLIT).agg(total("odd"), total("opening"), *[total(f"{what}_{way}") for what in ("start", "end") for way in WAYS])
    order = Window.partitionBy("file").orderBy("split").rowsBetween(Window.unboundedPreceding, -1)
    before = lambda value: F.coalesce(F.sum(value).over(order), F.lit(0))
    begun = sums.withColumn("from_inside", before(F.col("odd")) % 2 == 1)
    own = begun.withColumns({f"{what}s": F.when(F.col("from_inside"), F.col(f"{what}_in")).otherwise(F.col(f"{what}_out")) for what in ("start", "end")})
    return own.select(*SPLIT, "odd", "opening", "from_inside", "ends", before(F.col("starts")).alias("rows_before"), before(F.col("ends")).alias("ends_before"))


def _known(counted: DataFrame, facts: DataFrame) -> DataFrame:
    """Pieces with their role: ``head``, ``row``, ``end`` (what closes the list of rows) or ``tail``."""
    known = _beside(counted, facts.withColumnRenamed("ends", "all_ends").drop("odd").withColumnRenamed("opening", "openings"))
    own = lambda name: F.when(F.col("from_inside"), F.col(f"{name}_in")).otherwise(F.col(f"{name}_out")).alias(name)
    kept = [c for c in known.columns if not c.endswith(("_in", "_out"))]
    known = known.select(*kept, *[own(name) for name in ("start", "end", "starts", "ends")])
    closed = F.col("ends_before") + F.col("ends") > 0
    role = F.when(F.col("head"), "head").when(closed, "tail").when(F.col("end"), "end").otherwise("row")
    return known.withColumn("role", role).withColumn("open", (F.col("turned") != F.col("from_inside")) != (F.col("odd") == 1))


def _head() -> Column:
    return F.when(F.col("turned"), F.regexp_extract("value", HEAD[True], 0)).otherwise(F.regexp_extract("value", HEAD[False], 0))


def _without_head() -> Column:
    return F.substring("value", F.char_length(_head()) + 1, F.char_length("value"))


def _bodies(known: DataFrame, splits: DataFrame) -> DataFrame:
    """``file, workbook_id, sheet_id, sheet_title, range`` from what stands around the list of rows; faults are errors."""
    role, value = F.col("role"), F.col("value")
    around = (
        F.when(F.col("opening"), F.concat(F.regexp_replace(_head(), r"\[$", ""), F.lit("null")))
        .when(role.isin("head", "tail"), F.concat(value, F.lit("]")))
        .otherwise("")
    )
    inner = F.when(F.col("opening"), _without_head()).otherwise(value)
    parts = known.filter(~((role == "row") & ~F.col("opening"))).select("file", "split", "at", "role", around.alias("text"), ((role == "end") & F.rlike(inner, F.lit(r"\S"))).alias("odd_row"))
    gathered = parts.groupBy("file").agg(F.array_sort(F.collect_list(F.struct("split", "at", "role", "text"))).alias("parts"), F.max("odd_row").alias("odd_row"))
    text = lambda parts: F.array_join(F.transform(parts, lambda part: part["text"]), "")
    # The last piece of a file has no bracket behind it.
    last = F.element_at("parts", -1)["role"].isin("head", "tail")
    bodies = gathered.withColumns({"text": text("parts"), "tail": text(F.filter("parts", lambda part: part["role"] == "tail")), "last": last})
    files = splits.groupBy("file").agg(F.sum("odd").alias("odd"), F.sum("opening").alias("opening"), F.sum("ends").alias("ends"), F.count("*").alias("n"))
    bodies = bodies.join(files, "file").withColumn("text", F.when(F.col("last"), F.substring("text", F.lit(1), F.char_length("text") - 1)).otherwise(F.col("text")))
    bodies = bodies.filter((F.col("opening") > 0) | F.rlike("text", F.lit(r"\S")))
    record = F.from_json("text", RECORD, {"mode": "FAILFAST"})
    fault = (
        F.when((F.col("odd") % 2 == 1) | (F.col("opening") > 0) & (F.col("ends") == 0), "ends early")
        .when((F.col("opening") == 0) & (F.col("n") > 1), "has no list of rows in its first split")
        .when(F.col("odd_row"), "has rows that are not lists of cells")
        .when(F.rlike("tail", F.lit(HEAD[False])), "holds more than one body")
    )
    checked = F.when(fault.isNotNull(), F.raise_error(F.concat(F.col("file"), F.lit(" "), fault))).otherwise(F.col("text"))
    read = bodies.select("file", checked.alias("text")).select("file", record.alias("record")).select("file", "record.*")
    by_columns = F.upper("majorDimension") == "COLUMNS"
    return read.select(
        "file",
        F.coalesce("workbook_id", F.lit("")).alias("workbook_id"),
        F.coalesce("sheet_id", F.lit("")).alias("sheet_id"),
        F.coalesce("sheet_title", address_title(F.col("range"))).alias("sheet_title"),
        F.when(by_columns, F.raise_error(F.concat("file", F.lit(" is saved by columns")))).otherwise(F.col("range")).alias("range"),
    )
