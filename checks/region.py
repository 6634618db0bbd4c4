"""Checks of addresses and of the region operators."""

import uuid

from pyspark.sql import functions as F

import gridframe as gf
from checks.registry import as_grid, check, table, unpivoted
from gridframe.operators.extent import checkpoint_dir

# Column letters in SQL, one case per length; each case takes off the shorter names first.
LETTERS = """
    case when n <= 26 then chr(64 + n)
        when n <= 702 then chr(65 + (n - 27) // 26) || chr(65 + (n - 27) % 26)
        when n <= 18278 then chr(65 + (n - 703) // 676) || chr(65 + (n - 703) // 26 % 26) || chr(65 + (n - 703) % 26)
        else chr(65 + (n - 18279) // 17576) || chr(65 + (n - 18279) // 676 % 26) || chr(65 + (n - 18279) // 26 % 26) || chr(65 + (n - 18279) % 26)
    end
"""
PART_LETTERS = f"select p_partkey, {LETTERS} as letters from (select p_partkey, (p_partkey + 1)::int as n from part)"


@check(PART_LETTERS)
def col_letters(spark, sf_dir):
    return table(spark, sf_dir, "part").select("p_partkey", gf.col_letters(F.col("p_partkey") + 1).alias("letters"))


@check(f"select p_partkey, letters, p_partkey + 1 as number from ({PART_LETTERS})")
def col_number(spark, sf_dir):
    letters = table(spark, sf_dir, "part").select("p_partkey", gf.col_letters(F.col("p_partkey") + 1).alias("letters"))
    return letters.withColumn("number", gf.col_number(F.col("letters")))


@check(f"""
    with o as (select o_orderkey, case when o_orderstatus = 'P' then 'Q1:Q2' else o_orderpriority end as title,
        (o_custkey % 26 + 1)::int as c0 from orders)
    select o_orderkey, case when title like '%:%' then title else title || '!' || chr(64 + c0) || (o_orderkey + 1) end as write_at,
        title || '!' || chr(64 + c0) || (o_orderkey + 1) || ':Z' as clear_to_end,
        case when title like '%:%' then title else title || '!' || chr(64 + c0) || (o_orderkey + 1) || ':AB' || (o_orderkey + 10) end as block
    from o
""")
def range_address(spark, sf_dir):
    title = F.when(F.col("o_orderstatus") == "P", "Q1:Q2").otherwise(F.col("o_orderpriority"))
    row, col = F.col("o_orderkey"), F.col("o_custkey") % 26
    return table(spark, sf_dir, "orders").select(
        "o_orderkey",
        gf.range_address(title, row, col).alias("write_at"),
        gf.range_address(title, row, col, None, 26, for_write=False).alias("clear_to_end"),
        gf.range_address(title, row, col, row + 10, 28).alias("block"),
    )


def text_cells(*columns):
    return F.array(*[F.col(c).cast("string") for c in columns])


def customer_grid(spark, sf_dir):
    cells = F.array(F.col("c_custkey").cast("string"), F.col("c_name"), F.col("c_nationkey").cast("string"), F.col("c_mktsegment"))
    return as_grid(table(spark, sf_dir, "customer"), "c_custkey", cells)


CUSTOMER_CELLS = "select c_custkey as row_idx, [c_custkey::varchar, c_name, c_nationkey::varchar, c_mktsegment] as cells from customer"


@check("""
    select l.row_idx, l.col_idx, case when l.row_idx >= 10 and l.col_idx between 1 and 2 then '' else l.value end as value from (
        select s_suppkey as row_idx, 0::int as col_idx, s_suppkey::varchar as value from supplier
        union all select s_suppkey, 1, s_name from supplier union all select s_suppkey, 2, s_nationkey::varchar from supplier
        union all select s_suppkey, 3, s_name from supplier) l
""")
def clear_region(spark, sf_dir):
    cells = F.array(F.col("s_suppkey").cast("string"), F.col("s_name"), F.col("s_nationkey").cast("string"), F.col("s_name"))
    grid = as_grid(table(spark, sf_dir, "supplier"), "s_suppkey", cells)
    return gf.grid_to_cells(gf.clear_region(grid, row=10, col=1, end_col=3)).select("row_idx", "col_idx", "value")


@check(f"""
    with t as ({CUSTOMER_CELLS}),
    p as (select o_orderkey + 5 as row_idx, [o_orderkey::varchar, o_orderstatus, o_orderpriority] as block from orders),
    j as (select row_idx, coalesce(cells, []) as cells, block from t full outer join p using (row_idx)),
    w as (select row_idx, cells, block, case when block is null then len(cells) else greatest(len(cells), 5) end as width from j)
    select row_idx, (i - 1)::int as col_idx,
        case when block is not null and i between 3 and 5 then block[i - 2] else coalesce(cells[i], '') end as value
    from w, unnest(range(1, width + 1)) as u(i)
""")
def overlay(spark, sf_dir):
    """Orders over the customer sheet from C6: the sheet grows both ways."""
    cells = F.array(F.col("o_orderkey").cast("string"), F.col("o_orderstatus"), F.col("o_orderpriority"))
    payload = as_grid(table(spark, sf_dir, "orders"), "o_orderkey", cells)
    return gf.grid_to_cells(gf.overlay(customer_grid(spark, sf_dir), payload, row=5, col=2)).select("row_idx", "col_idx", "value")


def refresh_sql(payload: str, header: str, row: int, col: int, width: int, clear: str, hidden: str) -> str:
    return f"""
        with t as ({CUSTOMER_CELLS}), p as ({payload}),
        b as (select {row} - 1 as row_idx, {header} as block union all select {row} + row_idx, block from p),
        j as (select row_idx, coalesce(cells, []) as cells, block from t full outer join b using (row_idx)),
        w as (select *, case when block is null then len(cells) else greatest(len(cells), {col + width}) end as width from j),
        c as (select row_idx, i, case when block is not null and i between {col + 1} and {col + width} then block[i - {col}]
            when {clear} then '' else coalesce(cells[i], '') end as value from w, unnest(range(1, width + 1)) as u(i)),
        h as (select row_idx, {hidden} as hidden from c group by row_idx)
        select row_idx, (i - 1)::int as col_idx, value, hidden from c join h using (row_idx)
    """


SUPPLIER_BLOCK = """select row_number() over (order by s_suppkey) - 1 as row_idx, [s_name, s_acctbal::varchar] as block from supplier"""
SUPPLIER_COLUMNS = ["s_name", "s_acctbal"]


def _refreshed(grid):
    return grid.select("row_idx", F.posexplode("cells").alias("col_idx", "value"), "hidden")


@check(refresh_sql(
    "select row_number() over (order by s_suppkey) - 1 as row_idx, [s_suppkey::varchar, s_name, s_acctbal::varchar] as block from supplier",
    "['s_suppkey', 's_name', 's_acctbal']", row=4, col=1, width=3, clear="row_idx >= 4 and i >= 2",
    hidden="row_idx > 3 and coalesce(max(case when i = 3 then value end), '') = ''",
))
def refresh(spark, sf_dir):
    """Suppliers into the customer sheet at B4; rows left blank below them are filtered out."""
    df = table(spark, sf_dir, "supplier").select("s_suppkey", "s_name", "s_acctbal")
    new = gf.refresh(
        customer_grid(spark, sf_dir), df, "wb", "Sheet1", 4, "B", ["s_suppkey"],
        apply_filter_to_column_index=2, starting_row_filter_index=3, starting_column_filter_index=1, rows_per_bucket=30,
    )
    return _refreshed(new)


@check(refresh_sql(
    "select row_number() over (order by o_orderkey) - 1 as row_idx, [o_orderkey::varchar, o_totalprice::varchar] as block from orders",
    "['o_orderkey', 'o_totalprice']", row=10, col=0, width=2, clear="row_idx >= 10 and i <= 3", hidden="false",
))
def refresh_preserving_columns(spark, sf_dir):
    """More rows than the sheet has; of its six columns the last three stay, though its rows are four wide."""
    df = table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice")
    sheets = spark.range(1).select(
        F.lit("wb").alias("workbook_id"), F.lit("0").alias("sheet_id"), F.lit("Sheet1").alias("sheet_title"), F.lit(1000).alias("row_count"), F.lit(6).alias("col_count")
    )
    return _refreshed(gf.refresh(
        customer_grid(spark, sf_dir), df, "wb", "0", 10, "A", ["o_orderkey"], sheets=sheets, preserve_last_n_columns=3, rows_per_bucket=2000
    ))


@check(refresh_sql(
    "select row_number() over (order by s_suppkey) - 1 as row_idx, [s_suppkey::varchar, s_name] as block from supplier",
    "['s_suppkey', 's_name']", row=3, col=2, width=2,
    clear="row_idx between 3 and 3 + (select count(*) from supplier) and i between 3 and 4", hidden="false",
))
def refresh_bounded(spark, sf_dir):
    """Only the rectangle of the new content, and one row more, is cleared."""
    df = table(spark, sf_dir, "supplier").select("s_suppkey", "s_name")
    return _refreshed(gf.refresh(
        customer_grid(spark, sf_dir), df, "wb", "0", 3, "C", ["s_suppkey"], do_not_clear_entire_target_sheet_range=True, rows_per_bucket=30
    ))


@check("""
    with b as (select o_orderstatus as sheet_id, o_orderkey // 500 as batch_no, min(o_orderkey) as low, max(o_orderkey) as high,
        count(*)::int as n_filled from orders group by o_orderstatus, o_orderkey // 500)
    select sheet_id, batch_no, case when sheet_id = 'P' then '''S:P''' else sheet_id end || '!A' || (low + 1) as range,
        (high - low + 1)::int as n_rows, n_filled, low::varchar as first_cell, high::varchar as last_cell
    from b
""")
def write_batches(spark, sf_dir):
    """A sheet per status, so row positions have gaps; one title holds a colon."""
    status = F.col("o_orderstatus")
    title = F.when(status == "P", F.concat(F.lit("S:"), status)).otherwise(status)
    cells = F.array(F.col("o_orderkey").cast("string"), F.col("o_orderpriority"))
    grid = as_grid(table(spark, sf_dir, "orders"), "o_orderkey", cells, sheet_id=status, title=title)
    values = F.col("values")
    return gf.write_batches(grid, rows_per_batch=500).select(
        "sheet_id",
        "batch_no",
        "range",
        F.size(values).alias("n_rows"),
        F.size(F.filter(values, lambda row: F.size(row) > 0)).alias("n_filled"),
        F.get(F.get(values, F.lit(0)), F.lit(0)).alias("first_cell"),
        F.get(F.element_at(values, -1), F.lit(0)).alias("last_cell"),
    )


@check("select o_orderkey as row_idx, o_orderkey > 10 and o_orderpriority = '1-URGENT' as hidden from orders")
def apply_filter(spark, sf_dir):
    grid = as_grid(table(spark, sf_dir, "orders"), "o_orderkey", text_cells("o_orderkey", "o_orderstatus", "o_orderpriority"))
    return gf.apply_filter(grid, filter_col=2, start_row=10, exclude="1-URGENT").select("row_idx", "hidden")


@check("select event_id as row_idx, event_id > 0 and event_type = 'error' as hidden_by_default, false as hidden from events")
def remove_filter(spark, sf_dir):
    """The default filter hides blanks, here ragged rows too; then all rows are back."""
    kind = F.col("event_type")
    cells = F.when(kind == "error", F.array().cast("array<string>")).otherwise(F.array(kind))
    grid = gf.apply_filter(as_grid(table(spark, sf_dir, "events"), "event_id", cells))
    return gf.remove_filter(grid.withColumn("hidden_by_default", F.col("hidden"))).select("row_idx", "hidden_by_default", "hidden")


@check(f"""
    select col_idx, max(length(value))::int as width
    from ({unpivoted('customer', 'c_custkey', ['c_custkey', 'c_name', 'c_nationkey', 'c_mktsegment'])}) group by col_idx
""")
def column_widths(spark, sf_dir):
    return gf.column_widths(customer_grid(spark, sf_dir)).select("col_idx", "width")


@check("""
    select lang as sheet_id, 1::int as col_idx, max(length(text))::int as width from documents group by lang
    union all select lang, 2, max(length(source))::int from documents group by lang
""")
def column_widths_of_texts(spark, sf_dir):
    """A sheet per language, whole texts, and only two of the three columns."""
    cells = F.array(F.col("doc_id").cast("string"), F.col("text"), F.col("source"))
    grid = as_grid(table(spark, sf_dir, "documents"), "doc_id", cells, sheet_id=F.col("lang"))
    return gf.column_widths(grid, start=1, end=3).select("sheet_id", "col_idx", "width")


ROUND_TRIP_TITLE = "case o_orderstatus when 'F' then 'It''s: so' when 'O' then 'Hi! there' else '''P''!A1:B2' end"


@check(f"""
    select o_orderkey as row_idx, {ROUND_TRIP_TITLE} as sheet_title, unnest([0, 1])::int as col_idx,
        unnest([o_orderkey::varchar, o_orderpriority]) as value from orders
""")
def write_batches_round_trip(spark, sf_dir):
    """Sheets whose titles need quotes, written in many batches and read back where their addresses say."""
    status = F.col("o_orderstatus")
    title = F.when(status == "F", "It's: so").when(status == "O", "Hi! there").otherwise("'P'!A1:B2")
    cells = F.array(F.col("o_orderkey").cast("string"), F.col("o_orderpriority"))
    grid = as_grid(table(spark, sf_dir, "orders"), "o_orderkey", cells, sheet_id=status, title=title)
    bodies = gf.write_batches(grid, rows_per_batch=500).drop("sheet_title", "batch_no")
    placed = gf.values_to_grid(bodies, positions="range")
    return placed.select("row_idx", "sheet_title", F.posexplode("cells").alias("col_idx", "value"))


@check("""
    with recursive d(n, rest, letters) as (
        select p_partkey, (p_partkey + 1) * 9999999967, '' from part
        union all select n, (rest - 1) // 26, chr((65 + (rest - 1) % 26)::int) || letters from d where rest > 0)
    select n as p_partkey, letters from d where rest = 0
""")
def col_letters_of_large_numbers(spark, sf_dir):
    """Column numbers far beyond seven letters."""
    number = (F.col("p_partkey") + 1) * F.lit(9999999967)
    return table(spark, sf_dir, "part").select("p_partkey", gf.col_letters(number).alias("letters"))


@check("""
    select 'keep' as sheet_id, s_suppkey as row_idx, 0::int as col_idx, s_name as value, s_suppkey % 3 = 0 as hidden from supplier
    union all select 'wide', s_suppkey, unnest([0, 1])::int, unnest([s_suppkey::varchar, s_name]), s_suppkey % 2 = 0 from supplier
""")
def stored_grid(spark, sf_dir):
    """A grid with filtered rows, stored and read again."""
    supplier = table(spark, sf_dir, "supplier")
    keep = as_grid(supplier, "s_suppkey", F.array("s_name"), sheet_id="keep").withColumn("hidden", F.col("row_idx") % 3 == 0)
    both = F.array(F.col("s_suppkey").cast("string"), "s_name")
    wide = as_grid(supplier, "s_suppkey", both, sheet_id="wide").withColumn("hidden", F.col("row_idx") % 2 == 0)
    path = f"{checkpoint_dir(spark)}/stored-grid-{uuid.uuid4().hex}"
    gf.write_grid(keep.unionAll(wide), path)
    return gf.read_grid(spark, path).select("sheet_id", "row_idx", F.posexplode("cells").alias("col_idx", "value"), "hidden")


@check(refresh_sql(
    "select row_number() over (order by s_suppkey) - 1 as row_idx, [s_suppkey::varchar, s_name] as block from supplier",
    "['s_suppkey', 's_name']", row=3, col=1, width=2, clear="row_idx >= 3 and i >= 2",
    hidden="row_idx > 2 and coalesce(max(case when i = 3 then value end), '') = ''",
).replace("select row_idx, (i - 1)::int", "select 'Sheet1' as sheet_title, row_idx, (i - 1)::int") + """
    union all select 'Nations', n_nationkey, unnest([0, 1])::int, unnest([n_nationkey::varchar, n_name]), false from nation
""")
def refresh_among_sheets(spark, sf_dir):
    """One of two sheets is refreshed; the other one's cells come through as they were."""
    cells = F.array(F.col("n_nationkey").cast("string"), "n_name")
    other = as_grid(table(spark, sf_dir, "nation"), "n_nationkey", cells, "7", "Nations")
    df = table(spark, sf_dir, "supplier").select("s_suppkey", "s_name")
    new = gf.refresh(
        customer_grid(spark, sf_dir).unionAll(other), df, "wb", "Sheet1", 3, "B", ["s_suppkey"], rows_per_bucket=200,
        apply_filter_to_column_index=2, starting_row_filter_index=2, starting_column_filter_index=1,
    )
    return new.select("sheet_title", "row_idx", F.posexplode("cells").alias("col_idx", "value"), "hidden")


@check(refresh_sql(
    """select row_number() over (order by s_suppkey) - 1 as row_idx, [s_suppkey::varchar, '<a href="' || s_name || '">go</a>'] as block from supplier""",
    "['key', 'link']", row=4, col=1, width=2, clear="row_idx >= 4 and i >= 2",
    hidden="row_idx > 3 and coalesce(max(case when i = 2 then value end), '') = ''",
).replace("select row_idx, (i - 1)::int", "select 'grid' as part, row_idx, (i - 1)::int") + """
    union all select 'html', fragment_no, 0, string_agg(html, '' order by s_suppkey), null from (
        select s_suppkey, (n - 1) // 100 as fragment_no,
            case when n = 1 then '<table border="1" class="dataframe"><tbody>' else '' end
            || '<tr><td>' || s_suppkey || '</td><td><a href="' || s_name || '">go</a></td></tr>'
            || case when n = all_n then '</tbody></table>' else '' end as html
        from (select s_suppkey, s_name, row_number() over (order by s_suppkey) as n, count(*) over () as all_n from supplier))
    group by fragment_no
    union all select 'rows', i, 0, case i when 0 then '{"values":[{"note":"n"}]}' when 4 then
        '{"values":[{"note":"m","effectiveFormat":{"horizontalAlignment":"CENTER"},"userEnteredFormat":{"horizontalAlignment":"CENTER"}}]}'
        else '{"values":[]}' end, null from range(5) t(i)
""")
def refresh_html(spark, sf_dir):
    """Suppliers pasted as HTML at B4: header, cleared region, filter, the fragments to paste and the rows with formats patched."""
    link = F.concat(F.lit('<a href="'), "s_name", F.lit('">go</a>'))
    df = table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("key"), link.alias("link"))
    saved = F.lit('[{"values":[{"note":"n"}]},{},{},{},{"values":[{"note":"m"}]}]')
    two_cells = spark.range(1).select(F.lit("wb").alias("workbook_id"), F.lit("0").alias("sheet_id"), saved.alias("row_data"))
    grid, html, rows = gf.refresh_as_html(
        customer_grid(spark, sf_dir), df, gf.row_positions(two_cells), "wb", "Sheet1", 4, "B", ["key"], rows_per_bucket=300, rows_per_fragment=100,
        horizontalAlignment="CENTER",
        apply_filter_to_column_index=1, starting_row_filter_index=3, starting_column_filter_index=1,
    )
    cells = grid.select(F.lit("grid").alias("part"), "row_idx", F.posexplode("cells").alias("col_idx", "value"), "hidden")
    no = F.lit(None).cast("boolean").alias("hidden")
    part = lambda name, row, value: (F.lit(name).alias("part"), F.col(row).alias("row_idx"), F.lit(0).alias("col_idx"), F.col(value).alias("value"), no)
    return cells.unionByName(html.select(*part("html", "fragment_no", "html"))).unionByName(gf.rows_json(rows).select(*part("rows", "row_idx", "row")))


@check(refresh_sql(
    "select row_number() over (order by s_suppkey) - 1 as row_idx, [s_suppkey::varchar, s_name] as block from supplier",
    "['s_suppkey', 's_name']", row=3, col=2, width=2,
    clear="row_idx between 3 and 3 + (select count(*) from supplier) and i between 3 and 4", hidden="false",
).replace("select row_idx, (i - 1)::int", "select 'Sheet1' as sheet_title, row_idx, (i - 1)::int") + """
    union all select 'Nations', n_nationkey, 0, n_name, n_nationkey = 3 from nation
""")
def refresh_in_place(spark, sf_dir):
    """The bounded refresh on a grid stored in chunks, read back; another sheet keeps its hidden row."""
    path = f"{checkpoint_dir(spark)}/stored-{uuid.uuid4().hex}"
    nations = as_grid(table(spark, sf_dir, "nation"), "n_nationkey", F.array("n_name"), "7", "Nations").withColumn("hidden", F.col("row_idx") == 3)
    gf.store_grid(customer_grid(spark, sf_dir).withColumn("hidden", F.col("row_idx") % 100 == 99).unionAll(nations), path, chunk_rows=400)
    df = table(spark, sf_dir, "supplier").select("s_suppkey", "s_name")
    gf.refresh_stored(spark, path, df, "wb", "Sheet1", 3, "C", ["s_suppkey"], do_not_clear_entire_target_sheet_range=True)
    return gf.read_stored(spark, path).select("sheet_title", "row_idx", F.posexplode("cells").alias("col_idx", "value"), "hidden")


@check(f"""
    with t as ({CUSTOMER_CELLS}),
    c as (
        select row_idx, i - 1 as col_idx, -1 as place, cells[i] as value from t, unnest(range(1, 5)) as u(i)
        union all select o_custkey, o_orderkey % 6, o_orderkey, o_orderkey::varchar from orders
        union all select o_custkey, o_orderkey % 6 + 1, o_orderkey, o_orderstatus from orders
        union all select o_custkey + 1, o_orderkey % 6, o_orderkey, o_orderpriority from orders),
    l as (select row_idx, col_idx, arg_max(value, place) as value from c group by row_idx, col_idx),
    w as (select row_idx, max(col_idx) as last from l group by row_idx)
    select w.row_idx, i::int as col_idx, coalesce(l.value, '') as value
    from w cross join unnest(range(0, last + 1)) as u(i) left join l on l.row_idx = w.row_idx and l.col_idx = i
""")
def overlay_blocks(spark, sf_dir):
    """A block of two ragged rows for each order, at its customer's row; many blocks overlap, the last order wins."""
    orders = table(spark, sf_dir, "orders")
    values = F.array(text_cells("o_orderkey", "o_orderstatus"), F.array("o_orderpriority"))
    blocks = orders.select(
        F.lit("wb").alias("workbook_id"), F.lit("0").alias("sheet_id"), F.col("o_orderkey").alias("place"),
        F.col("o_custkey").alias("row"), (F.col("o_orderkey") % 6).alias("col"), values.alias("values"),
    )
    return gf.grid_to_cells(gf.overlay_blocks(customer_grid(spark, sf_dir), blocks)).select("row_idx", "col_idx", "value")


@check("""
    select c_custkey as row_idx, c_custkey > 10 and (c_custkey % 3 = 0 or n_regionkey = 1) as hidden
    from customer join nation on c_nationkey = n_nationkey
""")
def apply_criteria(spark, sf_dir):
    """Two filtered columns: the names of a third of all customers, and the nations of a region."""
    value = lambda df, column, cell: df.select(
        F.lit("wb").alias("workbook_id"), F.lit("0").alias("sheet_id"), F.lit(column).alias("column"), F.col(cell).cast("string").alias("value")
    )
    names = value(table(spark, sf_dir, "customer").filter("c_custkey % 3 = 0"), 1, "c_name")
    nations = value(table(spark, sf_dir, "nation").filter("n_regionkey = 1"), 2, "n_nationkey")
    return gf.apply_criteria(customer_grid(spark, sf_dir), names.unionAll(nations), start_row=10).select("row_idx", "hidden")


# Cells of the orders before and after, where they may differ.
ORDER_VERSIONS = """
    select o_orderkey as r, u.c, case u.c when 0 then o_orderkey::varchar when 1 then o_orderstatus when 2 then o_orderpriority else '' end as a,
        case when o_orderkey % 97 = 0 then ''
            when u.c = 0 then o_orderkey::varchar
            when u.c = 1 then if(o_custkey % 3 = 0, 'X', o_orderstatus)
            when u.c = 2 then if(o_custkey % 4 < 2, 'low', o_orderpriority)
            else if(o_custkey % 5 = 0, 'new', '') end as b
    from orders, unnest([0, 1, 2, 3]) as u(c)
"""


def order_versions(spark, sf_dir):
    """The orders as a grid, and a later version: cells changed, a ragged fourth column, some rows gone."""
    orders = table(spark, sf_dir, "orders")
    old = as_grid(orders, "o_orderkey", text_cells("o_orderkey", "o_orderstatus", "o_orderpriority"))
    status = F.when(F.col("o_custkey") % 3 == 0, "X").otherwise(F.col("o_orderstatus"))
    priority = F.when(F.col("o_custkey") % 4 < 2, "low").otherwise(F.col("o_orderpriority"))
    fourth = F.when(F.col("o_custkey") % 5 == 0, F.array(F.lit("new"))).otherwise(F.array().cast("array<string>"))
    cells = F.concat(F.array(F.col("o_orderkey").cast("string"), status, priority), fourth)
    return old, as_grid(orders.filter("o_orderkey % 97 <> 0"), "o_orderkey", cells)


@check(f"""
    with d as (select *, c - row_number() over (partition by r order by c) as g from ({ORDER_VERSIONS}) where a <> b),
    s as (select r, min(c)::int as col, (max(c) + 1)::int as end_col, string_agg(b, '|' order by c) as line from d group by r, g),
    m as (select *, r - row_number() over (partition by r // 500, col, end_col order by r) as g from s)
    select 'Sheet1!' || chr(65 + col) || (min(r) + 1) as range, col, end_col, min(r) as row, max(r) + 1 as end_row, string_agg(line, '/' order by r) as cells
    from m group by r // 500, col, end_col, g
""")
def changed_blocks(spark, sf_dir):
    line = lambda cells: F.array_join(cells, "|")
    blocks = gf.changed_blocks(*order_versions(spark, sf_dir), rows_per_block=500)
    return blocks.select("range", "col", "end_col", "row", "end_row", F.array_join(F.transform("values", line), "/").alias("cells"))


@check(f"select r as row_idx, c::int as col_idx, b as value from ({ORDER_VERSIONS}) where b <> ''")
def changed_blocks_written(spark, sf_dir):
    """The blocks written into the old version give the new one."""
    old, new = order_versions(spark, sf_dir)
    written = gf.overlay_blocks(old, gf.changed_blocks(old, new))
    return gf.grid_to_cells(written).filter("value <> ''").select("row_idx", "col_idx", "value")


@check("""
    with recursive o as (
        select o_orderstatus as s, o_orderkey // 500 as b, o_orderkey as r, length(o_orderkey::varchar) + length(o_orderpriority) + 8 as n,
            row_number() over (partition by o_orderstatus, o_orderkey // 500 order by o_orderkey) as k
        from orders),
    w as (
        select s, b, r, k, n as used, 0 as part from o where k = 1
        union all
        select o.s, o.b, o.r, o.k, if(w.used + o.n + 3 * (o.r - w.r - 1) > 900, o.n, w.used + o.n + 3 * (o.r - w.r - 1)),
            w.part + if(w.used + o.n + 3 * (o.r - w.r - 1) > 900, 1, 0)
        from w join o on o.s = w.s and o.b = w.b and o.k = w.k + 1)
    select s as sheet_id, b as batch_no, part::int as part_no, s || '!A' || (min(r) + 1) as range, (max(r) - min(r) + 1)::int as n_rows, max(used)::bigint as n_bytes
    from w group by s, b, part
""")
def write_batches_by_bytes(spark, sf_dir):
    """Batches of at most 500 rows and 900 bytes, a sheet per status."""
    cells = F.array(F.col("o_orderkey").cast("string"), F.col("o_orderpriority"))
    status = F.col("o_orderstatus")
    grid = as_grid(table(spark, sf_dir, "orders"), "o_orderkey", cells, sheet_id=status, title=status)
    batches = gf.write_batches(grid, rows_per_batch=500, bytes_per_batch=900)
    # A comma behind each row but the last, and two brackets around all.
    size = (F.octet_length(F.to_json("values")) - 1).cast("bigint")
    return batches.select("sheet_id", "batch_no", "part_no", "range", F.size("values").alias("n_rows"), size.alias("n_bytes"))
