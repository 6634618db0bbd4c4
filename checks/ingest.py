"""Checks of the ingest operators."""

import uuid

from pyspark.sql import functions as F

import gridframe as gf
from checks.registry import as_grid, check, row_of, table, unpivoted
from gridframe.operators.extent import checkpoint_dir

CUSTOMER_HEADER = ["Cust Key", "Name", "Nation-Key", "Acct Bal ($)", "Mkt  Segment", "NAME"]


@check("""
    select o_orderkey::varchar as sheet_id, 0::bigint as row_idx, 0::int as col_idx, o_orderkey::varchar as value from orders
    union all select o_orderkey::varchar, 0, 1, o_orderstatus from orders
    union all select o_orderkey::varchar, 2, 0, o_orderpriority from orders
    union all select o_orderkey::varchar, 2, 1, nullif(o_orderstatus, 'F') from orders
    union all select o_orderkey::varchar, 2, 2, o_custkey::varchar from orders
""")
def values_to_grid(spark, sf_dir):
    """One saved values body per order: ragged rows, an empty row, a null cell."""
    text = lambda c: F.col(c).cast("string")
    rows = F.array(
        F.array(text("o_orderkey"), F.col("o_orderstatus")),
        F.array().cast("array<string>"),
        F.array(F.col("o_orderpriority"), F.nullif("o_orderstatus", F.lit("F")), text("o_custkey")),
    )
    body = F.to_json(F.struct(F.lit("Orders!A1:C3").alias("range"), F.lit("ROWS").alias("majorDimension"), rows.alias("values")))
    bodies = table(spark, sf_dir, "orders").select(text("o_orderkey").alias("sheet_id"), body.alias("body"))
    return gf.grid_to_cells(gf.values_to_grid(bodies, "body")).drop("workbook_id")


@check("""
    with r as (select *, row_number() over (partition by o_orderstatus order by o_orderkey) as n from orders),
    c as (select o_orderstatus as sheet_title, n + 1 as row_idx, [
        '', o_orderkey::varchar, '[' || o_orderstatus || '],["' || o_orderpriority || '\\"', case when o_custkey % 2 = 0 then o_custkey::varchar end] as cells from r
        union all select distinct o_orderstatus, 1, ['', 'key', 'text]', 'customer'] from orders)
    select sheet_title, row_idx::bigint as row_idx, (i - 1)::int as col_idx, cells[i] as value from c, unnest(range(1, 5)) as u(i)
""")
def tall_body(spark, sf_dir):
    """One saved body per order status, all its orders, brackets and quotes in the cells; the split size is the session's."""
    status, key = F.col("o_orderstatus"), F.col("o_orderkey")
    text = F.concat(F.lit("["), status, F.lit('],["'), F.col("o_orderpriority"), F.lit('\\"'))
    customer = F.when(F.col("o_custkey") % 2 == 0, F.col("o_custkey").cast("string"))
    row = F.to_json(F.array(key.cast("string"), text, customer), {"ignoreNullFields": "false"})
    orders = table(spark, sf_dir, "orders")
    head = F.concat(F.lit('{"range":"'), status, F.lit('!B2","majorDimension":"ROWS","values":[["key","text]","customer"]'))
    statuses = orders.select(status).distinct()
    lines = (
        statuses.select(status, F.lit(0).alias("part"), F.lit(None).cast("bigint").alias("o_orderkey"), head.alias("line"))
        .unionAll(orders.select(status, F.lit(1), key, F.concat(F.lit(","), row)))
        .unionAll(statuses.select(status, F.lit(2), F.lit(None), F.lit("]}")))
    )
    folder = f"{checkpoint_dir(spark)}/tall-{uuid.uuid4().hex}"
    order = ["o_orderstatus", "part", "o_orderkey"]
    lines.repartition("o_orderstatus").sortWithinPartitions(*order).select("o_orderstatus", "line").write.partitionBy("o_orderstatus").text(folder)
    return gf.read_tall_values(spark, folder, positions="range").select("sheet_title", "row_idx", F.posexplode("cells").alias("col_idx", "value"))


def orders_by_status(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    cells = F.array(F.col("o_orderkey").cast("string"), F.col("o_orderpriority"))
    return as_grid(orders, "o_orderkey", cells, sheet_id=F.ascii("o_orderstatus"), title=F.col("o_orderstatus"))


@check("select o_orderkey as row_idx, o_orderkey::varchar as c0, o_orderpriority as c1 from orders where o_orderstatus = 'F'")
def select_sheet(spark, sf_dir):
    rows = gf.select_sheet(orders_by_status(spark, sf_dir), "F")
    return rows.select("row_idx", F.get("cells", F.lit(0)).alias("c0"), F.get("cells", F.lit(1)).alias("c1"))


@check("select o_orderkey as row_idx, o_orderpriority as c1 from orders where ascii(o_orderstatus) = 79")
def select_sheet_by_id(spark, sf_dir):
    return gf.select_sheet(orders_by_status(spark, sf_dir), "79").select("row_idx", F.get("cells", F.lit(1)).alias("c1"))


@check(unpivoted("(select * from orders where o_orderkey >= 1)", "o_orderkey - 1 as row_idx", ["o_custkey", "o_orderstatus", "o_orderpriority"]))
def cell_range(spark, sf_dir):
    cells = F.array(*[F.col(c).cast("string") for c in ("o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority")])
    grid = as_grid(table(spark, sf_dir, "orders"), "o_orderkey", cells)
    return gf.grid_to_cells(gf.cell_range(grid, "B2:D")).select("row_idx", "col_idx", "value")


def events_by_user(spark, sf_dir):
    """A sheet per user, ragged by event type, with null cells; the widest rows are purchases."""
    kind = F.col("event_type")
    cells = (
        F.when(kind == "error", F.array().cast("array<string>"))
        .when(kind == "click", F.array(kind))
        .when(kind == "purchase", F.array(kind, F.lit(None).cast("string"), F.col("event_id").cast("string")))
        .otherwise(F.array(kind, F.col("event_id").cast("string")))
    )
    return as_grid(table(spark, sf_dir, "events"), "event_id", cells, sheet_id=F.col("user_id"))


EVENTS_BY_USER = """
    select user_id, event_id,
        case event_type when 'error' then [] when 'click' then [event_type]
            when 'purchase' then [event_type, null, event_id::varchar] else [event_type, event_id::varchar] end as cells
    from events
"""


@check(f"""
    with g as ({EVENTS_BY_USER}), w as (select user_id, max(len(cells)) as width from g group by user_id)
    select g.user_id::varchar as sheet_id, event_id as row_idx, (i - 1)::int as col_idx, coalesce(cells[i], '') as value
    from g join w using (user_id), unnest(range(1, width + 1)) as u(i)
""")
def pad_rows(spark, sf_dir):
    return gf.grid_to_cells(gf.pad_rows(events_by_user(spark, sf_dir))).drop("workbook_id")


@check("select event_id as row_idx, event_type as c0 from events where event_type <> 'error'")
def drop_empty_rows(spark, sf_dir):
    """Errors are rows of empty cells, views hold spaces and zeros, which are content."""
    kind = F.nullif("event_type", F.lit("error"))
    grid = as_grid(table(spark, sf_dir, "events"), "event_id", F.array(F.coalesce(kind, F.lit("")), F.lit("")))
    return gf.drop_empty_rows(grid).select("row_idx", F.get("cells", F.lit(0)).alias("c0"))


@check("""
    with r as (select *, row_number() over (partition by c_nationkey order by c_custkey) as n from customer)
    select c_nationkey::varchar as sheet_id, c_custkey as row_idx, 0::int as col_idx,
        case when n = 1 then lower(c_name) else c_name end as value, n = 1 as is_header from r
    union all
    select c_nationkey::varchar, c_custkey, 1, case when n = 1 then lower(c_mktsegment) else c_mktsegment end, n = 1 from r
""")
def promote_header(spark, sf_dir):
    """A sheet per nation whose first customer is the header row."""
    grid = as_grid(table(spark, sf_dir, "customer"), "c_custkey", F.array("c_name", "c_mktsegment"), sheet_id=F.col("c_nationkey"))
    header, body = gf.promote_header(grid)
    long = gf.grid_to_cells(body).withColumn("is_header", F.lit(False)).unionByName(
        gf.grid_to_cells(header.withColumnRenamed("header", "cells")).withColumn("is_header", F.lit(True))
    )
    return long.drop("workbook_id")


@check("""
    select c_custkey // 50 as sheet_id, (row_number() over (partition by c_custkey // 50 order by c_custkey) - 1)::int as position,
        c_mktsegment || coalesce(nullif(row_number() over (partition by c_custkey // 50, c_mktsegment order by c_custkey) - 1, 0)::varchar, '')
        as name from customer
""")
def unique_names(spark, sf_dir):
    """Headers of fifty names each."""
    customer = table(spark, sf_dir, "customer").select(F.call_function("div", F.col("c_custkey"), F.lit(50)).alias("sheet_id"), "c_custkey", "c_mktsegment")
    rows = customer.groupBy("sheet_id").agg(F.array_sort(F.collect_list(F.struct("c_custkey", "c_mktsegment"))).alias("rows"))
    names = gf.unique_names(F.transform("rows", lambda row: row["c_mktsegment"]))
    return rows.select("sheet_id", F.posexplode(names).alias("position", "name"))


@check("""
    with t as (select doc_id, 0::int as position, text as name from documents union all
        select doc_id, 1, source from documents union all select doc_id, 2, lang from documents),
    c as (select doc_id, position,
        lower(regexp_replace(regexp_replace(name, '[^a-zA-Z0-9]+', '_', 'g'), '_$', '')) as cleaned from t)
    select doc_id, position, length(cleaned)::int as n_chars, md5(cleaned) as name_md5 from c
""")
def clean_names(spark, sf_dir):
    """Whole document texts as names."""
    names = gf.clean_names(F.array("text", "source", "lang"))
    cleaned = table(spark, sf_dir, "documents").select("doc_id", F.posexplode(names).alias("position", "name"))
    return cleaned.select("doc_id", "position", F.length("name").alias("n_chars"), F.md5("name").alias("name_md5"))


def customer_cells():
    """Rendered cells: full rows, but rows of one segment end before their last two cells."""
    cells = F.array(
        F.col("c_custkey").cast("string"),
        "c_name",
        F.col("c_nationkey").cast("string"),
        gf.double_text("c_acctbal"),
        "c_mktsegment",
        F.upper("c_name"),
    )
    return F.when(F.col("c_mktsegment") == "FURNITURE", F.slice(cells, 1, 4)).otherwise(cells)


def messy_customer_sheet(spark, sf_dir):
    """A blank row, the header row, then each customer's row, followed by a blank row where the balance is negative."""
    customer = table(spark, sf_dir, "customer")
    blank = F.array(F.lit(""), F.lit(""))
    rows = customer.select(
        "c_custkey",
        F.posexplode(F.when(F.col("c_acctbal") < 0, F.array(customer_cells(), blank)).otherwise(F.array(customer_cells()))).alias("extra", "line"),
    )
    body = as_grid(rows, F.col("c_custkey") * 2 + F.col("extra") + 2, F.col("line"))
    return row_of(spark, 0, ["", ""]).unionAll(row_of(spark, 1, CUSTOMER_HEADER)).unionAll(body)


CUSTOMER_TABLE = """
    select c_custkey::varchar as cust_key, c_name as name, c_nationkey::varchar as nation_key, c_acctbal::varchar as acct_bal,
        case when c_mktsegment = 'FURNITURE' then '' else c_mktsegment end as mkt_segment,
        case when c_mktsegment = 'FURNITURE' then '' else upper(c_name) end as name1
    from customer
"""


@check(CUSTOMER_TABLE)
def read_sheet(spark, sf_dir):
    return gf.read_sheet(spark, messy_customer_sheet(spark, sf_dir), "wb", "Sheet1")


@check(f"""
    select mkt_segment, count(*) as n_customers, sum(acct_bal::decimal(18, 2))::varchar as total_balance
    from ({CUSTOMER_TABLE}) group by mkt_segment
""")
def sql_on_view(spark, sf_dir):
    """The flagship: a messy sheet becomes a view that plain SQL can ask."""
    gf.read_sheet(spark, messy_customer_sheet(spark, sf_dir), "wb", "0", temp_view_name="customer_sheet")
    return spark.sql("""
        select mkt_segment, count(*) as n_customers, cast(sum(cast(acct_bal as decimal(18, 2))) as string) as total_balance
        from customer_sheet group by mkt_segment
    """)


@check("""
    select o_orderkey::varchar as order_key, o_orderstatus as status, o_orderstatus as status1, o_orderpriority as _c3 from orders
""")
def grid_to_table(spark, sf_dir):
    cells = F.array(F.col("o_orderkey").cast("string"), "o_orderstatus", "o_orderstatus", "o_orderpriority")
    grid = row_of(spark, 0, ["Order Key", "Status", "Status?", "%"]).unionAll(
        as_grid(table(spark, sf_dir, "orders"), F.col("o_orderkey") + 1, cells)
    )
    return gf.grid_to_table(grid)


@check("""
    select 'c' as sheet_id, c_custkey + 1 as row_idx, unnest(['key', 'name', 'name1']) as name,
        unnest([c_custkey::varchar, c_name, c_mktsegment]) as value from customer
    union all
    select 's', s_suppkey + 1, unnest(['s_key', 's_name', 's_name1', '']), unnest([s_suppkey::varchar, s_name, s_nationkey::varchar, '']) from supplier
""")
def grid_to_records(spark, sf_dir):
    """Two sheets with differing headers at once; the second has a header cell without a name."""
    customer, supplier = table(spark, sf_dir, "customer"), table(spark, sf_dir, "supplier")
    key = lambda c: F.col(c).cast("string")
    grid = (
        row_of(spark, 0, ["Key", "Name", "NAME"], "c", "Customers")
        .unionAll(as_grid(customer, F.col("c_custkey") + 1, F.array(key("c_custkey"), "c_name", "c_mktsegment"), "c", "Customers"))
        .unionAll(row_of(spark, 0, ["S-Key", "S Name", "s name", ""], "s", "Suppliers"))
        .unionAll(as_grid(supplier, F.col("s_suppkey") + 1, F.array(key("s_suppkey"), F.col("s_name"), key("s_nationkey")), "s", "Suppliers"))
    )
    return gf.grid_to_records(grid).select("sheet_id", "row_idx", F.explode("record").alias("name", "value"))


@check("""
    with c as (select (c_custkey % 5)::varchar as sheet_id, c_custkey, lower(c_mktsegment) as segment,
        row_number() over (partition by c_custkey % 5, c_mktsegment order by c_custkey) - 1 as earlier from customer)
    select sheet_id, segment || coalesce(nullif(earlier, 0)::varchar, '') as name, c_custkey::varchar as value from c
""")
def records_of_wide_headers(spark, sf_dir):
    """Five sheets of hundreds of columns with few names, one record each."""
    customer = table(spark, sf_dir, "customer").select((F.col("c_custkey") % 5).alias("sheet"), "c_custkey", "c_mktsegment")
    lists = customer.groupBy("sheet").agg(F.array_sort(F.collect_list(F.struct("c_custkey", "c_mktsegment"))).alias("c"))
    rows = F.array(F.col("c.c_mktsegment"), F.col("c.c_custkey").cast("array<string>"))
    grid = as_grid(lists.select("sheet", F.posexplode(rows).alias("row", "cells")), "row", F.col("cells"), sheet_id=F.col("sheet"))
    return gf.grid_to_records(grid).select("sheet_id", F.explode("record").alias("name", "value"))
