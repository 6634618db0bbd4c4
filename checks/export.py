"""Checks of the export operators."""

from pyspark.sql import functions as F

import gridframe as gf
from checks.registry import check, table, unpivoted

# Small enough for several buckets at the smallest scale the checks run at.
ROWS_PER_BUCKET = 2_000


def text_sql(columns: dict[str, str], source: str) -> str:
    return f"select {', '.join(f'{expression} as {name}' for name, expression in columns.items())} from {source}"


LINEITEM = [
    "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount", "l_tax",
    "l_returnflag", "l_linestatus", "l_shipdate",
]
ORDERS = ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority"]
EVENTS = ["event_id", "ts", "user_id", "event_type", "value", "props"]


@check(text_sql({c: f"{c}::varchar" for c in LINEITEM}, "lineitem"))
def stringify(spark, sf_dir):
    return gf.stringify(table(spark, sf_dir, "lineitem").select(*LINEITEM))


@check(text_sql({c: f"{c}::varchar" for c in ORDERS}, "orders"))
def stringify_orders(spark, sf_dir):
    return gf.to_text(table(spark, sf_dir, "orders").select(*ORDERS))


@check(text_sql(
    {c: f"{c}::varchar" for c in EVENTS}
    | {
        "scaled": "(value * 1e12)::varchar",
        "tiny": "(value * 1e-7)::varchar",
        "whole": "(value * 1e3)::bigint::varchar",
        "day": "ts::date::varchar",
    },
    "events",
))
def stringify_events(spark, sf_dir):
    """Microsecond times, dates, and doubles on both sides of the fixed-point layout."""
    more = table(spark, sf_dir, "events").select(
        *EVENTS,
        (F.col("value") * 1e12).alias("scaled"),
        (F.col("value") * 1e-7).alias("tiny"),
        F.round(F.col("value") * 1e3).cast("bigint").alias("whole"),
        F.col("ts").cast("date").alias("day"),
    )
    return gf.to_text(more)


@check("""
    select event_id, case event_type when 'error' then 'False' else case when value > 10 then 'True' else 'False' end end as flag,
        case event_type when 'click' then '[]' else '[''' || event_type || ''', None]' end as words,
        case event_type when 'view' then '[]' else '[' || event_id::varchar || ', ' || user_id::varchar || ']' end as numbers
    from events
""")
def export_booleans_arrays(spark, sf_dir):
    kind = F.col("event_type")
    df = table(spark, sf_dir, "events").select(
        "event_id",
        F.when(kind != "error", F.col("value") > 10).alias("flag"),
        F.when(kind != "click", F.array(kind, F.lit(None).cast("string"))).alias("words"),
        F.when(kind != "view", F.array("event_id", "user_id")).alias("numbers"),
    )
    filled = gf.stringify(gf.fill_arrays(gf.fill_booleans(df)))
    return filled.withColumn("event_id", F.col("event_id").cast("bigint"))


@check("""
    select event_id, case event_type when 'click' then '' when 'view' then '' when 'error' then 'None of it' else event_type end as kind,
        case event_type when 'signup' then '' else event_type end as other from events
""")
def blank_nulls(spark, sf_dir):
    """Missing tokens, also when they are genuine text, and a text that only contains one."""
    kind = F.col("event_type")
    df = table(spark, sf_dir, "events").select(
        "event_id",
        F.when(kind == "click", "None").when(kind == "view", "nan").when(kind == "error", "None of it").otherwise(kind).alias("kind"),
        F.nullif(kind, F.lit("signup")).alias("other"),
    )
    return gf.blank_nulls(df)


@check(unpivoted(
    "(select *, row_number() over (order by o_orderkey) - 1 as row_idx from orders)", "row_idx",
    ["o_orderkey", "o_orderstatus", "o_orderpriority", "o_custkey"],
))
def export_duplicate_columns(spark, sf_dir):
    """Three columns of one name keep their own values."""
    df = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus", "o_orderpriority", "o_custkey").toDF("key", "x", "x", "x")
    cells = gf.to_cells(df, ["key"], rows_per_bucket=ROWS_PER_BUCKET)
    return gf.grid_to_cells(cells).select("row_idx", "col_idx", "value")


@check(unpivoted("(select *, row_number() over (order by o_orderkey) - 1 as row_idx from orders)", "row_idx", ORDERS))
def to_cells(spark, sf_dir):
    cells = gf.to_cells(table(spark, sf_dir, "orders").select(*ORDERS), ["o_orderkey"], rows_per_bucket=ROWS_PER_BUCKET)
    return gf.grid_to_cells(cells).select("row_idx", "col_idx", "value")


@check(unpivoted(
    "(select *, row_number() over (order by conv_id, turn) - 1 as row_idx from conversations)", "row_idx", ["conv_id", "turn", "role", "text"]
))
def to_cells_composite_key(spark, sf_dir):
    cells = gf.to_cells(table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text"), ["conv_id", "turn"], rows_per_bucket=100)
    return gf.grid_to_cells(cells).select("row_idx", "col_idx", "value")


@check("select event_id, row_number() over (order by event_type, ts, event_id) - 1 as row_idx from events")
def number_rows(spark, sf_dir):
    """A leading key of five values, so most bounds fall inside a tie."""
    numbered, _ = gf.number_rows(
        table(spark, sf_dir, "events").select("event_type", "ts", "event_id"), ["event_type", "ts", "event_id"], rows_per_bucket=ROWS_PER_BUCKET
    )
    return numbered.select("event_id", "row_idx")


CUSTOMER_ROW = """'<tr><td>' || c_custkey || '</td><td>' || c_name || '</td><td>' || c_acctbal::varchar || '</td><td>' || c_mktsegment || '</td></tr>'"""
CUSTOMER_COLUMNS = ["c_custkey", "c_name", "c_acctbal", "c_mktsegment"]


@check(f"select row_number() over (order by c_custkey) - 1 as row_idx, {CUSTOMER_ROW} as html from customer")
def to_html_rows(spark, sf_dir):
    return gf.to_html_rows(table(spark, sf_dir, "customer").select(*CUSTOMER_COLUMNS), ["c_custkey"], rows_per_bucket=400)


@check(f"""
    with r as (select (row_number() over (order by c_custkey) - 1) // 400 as fragment_no, c_custkey, {CUSTOMER_ROW} as tr from customer),
    f as (select fragment_no, string_agg(tr, '' order by c_custkey) as body from r group by fragment_no)
    select fragment_no, case when fragment_no = 0 then '<table style="color:navy" border="1" class="dataframe"><tbody>' else '' end || body
        || case when fragment_no = (select max(fragment_no) from f) then '</tbody></table>' else '' end as html
    from f
""")
def to_html_table(spark, sf_dir):
    return gf.to_html_table(
        table(spark, sf_dir, "customer").select(*CUSTOMER_COLUMNS), ["c_custkey"], table_style="color:navy", rows_per_fragment=400, rows_per_bucket=400
    )


@check("""
    select o_orderkey, (p * 0.000001::decimal(9, 6))::varchar as price, (-p)::varchar as negative, case when o_orderkey % 7 = 0 then '0.00000000' else '0.00000001' end as smallest
    from (select o_orderkey, case when o_orderkey % 7 = 0 then 0 else o_totalprice end::decimal(18, 2) as p from orders)
""")
def stringify_decimals(spark, sf_dir):
    """Decimals of small scale and zeros, with all digits of their scale."""
    seventh = F.col("o_orderkey") % 7 == 0
    price = F.when(seventh, 0).otherwise(F.col("o_totalprice")).cast("decimal(18,2)")
    smallest = F.when(seventh, F.lit("0")).otherwise(F.lit("0.00000001")).cast("decimal(20,8)")
    orders = table(spark, sf_dir, "orders").select(
        F.col("o_orderkey"), (price * F.lit("0.000001").cast("decimal(9,6)")).alias("price"), (-price).alias("negative"), smallest.alias("smallest")
    )
    return gf.stringify(orders).withColumn("o_orderkey", F.col("o_orderkey").cast("bigint"))


@check("select event_type, row_number() over (order by event_type) - 1 as row_idx from events")
def number_rows_with_copies(spark, sf_dir):
    """Nothing but exact copies, far more of each than a bucket holds."""
    numbered, _ = gf.number_rows(table(spark, sf_dir, "events").select("event_type"), ["event_type"], rows_per_bucket=500)
    return numbered
