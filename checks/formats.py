"""Checks of the cell-metadata operators and of links."""

from pyspark.sql import functions as F

import gridframe as gf
from checks.registry import check, table

FORMAT = "struct<horizontalAlignment:string,verticalAlignment:string,wrapStrategy:string,textFormat:struct<fontFamily:string,fontSize:int>>"


def cell_format(horizontal=None, vertical=None, wrap=None, family=None, size=None, text=False):
    """A format as a column; without family and size its text format is left out unless asked for."""
    font = F.struct(F.lit(family).alias("fontFamily"), F.lit(size).cast("int").alias("fontSize"))
    return F.struct(
        F.lit(horizontal).alias("horizontalAlignment"),
        F.lit(vertical).alias("verticalAlignment"),
        F.lit(wrap).alias("wrapStrategy"),
        (font if text or family or size else F.lit(None)).alias("textFormat"),
    ).cast(FORMAT)


def events_metadata(spark, sf_dir):
    """A sheet per event, as saved JSON: a row of one cell, a row without cells, a row of two cells.

    The first cell of the last row has formats by event type: none at all, both
    with fonts, an effective one without font, or a user one without font.
    """
    kind = F.col("event_type")
    effective = (
        F.when(kind == "view", cell_format(family="Arial", size=8))
        .when(kind == "purchase", cell_format(horizontal="RIGHT"))
        .when(kind != "click", cell_format(family="Arial"))
    )
    user = F.when(kind == "view", cell_format(vertical="TOP", family="Old")).when(
        kind.isin("error", "signup"), cell_format(wrap="CLIP")
    )

    def cell(text, effective_format, user_format):
        return F.struct(
            text.cast("string").alias("formattedValue"), effective_format.alias("effectiveFormat"), user_format.alias("userEnteredFormat")
        )

    none = F.lit(None).cast(FORMAT)
    top = F.array(cell(kind, cell_format(horizontal="LEFT"), cell_format(wrap="WRAP")))
    last = F.array(cell(F.col("event_id"), effective, user), cell(F.col("user_id"), none, none))
    without_cells = F.when(F.lit(False), last)
    rows = F.array(*[F.struct(cells.alias("values")) for cells in (top, without_cells, last)])
    return table(spark, sf_dir, "events").select(
        F.lit("wb").alias("workbook_id"), F.col("event_id").cast("string").alias("sheet_id"), F.to_json(rows).alias("row_data")
    )


def events_meta(spark, sf_dir):
    return gf.read_cell_meta(events_metadata(spark, sf_dir))


def flat(meta):
    """The scalar content of cell metadata."""

    def parts(side, prefix):
        text = F.col(side)["textFormat"]
        return [
            F.col(side)["horizontalAlignment"].alias(f"{prefix}_horizontal"),
            F.col(side)["verticalAlignment"].alias(f"{prefix}_vertical"),
            F.col(side)["wrapStrategy"].alias(f"{prefix}_wrap"),
            text["fontFamily"].alias(f"{prefix}_family"),
            text["fontSize"].alias(f"{prefix}_size"),
        ]

    return meta.select(
        "sheet_id", "row_idx", "col_idx", F.col("formatted_value").alias("text"),
        *parts("effective_format", "effective"), *parts("user_entered_format", "user"),
    )


META = """
    select event_id::varchar as sheet_id, 0::bigint as row_idx, 0::int as col_idx, event_type as text, event_type as kind,
        'LEFT' as effective_horizontal, null::varchar as effective_vertical, null::varchar as effective_wrap,
        null::varchar as effective_family, null::int as effective_size, false as effective_text,
        null::varchar as user_horizontal, null::varchar as user_vertical, 'WRAP' as user_wrap, null::varchar as user_family,
        null::int as user_size from events
    union all
    select event_id::varchar, 2, 0, event_id::varchar, event_type, case event_type when 'purchase' then 'RIGHT' end, null, null,
        case when event_type not in ('click', 'purchase') then 'Arial' end, case event_type when 'view' then 8 end,
        event_type not in ('click', 'purchase'),
        null, case event_type when 'view' then 'TOP' end, case when event_type in ('error', 'signup') then 'CLIP' end,
        case event_type when 'view' then 'Old' end, null from events
    union all
    select event_id::varchar, 2, 1, user_id::varchar, event_type, null, null, null, null, null, false, null, null, null, null, null from events
"""


def meta_sql(replace: str = "") -> str:
    changed = f" replace ({replace})" if replace else ""
    return f"select * exclude (kind, effective_text){changed} from ({META})"


CENTERED = """
    case when row_idx >= 2 then 'CENTER' else effective_horizontal end as effective_horizontal,
    case when row_idx >= 2 then 'MIDDLE' else effective_vertical end as effective_vertical,
    case when row_idx >= 2 then 'CENTER' else user_horizontal end as user_horizontal,
    case when row_idx >= 2 then 'MIDDLE' else {vertical} end as user_vertical
"""
# A given size replaces; the family stays the effective one and the user's old one goes.
SIZED = """
    case when row_idx >= 2 and effective_text then 11 else effective_size end as effective_size,
    case when row_idx >= 2 then effective_family else user_family end as user_family,
    case when row_idx >= 2 then 11 else user_size end as user_size
"""
CLEARED = """
    case when row_idx < 2 then user_vertical end as user_vertical, case when row_idx < 2 then user_wrap end as user_wrap,
    case when row_idx < 2 then user_family end as user_family
"""


@check(meta_sql())
def read_cell_meta(spark, sf_dir):
    return flat(events_meta(spark, sf_dir))


@check(meta_sql(CLEARED))
def clear_formats(spark, sf_dir):
    return flat(gf.clear_formats(events_meta(spark, sf_dir), from_row=3))


@check(meta_sql(CENTERED.format(vertical="user_vertical")))
def align(spark, sf_dir):
    return flat(gf.align(events_meta(spark, sf_dir), 2, horizontal="CENTER", vertical="MIDDLE"))


@check(meta_sql(SIZED))
def set_font(spark, sf_dir):
    return flat(gf.set_font(events_meta(spark, sf_dir), 2, size=11))


@check(f"""
    with done as ({meta_sql(CENTERED.format(vertical="user_vertical") + ", case when row_idx < 2 then user_wrap end as user_wrap, " + SIZED)})
    select *, 0::int as empty_rows from done
    union all
    select event_id::varchar, 1, null, null, null, null, null, null, null, null, null, null, null, null, 1 from events
""")
def refresh_formats(spark, sf_dir):
    """The whole patch of a sheet pushed as HTML, cells nested in their rows."""
    rows = gf.refresh_formats(
        gf.row_positions(events_metadata(spark, sf_dir)), 2, horizontalAlignment="CENTER", verticalAlignment="MIDDLE", fontSize=11
    )
    cells = rows.select("sheet_id", "row_idx", F.posexplode_outer("values").alias("col_idx", "cell"))
    named = cells.select(
        "sheet_id",
        "row_idx",
        "col_idx",
        F.col("cell")["formattedValue"].alias("formatted_value"),
        F.col("cell")["effectiveFormat"].alias("effective_format"),
        F.col("cell")["userEnteredFormat"].alias("user_entered_format"),
    )
    return flat(named).withColumn("empty_rows", F.col("col_idx").isNull().cast("int"))


@check(meta_sql(CENTERED.format(vertical="user_vertical") + ", " + SIZED))
def styled_patches(spark, sf_dir):
    """Alignment and font by a dictionary of formats: the cells change nothing but ids."""
    cells, styles = gf.restyle(*gf.read_styled(events_metadata(spark, sf_dir)), 2, horizontal="CENTER", vertical="MIDDLE", size=11)
    return flat(gf.styled_meta(cells, styles))


def orders_with_formats(spark, sf_dir):
    """A sheet saved in a segment per order: two cells, formats by priority and status, members without a name on every level."""
    key, priority, status = F.col("o_orderkey").cast("string"), F.col("o_orderpriority"), F.col("o_orderstatus")
    saved = F.concat(
        F.lit('[{"values":[{"formattedValue":"'), key, F.lit('","pivot":{"id":'), key, F.lit('},"effectiveFormat":{"padding":{"top":"'), priority,
        F.lit('"},"textFormat":{"fontSize":9,"style":"'), status, F.lit('"}}},{"note":"'), status, F.lit('","userEnteredFormat":{"borders":["'), priority,
        F.lit('"]}}]}]'),
    )
    return table(spark, sf_dir, "orders").select(
        F.lit("wb").alias("workbook_id"), F.lit("0").alias("sheet_id"), F.col("o_orderkey").alias("start_row"), saved.alias("row_data")
    )


@check("""
    select o_orderkey as row_idx, o_orderkey::varchar as text, o_orderkey::varchar as pivot_id, o_orderpriority as padding, o_orderstatus as style,
        '12' as size, o_orderstatus as user_style, o_orderstatus as note, o_orderpriority as border, '12' as second_size, true as no_effective_font
    from orders
""")
def styled_round_trip(spark, sf_dir):
    """Written from cells with style ids after a change of font."""
    written = gf.styled_rows_json(*gf.restyle(*gf.read_styled(orders_with_formats(spark, sf_dir)), 0, size=12))
    member = lambda path: F.get_json_object("row", f"$.values{path}")
    paths = {
        "text": "[0].formattedValue", "pivot_id": "[0].pivot.id", "padding": "[0].effectiveFormat.padding.top", "style": "[0].effectiveFormat.textFormat.style",
        "size": "[0].effectiveFormat.textFormat.fontSize", "user_style": "[0].userEnteredFormat.textFormat.style", "note": "[1].note",
        "border": "[1].userEnteredFormat.borders[0]", "second_size": "[1].userEnteredFormat.textFormat.fontSize",
    }
    without = member("[1].effectiveFormat.textFormat").isNull().alias("no_effective_font")
    return written.select("row_idx", *[member(path).alias(name) for name, path in paths.items()], without)


@check("""
    select '{"padding":{"top":"' || o_orderpriority || '"},"textFormat":{"fontSize":9,"style":"' || o_orderstatus || '"}}' as effective, null::varchar as user,
        count(*) as cells from orders group by o_orderpriority, o_orderstatus
    union all
    select null, '{"borders":["' || o_orderpriority || '"]}', count(*) from orders group by o_orderpriority
""")
def style_counts(spark, sf_dir):
    """The dictionary of formats as saved, and how many cells have each."""
    cells, styles = gf.read_styled(orders_with_formats(spark, sf_dir))
    counts = cells.groupBy("style_id").agg(F.count("*").alias("cells"))
    effective, user = F.col("effective_format"), F.col("user_entered_format")
    text = F.concat(
        F.lit('{"padding":{"top":"'), F.variant_get(effective["extra"]["padding"], "$.top", "string"), F.lit('"},"textFormat":{"fontSize":'),
        effective["textFormat"]["fontSize"].cast("string"), F.lit(',"style":"'), F.expr("effective_format.textFormat.extra['style']::string"), F.lit('"}}'),
    )
    border = F.concat(F.lit('{"borders":["'), F.variant_get(user["extra"]["borders"], "$[0]", "string"), F.lit('"]}'))
    return styles.join(counts, "style_id").select(text.alias("effective"), border.alias("user"), "cells")


RUNS = "array<struct<startIndex:int,format:struct<bold:boolean,fontFamily:string,fontSize:int,link:struct<uri:string>>>>"


def pages_meta(spark, sf_dir):
    """A sheet per page with one cell; hyperlink, runs and formula by the length of the address.

    0 no hyperlink, 1 runs absent, 2 no runs, 3 two runs without link, 4 a run
    with a link, 5 a link formula, 6 another formula.
    """
    kind = F.length("url") % 7
    saved = (
        F.when(kind == 2, "[]")
        .when(kind == 4, '[{"startIndex":1,"format":{"link":{"uri":"kept"}}}]')
        .when(kind.isin(0, 3), '[{"format":{"bold":true,"fontFamily":"A","fontSize":9}},{"startIndex":4,"format":{"fontFamily":"B"}}]')
    )
    formula = F.when(kind == 5, '=HYPERLINK("u","t")').when(kind == 6, "=A1")
    return table(spark, sf_dir, "pages").select(
        F.lit("wb").alias("workbook_id"),
        F.col("page_id").cast("string").alias("sheet_id"),
        F.lit(0).cast("bigint").alias("row_idx"),
        F.lit(0).alias("col_idx"),
        F.when(kind != 0, F.col("url")).alias("hyperlink"),
        F.struct(formula.alias("formulaValue")).alias("user_entered_value"),
        F.from_json(saved, RUNS).alias("text_format_runs"),
    )


def flat_runs(meta):
    run = F.get("text_format_runs", F.lit(0))
    return meta.select(
        "sheet_id",
        F.coalesce(F.size("text_format_runs"), F.lit(-1)).alias("n_runs"),
        run["startIndex"].alias("start"),
        run["format"]["bold"].alias("bold"),
        run["format"]["fontFamily"].alias("family"),
        run["format"]["fontSize"].alias("size"),
        run["format"]["link"]["uri"].alias("uri"),
    )


def runs_sql(linked: str, merged: str) -> str:
    """Runs by kind of page; ``linked`` kinds get a new run, ``merged`` kinds one run of all formats."""
    return f"""
        select page_id::varchar as sheet_id,
            case when k in ({linked}) or k in ({merged}) then 1 when k in (0, 3) then 2 when k = 4 then 1 when k = 2 then 0 else -1 end::int as n_runs,
            case when k = 4 then 1 end::int as start, case when k in (0, 3) then true end as bold,
            case when k = 3 and k in ({merged}) then 'B' when k in (0, 3) then 'A' end as family,
            case when k in (0, 3) then 9 end::int as size,
            case when k in ({linked}) or k in ({merged}) then url when k = 4 then 'kept' end as uri
        from (select *, length(url) % 7 as k from pages)
    """


@check(runs_sql(linked="1, 6", merged="-1"))
def link_runs(spark, sf_dir):
    return flat_runs(gf.link_runs(pages_meta(spark, sf_dir), 0))


@check(runs_sql(linked="1, 6", merged="2, 3"))
def merge_link_runs(spark, sf_dir):
    return flat_runs(gf.merge_link_runs(gf.link_runs(pages_meta(spark, sf_dir), 0), 0))


@check("""
    select o_orderkey as row_idx, case o_orderstatus when 'F' then 0 else 3 end::int as n_cells,
        case o_orderstatus when 'F' then '' else o_orderkey || '|' || o_orderstatus || '|' || o_orderpriority end as in_order
    from orders
""")
def assemble_rows(spark, sf_dir):
    """Cells arrive by column, not by row; some rows have none."""
    orders = table(spark, sf_dir, "orders")
    at = [F.lit("wb").alias("workbook_id"), F.lit("0").alias("sheet_id"), F.col("o_orderkey").alias("row_idx")]
    texts = F.array(F.col("o_orderkey").cast("string"), "o_orderstatus", "o_orderpriority")
    cells = orders.filter(F.col("o_orderstatus") != "F").select(*at, F.posexplode(F.reverse(texts)).alias("back", "formatted_value"))
    meta = cells.withColumn("col_idx", 2 - F.col("back")).drop("back")
    values = gf.assemble_rows(meta, orders.select(*at)).withColumn("texts", F.transform("values", lambda cell: cell["formattedValue"]))
    return values.select("row_idx", F.size("texts").alias("n_cells"), F.array_join("texts", "|").alias("in_order"))


ANCHOR_SQL = """(?is)<a\\s[^>]*?href=["'']([^"'']*)["''][^>]*>(.*?)</a>"""


@check(f"""
    select page_id, unnest(range(1, len(regexp_extract_all(html, '{ANCHOR_SQL}', 1)) + 1))::int as ord,
        unnest(regexp_extract_all(html, '{ANCHOR_SQL}', 1)) as uri, unnest(regexp_extract_all(html, '{ANCHOR_SQL}', 2)) as text
    from pages
""")
def cell_links(spark, sf_dir):
    return gf.cell_links(table(spark, sf_dir, "pages"), "html", keep=["page_id"])


@check("""
    select p_partkey, unnest([1, 2])::int as ord, unnest([p_brand, p_type]) as uri, unnest([p_name, p_brand]) as text from part
""")
def cell_links_formulas(spark, sf_dir):
    """A link formula and an anchor in one cell, in order of appearance."""
    cell = F.concat(
        F.lit('=HYPERLINK("'), "p_brand", F.lit('","'), "p_name", F.lit('") and <a class=\'k\' href="'), "p_type", F.lit('">'), "p_brand", F.lit("</a>")
    )
    return gf.cell_links(table(spark, sf_dir, "part").withColumn("cell", cell), "cell", keep=["p_partkey"])


@check("""
    select page_id, unnest([1, 2, 3, 4, 5, 6])::int as ord, unnest([url, url, url, url || '?a&b', url, url]) as uri,
        unnest(['one', 'two', 'three <b>x</b>', 'four', 'say "five"', url]) as text
    from pages
""")
def cell_links_of_known_targets(spark, sf_dir):
    """The same target in every form of an anchor and of a formula, between things that are no links."""
    url = F.col("url")
    cell = F.concat(
        F.lit('<a data-href="no" href="'), url, F.lit('">one</a> <a name=x>no</a><a href=\''), url, F.lit("' class=k>two</a> <a href='open'>"),
        F.lit("<A HREF = "), url, F.lit(">three <b>x</b></A > <a title='a > b' href=\""), url, F.lit('?a&amp;b">four</a> =HYPERLINK( "'),
        url, F.lit('" ; "say ""five""") and =hyperlink("'), url, F.lit('")'),
    )
    return gf.cell_links(table(spark, sf_dir, "pages").withColumn("cell", cell), "cell", keep=["page_id"])


def events_with_unknown_members(spark, sf_dir):
    """A cell per event with members that no schema names, on every level."""
    text, number = F.col("event_type"), F.col("event_id").cast("string")
    saved = F.concat(
        F.lit('[{"values":[{"formattedValue":"'), number, F.lit('","hyperlink":"http://h/'), number,
        F.lit('","dataValidation":{"strict":true,"id":'), number, F.lit('},"effectiveValue":{"errorValue":{"type":"'), text,
        F.lit('"}},"effectiveFormat":{"padding":{"top":'), number, F.lit('},"textFormat":{"fontSize":9,"foregroundColorStyle":{"theme":"'), text,
        F.lit('"}}},"userEnteredFormat":{"borders":{"top":{"style":"'), text, F.lit('"}},"textRotation":{"angle":45}},"textFormatRuns":[{"startIndex":0,"mark":"'),
        text, F.lit('","format":{"bold":true,"chip":"'), number, F.lit('"}}]}]}]'),
    )
    return table(spark, sf_dir, "events").select(
        F.lit("wb").alias("workbook_id"), number.alias("sheet_id"), saved.alias("row_data")
    )


@check("""
    select event_id::varchar as sheet_id, event_id::varchar as formatted, event_id::varchar as validation, event_type as error, event_id::varchar as padding,
        event_type as theme, event_type as user_theme, event_type as border, '45' as angle, '12' as size, 'CENTER' as horizontal, event_id::varchar as chip,
        'http://h/' || event_id as link, 'true' as bold, true as no_note
    from events
""")
def metadata_round_trip(spark, sf_dir):
    """Patched and written back: unknown and untouched members are all there, absent ones stay absent."""
    rows = gf.row_positions(events_with_unknown_members(spark, sf_dir))
    written = gf.rows_json(gf.refresh_formats(rows, 0, horizontalAlignment="CENTER", fontSize=12, clear_first=False))
    member = lambda path: F.get_json_object("row", f"$.values[0].{path}")
    paths = {
        "formatted": "formattedValue", "validation": "dataValidation.id", "error": "effectiveValue.errorValue.type", "padding": "effectiveFormat.padding.top",
        "theme": "effectiveFormat.textFormat.foregroundColorStyle.theme", "user_theme": "userEnteredFormat.textFormat.foregroundColorStyle.theme",
        "border": "userEnteredFormat.borders.top.style", "angle": "userEnteredFormat.textRotation.angle", "size": "effectiveFormat.textFormat.fontSize",
        "horizontal": "userEnteredFormat.horizontalAlignment", "chip": "textFormatRuns[0].format.chip", "link": "textFormatRuns[0].format.link.uri",
        "bold": "textFormatRuns[0].format.bold",
    }
    return written.select("sheet_id", *[member(path).alias(name) for name, path in paths.items()], member("note").isNull().alias("no_note"))


@check("""
    select o_orderkey as row_idx, unnest([2, 3])::int as col_idx, unnest([o_orderkey::varchar, o_orderstatus]) as text from orders
""")
def read_cell_meta_segments(spark, sf_dir):
    """One sheet saved in a segment per order, each placed by its start row and column."""
    saved = F.concat(F.lit('[{"values":[{"formattedValue":"'), F.col("o_orderkey").cast("string"), F.lit('"},{"formattedValue":"'), "o_orderstatus", F.lit('"}]}]'))
    segments = table(spark, sf_dir, "orders").select(
        F.lit("wb").alias("workbook_id"), F.lit("0").alias("sheet_id"), F.col("o_orderkey").alias("start_row"), F.lit(2).alias("start_col"), saved.alias("row_data")
    )
    return gf.read_cell_meta(segments).select("row_idx", "col_idx", F.col("formatted_value").alias("text"))


@check("""
    select event_id::varchar as sheet_id, 1::bigint as row_idx, case event_type when 'error' then '{"values":[{"formattedValue":"error"}]}'
        else '{"values":[{"formattedValue":"' || event_type || '"},null,null,{"formattedValue":"' || event_id || '"}]}' end as row from events
    union all select event_id::varchar, 2, '{"values":[{"note":"n"},{"note":"m","odd":[1]}]}' from events
""")
def metadata_side_by_side(spark, sf_dir):
    """Two segments of a sheet side by side, but for errors, whose sheets have one."""
    events = table(spark, sf_dir, "events")
    value = lambda c: F.concat(F.lit('{"values":[{"formattedValue":"'), F.col(c).cast("string"), F.lit('"}]}'))
    left = F.concat(F.lit("["), value("event_type"), F.lit(',{"values":[{"note":"n"},{"note":"m","odd":[1]}]}]'))
    segment = lambda column, rows: (
        F.lit("wb").alias("workbook_id"), F.col("event_id").cast("string").alias("sheet_id"),
        F.lit(1).alias("start_row"), F.lit(column).alias("start_col"), rows.alias("row_data"),
    )
    right = F.concat(F.lit("["), value("event_id"), F.lit("]"))
    segments = events.select(*segment(0, left)).unionAll(events.filter("event_type <> 'error'").select(*segment(3, right)))
    return gf.rows_json(gf.row_positions(segments)).select("sheet_id", "row_idx", "row")
