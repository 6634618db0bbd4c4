"""Typed rendering of values as cell text, by native expressions only.

The rules are SQL texts over a column or lambda name. A frame of many columns
is then one call into Spark, where composing Column objects would be hundreds
of calls per column. No text depends on how the session reads escapes in
string literals: special characters are written ``char(n)``.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Whole-cell texts that count as missing.
NULL_TOKENS = ["NaN", "nan", "None", "none"]

# Fixed values of the double format: below the first, doubles have fewer digits
# than others; up to 15 digits a text that reads back is the only shortest one.
SMALLEST_NORMAL = "2.2250738585072014E-308D"
CERTAIN_DIGITS = 15


def quoted(name: str) -> str:
    """A column name as SQL."""
    return "`" + name.replace("`", "``") + "`"


def double_text(column: str) -> Column:
    """Shortest decimal text of a double: ``10000000.0``, ``1e+16``, ``1e-05``."""
    return F.expr(double_sql(quoted(column)))


def double_sql(x: str) -> str:
    """From 1e-4 to 1e16 Spark prints the same digits, so only the layout changes.

    Outside, some JVMs print more digits than needed, see :func:`_scientific`.
    """
    size, sign = f"abs({x})", f"if({x} < 0, '-', '')"
    parts = f"split(string({size}), 'E')"
    mantissa = f"regexp_replace({parts}[0], '[.]0$', '')"
    digits = f"replace({mantissa}, '.', '')"
    exponent = f"int(try_element_at({parts}, 2))"
    fraction = f"coalesce(nullif(substring({digits}, {exponent} + 2), ''), '0')"
    large = f"rpad(substring({digits}, 1, {exponent} + 1), {exponent} + 1, '0'), '.', {fraction}"
    # The nested case keeps the common one free of what the others share.
    return f"""
        case when {x} = 0 or ({size} >= 1e-3D and {size} < 1e7D) then string({x}) else case
            when isnan({x}) then 'nan'
            when {size} >= 1e7D and {size} < 1e16D then concat({sign}, {large})
            when {size} >= 1e-4D and {size} < 1e-3D then concat({sign}, '0.000', {digits})
            when {size} = double('Infinity') then concat({sign}, 'inf')
            when {size} >= {SMALLEST_NORMAL} and length({digits}) <= {CERTAIN_DIGITS}
                then concat({sign}, {_layout(mantissa, exponent)})
            else concat({sign}, {_scientific(size, mantissa, exponent)})
        end end"""


def _layout(mantissa: str, exponent: str) -> str:
    """``1.5e+16`` from ``1.5`` and 16."""
    return (
        f"concat({mantissa}, if({exponent} < 0, 'e-', 'e+'), if(abs({exponent}) < 10, '0', ''), string(abs({exponent})))"
    )


def _scientific(size: str, mantissa: str, exponent: str) -> str:
    """The fewest digits that read back as the value, found by rounding the ones that are known."""
    # From 1e16 to 2^63 the value is an integer whose digits are all known, not just those printed.
    integer = f"if({size} >= 1e16D and {size} < 9223372036854775808D, try_cast({size} as bigint), null)"
    known = f"cast(coalesce(concat(string({integer}), 'E-', string({exponent})), {mantissa}) as decimal(19, 18))"

    def rounded(decimals: int) -> str:
        return f"cast(bround(k, {decimals}) as decimal(20, 18))"

    # A power of two lies closer to the double below it than to the one above, so
    # at 15 decimals the next number up may read back where the nearest does not.
    next_up = f"cast({rounded(15)} + cast('1E-15' as decimal(20, 18)) as decimal(20, 18))"
    below_normal = ", ".join(rounded(decimals) for decimals in range(17))
    candidates = (
        f"if({size} < {SMALLEST_NORMAL}, array({below_normal}), array({rounded(14)}, {rounded(15)}, {next_up}, {rounded(16)}))"
    )
    reads_back = f"double(concat(string(n), 'E', string({exponent}))) = {size}"
    # Rounding up may reach 10.
    layout = f"if(n >= 10, {_layout(chr(39) + '1' + chr(39), f'{exponent} + 1')}, {_layout(_no_zeros('string(n)'), exponent)})"
    # The one-element transforms bind a value, so that it is computed once.
    found = f"filter(get(transform(array({known}), k -> {candidates}), 0), n -> {reads_back})"
    return f"get(transform(slice({found}, 1, 1), n -> {layout}), 0)"


def _no_zeros(text: str) -> str:
    return f"regexp_replace({text}, '[.]?0+$', '')"


def quoted_sql(x: str) -> str:
    """A string as an element of a rendered list: quoted, with control characters escaped."""
    escaped, escape = x, "char(92)"
    for raw, written in ((escape, escape), ("char(10)", "'n'"), ("char(13)", "'r'"), ("char(9)", "'t'")):
        escaped = f"replace({escaped}, {raw}, concat({escape}, {written}))"
    single, double = "char(39)", "char(34)"
    return f"""
        if(contains({x}, {single}) and not contains({x}, {double}),
            concat({double}, {escaped}, {double}),
            concat({single}, replace({escaped}, {single}, concat({escape}, {single})), {single}))"""


def value_sql(x: str, data_type: T.DataType, depth: int = 0) -> str:
    """Text of one value by its type; null stays null."""
    if isinstance(data_type, T.BooleanType):
        return f"initcap(string({x}))"
    if isinstance(data_type, T.DoubleType):
        return double_sql(x)
    if isinstance(data_type, T.FloatType):
        # The printed digits, read back as a double, are their own shortest form.
        return double_sql(f"double(string({x}))")
    if isinstance(data_type, T.DecimalType):
        # All digits of the scale, whatever the session's settings; a cast may give an exponent.
        return f"replace(format_number({x}, {data_type.scale}), ',', '')"
    if isinstance(data_type, T.ArrayType):
        item, element_type = f"item{depth}", data_type.elementType
        text = quoted_sql(item) if isinstance(element_type, T.StringType) else value_sql(item, element_type, depth + 1)
        return f"concat('[', array_join(transform({x}, {item} -> coalesce({text}, 'None')), ', '), ']')"
    if isinstance(data_type, (T.MapType, T.StructType, T.VariantType)):
        return f"to_json({x})"
    return f"string({x})"


def blank_sql(x: str) -> str:
    """Blank for a null text and for the whole-cell missing tokens."""
    tokens = ", ".join(f"'{token}'" for token in NULL_TOKENS)
    return f"case when {x} is null or {x} in ({tokens}) then '' else {x} end"


def filled_sql(x: str, data_type: T.DataType) -> str:
    """Null booleans as false, null arrays as empty; others unchanged."""
    if isinstance(data_type, T.BooleanType):
        return f"coalesce({x}, false)"
    if isinstance(data_type, T.ArrayType):
        return f"coalesce({x}, cast(array() as {data_type.simpleString()}))"
    return x


def cell_sql(x: str, data_type: T.DataType) -> str:
    """What one value looks like in a cell: typed text, with missing values filled or blank.

    Only texts can spell a missing token; of the numbers only NaN does.
    """
    if isinstance(data_type, (T.StringType, T.BinaryType)):
        return blank_sql(f"string({x})")
    if isinstance(data_type, (T.DoubleType, T.FloatType)):
        return f"if({x} is null or isnan({x}), '', {value_sql(x, data_type)})"
    return f"coalesce({value_sql(filled_sql(x, data_type), data_type)}, '')"
