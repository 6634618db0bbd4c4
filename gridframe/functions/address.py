"""A1 addresses: column letters, ranges and their parts."""

from __future__ import annotations

import re
from typing import NamedTuple

from pyspark.sql import Column
from pyspark.sql import functions as F

# Enough letters for every bigint.
MAX_LETTERS = 14
# A quoted title with what ends it.
QUOTED = r"(?s)^'([^']*(?:''[^']*)*)'(?:!|$)"


def col_letters(number: Column) -> Column:
    """1 -> A, 26 -> Z, 27 -> AA, 703 -> AAA; numbers below 1 give an empty string."""
    start = F.struct(number.cast("bigint").alias("rest"), F.lit("").alias("letters"))
    add_letter = """(name, step) -> if(name.rest > 0,
        named_struct('rest', (name.rest - 1) div 26, 'letters', concat(char(65 + (name.rest - 1) % 26), name.letters)),
        name)"""
    steps = F.expr(f"sequence(1, {MAX_LETTERS})")
    return F.call_function("aggregate", steps, start, F.expr(add_letter), F.expr("name -> name.letters"))


def col_number(letters: Column) -> Column:
    """A -> 1, Z -> 26, AA -> 27; the inverse of :func:`col_letters`."""
    each = F.filter(F.split(F.upper(letters), ""), lambda letter: letter != "")
    return F.aggregate(each, F.lit(0).cast("bigint"), lambda acc, letter: acc * 26 + (F.ascii(letter) - 64))


def column_index(letters: str) -> int:
    """0-based index of a column given by its letters, for arguments on the driver."""
    if not re.fullmatch("[A-Za-z]+", letters):
        raise ValueError(f"not a column letter: {letters!r}")
    number = 0
    for letter in letters.upper():
        number = number * 26 + ord(letter) - 64
    return number - 1


def quoted_title(title: Column) -> Column:
    """A title as it stands in an address that must be read back: in quotes, its own quotes doubled, unless it is a plain word."""
    quoted = F.concat(F.lit("'"), F.replace(title, F.lit("'"), F.lit("''")), F.lit("'"))
    return F.when(F.rlike(title, F.lit("^[A-Za-z_][A-Za-z0-9_]*$")) & ~F.endswith(title, F.lit("\n")), title).otherwise(quoted)


def address_title(address: Column) -> Column:
    """Title of an address. A quoted title ends at its closing quote, another one at the last ``!``."""
    quoted = F.replace(F.regexp_extract(address, QUOTED, 1), F.lit("''"), F.lit("'"))
    return F.when(F.rlike(address, F.lit(QUOTED)), quoted).otherwise(F.regexp_replace(address, r"(?s)![^!]*$", ""))


def address_cells(address: Column) -> Column:
    """What follows the title of an address, without the ``!``; empty for a bare title."""
    after_quoted = F.regexp_replace(address, QUOTED, "")
    return F.when(F.rlike(address, F.lit(QUOTED)), after_quoted).otherwise(F.regexp_extract(address, r"(?s)!([^!]*)$", 1))


def _letters(number: Column | int) -> Column:
    """Letters of a 0-based column; those of a constant are worked out here, not per row."""
    return F.lit(letters_of(number + 1)) if isinstance(number, int) else col_letters(number + 1)


def letters_of(number: int) -> str:
    """Letters of a 1-based column number."""
    letters = ""
    while number > 0:
        number, letter = divmod(number - 1, 26)
        letters = chr(65 + letter) + letters
    return letters


def range_address(
    title: Column,
    row0: Column,
    col0: Column | int,
    row1: Column | None = None,
    col1: Column | int | None = None,
    for_write: bool = True,
    quote: bool = False,
) -> Column:
    """``Title!A3``, ``Title!A3:Z`` or ``Title!A3:C9`` from half-open 0-based bounds.

    A write address whose title holds a colon is the bare title, so the write
    starts at A1; clear addresses (``for_write=False``) keep the full form. With
    ``quote`` the title is quoted instead, which keeps every address apart.
    """
    start = F.concat(_letters(col0), (row0 + 1).cast("string"))
    address = F.concat(quoted_title(title) if quote else title, F.lit("!"), start)
    if isinstance(col1, int):
        col1_letters, present = F.lit(letters_of(col1)), F.lit(True)
    elif col1 is not None:
        col1_letters, present = col_letters(col1), col1.isNotNull()
    if col1 is not None:
        end_row = F.lit("") if row1 is None else F.coalesce(row1.cast("string"), F.lit(""))
        address = F.concat(address, F.when(present, F.concat(F.lit(":"), col1_letters, end_row)).otherwise(F.lit("")))
    if for_write and not quote:
        address = F.when(F.contains(title, F.lit(":")), title).otherwise(address)
    return address


class CellRange(NamedTuple):
    """Half-open 0-based bounds of an A1 range; ``None`` is an open end."""

    row0: int
    row1: int | None
    col0: int
    col1: int | None


def parse_range(cell_range: str) -> CellRange:
    """Bounds of ``B2``, ``B2:D9``, ``A3:Z``, ``A:C`` or ``2:5``, with or without ``Title!``."""
    parts = re.fullmatch(
        r"(?:.*!)?\$?([A-Za-z]*)\$?(\d*)(?::\$?([A-Za-z]*)\$?(\d*))?", cell_range.strip(), flags=re.DOTALL
    )
    if parts is None or not any(parts.groups()):
        raise ValueError(f"not an A1 range: {cell_range!r}")
    first_col, first_row, last_col, last_row = parts.groups()
    single = last_col is None
    if single:
        last_col, last_row = first_col, first_row
    rows, cols = [int(row) for row in (first_row, last_row) if row], [column_index(col) for col in (first_col, last_col) if col]
    # The corners of a closed range may be given in either order.
    return CellRange(
        (min(rows) if last_row else rows[0]) - 1 if first_row else 0,
        max(rows) if last_row else None,
        (min(cols) if last_col else cols[0]) if first_col else 0,
        max(cols) + 1 if last_col else None,
    )
