"""Column-name repair, as array expressions and for one name list on the driver."""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values of the cleaning rule.
NOT_ALPHANUMERIC = "[^a-zA-Z0-9]+"
TRAILING_UNDERSCORE = "_$"


def once(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use`` of a value that is computed once, however often it is named."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def unique_names(names: Column) -> Column:
    """Suffix the n-th repeat of a name with n: ``a, a, a`` -> ``a, a1, a2``."""

    def renamed(placed: Column) -> Column:
        # Equal names stand side by side, in the order of their positions.
        in_order = once(F.transform(placed, lambda pair: pair["name"]), lambda names: numbered(placed, names))
        return F.transform(F.sort_array(in_order), lambda pair: pair["name"])

    def numbered(placed: Column, names: Column) -> Column:
        def rename(pair: Column, i: Column) -> Column:
            earlier = i - F.array_position(names, pair["name"]).cast("int") + 1
            name = F.when(earlier > 0, F.concat(pair["name"], earlier.cast("string"))).otherwise(pair["name"])
            return F.struct(pair["position"].alias("position"), name.alias("name"))

        return F.transform(placed, rename)

    pairs = F.transform(names, lambda name, i: F.struct(name.alias("name"), i.alias("position")))
    return once(F.sort_array(pairs), renamed)


def clean_names(names: Column) -> Column:
    """Lower-case names holding only letters, digits and underscores, with no trailing underscore."""

    def clean(name: Column) -> Column:
        underscored = F.regexp_replace(name, NOT_ALPHANUMERIC, "_")
        return F.lower(F.regexp_replace(underscored, TRAILING_UNDERSCORE, ""))

    return F.transform(names, clean)


def lower_names(names: Column) -> Column:
    return F.transform(names, lambda name: F.lower(F.coalesce(name, F.lit(""))))


def distinct_names(names: Column) -> Column:
    """Names without any duplicate, also where suffixing collides (``a, a, a1``).

    The suffix rule runs until nothing repeats. A name that repeats an earlier
    one gets longer in each pass, so position by position all come to rest, each
    after at most as many passes as there are names.
    """

    def passes(start: Column, steps: Column) -> Column:
        def next_pass(state: Column, _: Column) -> Column:
            unique = F.size(F.array_distinct(state)) == F.size(state)
            return F.when(unique, state).otherwise(unique_names(state))

        return F.aggregate(steps, start, next_pass)

    def settled(names: Column) -> Column:
        steps = F.when(F.size(names) > 0, F.sequence(F.lit(1), F.size(names))).otherwise(F.array().cast("array<int>"))
        done = lambda state: F.size(F.array_distinct(state)) == F.size(state)
        return F.aggregate(steps, names, lambda state, _: F.when(done(state), state).otherwise(passes(state, steps)))

    return once(names, settled)


def unique_name_list(names: list[str]) -> list[str]:
    seen: Counter[str] = Counter()
    unique = []
    for name in names:
        unique.append(f"{name}{seen[name]}" if seen[name] else name)
        seen[name] += 1
    return unique


def clean_name_list(names: list[str]) -> list[str]:
    return [re.sub(TRAILING_UNDERSCORE, "", re.sub(NOT_ALPHANUMERIC, "_", name)).lower() for name in names]


def table_name_list(names: list[str], make_columns_unique: bool = True, clean_column_names: bool = True) -> list[str]:
    """Final column names of a table: repaired as asked, never empty, never repeated."""
    if make_columns_unique:
        names = unique_name_list(names)
    if clean_column_names:
        names = clean_name_list(names)
    names = [name or f"_c{i}" for i, name in enumerate(names)]
    # Each pass leaves the first of every group alone and lengthens the others, so this ends.
    while len(set(names)) < len(names):
        names = unique_name_list(names)
    return names


def record_names(header: Column, make_columns_unique: bool, clean_column_names: bool) -> Column:
    """Names of one header as an array, repaired as asked and without repeats."""
    if make_columns_unique:
        header = unique_names(header)
    if clean_column_names:
        header = clean_names(header)
    return distinct_names(header)
