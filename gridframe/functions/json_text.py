"""JSON values as typed columns that lose nothing, and back as text.

Every struct of a typed value has a field ``extra`` with the members of its JSON
object that the schema does not name. Written back, a struct gives its set
fields and its extra members, so what no operator touched comes out as it came.
The rules are SQL texts, since a cell has too many fields to compose as columns.

Text that holds nothing but members of the schema is read by the schema alone:
what was read, written back, has then as many members and lists as the text.
"""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

EXTRA = "extra"
MEMBERS = "map<string,variant>"
# Stands for the field in a schema that text is read with; no saved object has such a member.
SPARE = "\x01extra"
# A whole JSON string.
STRING = r'"[^"\\]*+(?:\\.[^"\\]*+)*+"'


def with_extras(data_type: T.DataType, name: str = EXTRA) -> T.DataType:
    """The type with a field for extras in every struct."""
    if isinstance(data_type, T.ArrayType):
        return T.ArrayType(with_extras(data_type.elementType, name))
    if not isinstance(data_type, T.StructType):
        return data_type
    fields = [T.StructField(f.name, with_extras(f.dataType, name)) for f in data_type]
    return T.StructType([*fields, T.StructField(name, T.MapType(T.StringType(), T.VariantType()))])


def members(json: Column) -> Column:
    """How many members and lists a JSON text holds."""
    return F.octet_length(F.regexp_replace(json, rf'(?s){STRING}|[^":\[]++', ""))


def as_many_members(saved: Column, written: Column, objects: Column | None = None) -> Column:
    """Whether a saved text holds as many members and lists as what was read of it, written again.

    Keys are counted by their closing quote and colon where nothing is escaped,
    no blank is before a colon and no key in single quotes: then strings are the
    same in both texts, and what was not read can only add to the count. Other
    texts are counted without their strings. ``objects`` is the text of objects
    that ``written`` holds as strings.
    """

    def times(json: Column, part: str) -> Column:
        return (F.octet_length(json) - F.octet_length(F.replace(json, F.lit(part), F.lit("")))) / len(part)

    unclear = reduce(or_, [F.contains(saved, F.lit(part)) for part in ("\\", " :", "\n:", "\t:", "\r:", "':")])
    quick = times(saved, '":') + times(saved, "[") == times(written, '":') + times(written, "[")
    counted = members(written) if objects is None else members(written) + members(objects)
    return F.when(unclear, members(saved) == counted).otherwise(quick)


def typed_sql(value: str, data_type: T.DataType, depth: int = 0) -> str:
    """A variant as the type with extras; a value of another kind than the type says is an error."""
    return _bound(value, f"cast({value} as {data_type.simpleString()})", data_type, depth)


def _bound(value: str, plain: str, data_type: T.DataType, depth: int) -> str:
    """Both are computed once, however many fields are taken from them."""
    pair = f"pair{depth}"
    built = _build(f"{pair}.value", f"{pair}.plain", data_type, depth + 1)
    return f"get(transform(array(named_struct('value', {value}, 'plain', {plain})), {pair} -> {built}), 0)"


def _build(value: str, plain: str, data_type: T.DataType, depth: int) -> str:
    """``plain`` is the value already cast, so that all levels are cast at once."""
    if isinstance(data_type, T.ArrayType):
        item, other = f"item{depth}", f"other{depth}"
        built = _build(item, other, data_type.elementType, depth + 1)
        return f"if({plain} is null, null, zip_with(cast({value} as array<variant>), {plain}, ({item}, {other}) -> {built}))"
    fields = []
    for field in data_type:
        inner = f"{plain}.{field.name}"
        if _nested(field.dataType):
            below = _bound(f"try_variant_get({value}, '$.{field.name}', 'variant')", inner, field.dataType, depth + 1)
            inner = f"if({inner} is null, null, {below})"
        fields.append(f"'{field.name}', {inner}")
    known = ", ".join(f"'{name}'" for name in data_type.names)
    members, name = f"members{depth}", f"name{depth}"
    unknown = f"map_filter(cast({value} as {MEMBERS}), ({name}, any{depth}) -> {name} not in ({known}))"
    extra = f"get(transform(array({unknown}), {members} -> if(size({members}) > 0, {members}, null)), 0)"
    return f"if({plain} is null, null, named_struct({', '.join(fields)}, '{EXTRA}', {extra}))"


def _nested(data_type: T.DataType) -> bool:
    return isinstance(data_type, T.StructType) or isinstance(data_type, T.ArrayType) and _nested(data_type.elementType)


def text_sql(value: str, data_type: T.DataType, depth: int = 0) -> str:
    """JSON text of a typed value; null fields of a struct are left out, null items of a list are ``null``."""
    if isinstance(data_type, T.StructType):
        members = [
            f"if({value}.{f.name} is null, null, concat('\"{f.name}\":', {text_sql(f'{value}.{f.name}', f.dataType, depth + 1)}))"
            for f in data_type
            if f.name != EXTRA
        ]
        if EXTRA in data_type.names:
            members.append(f"if({value}.{EXTRA} is null, null, {_inside(f'to_json({value}.{EXTRA})')})")
        return f"concat('{{', concat_ws(',', {', '.join(members)}), '}}')"
    if isinstance(data_type, T.ArrayType):
        item = f"item{depth}"
        items = f"transform({value}, {item} -> if({item} is null, 'null', {text_sql(item, data_type.elementType, depth + 1)}))"
        return f"concat('[', array_join({items}, ','), ']')"
    return _inside(f"to_json(array({value}))")


def _inside(json: str) -> str:
    """Text without its outer brackets."""
    return f"get(transform(array({json}), json -> substring(json, 2, length(json) - 2)), 0)"
