"""Any nested schema as flat tables that lose nothing, and back.

Every array and every map gets a table of its own, whose rows know their parent and their place; structs become
prefixed columns. Sibling arrays stay apart, so 3 and 2 elements are 3 and 2 rows and not 6. What a flat column
cannot say is kept beside it: ``<name>__size`` of an array or map (NULL where it was NULL), and ``<name>__set``
of a struct.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

ROOT = "root"
_ITEM = "_item"


@dataclass
class _Table:
    """Where a table's columns come from; ``place`` columns lead from the root row to this one."""

    name: str
    places: list[str]
    columns: list[tuple[str, Column]] = field(default_factory=list)
    children: list[tuple[str, Column, T.DataType]] = field(default_factory=list)


def _walk(table: _Table, name: str, value: Column, kind: T.DataType, sep: str) -> None:
    if isinstance(kind, T.StructType):
        table.columns.append((f"{name}__set", value.isNotNull()))
        for f in kind.fields:
            _walk(table, f"{name}{sep}{f.name}", value[f.name], f.dataType, sep)
    elif isinstance(kind, T.ArrayType | T.MapType):
        # size() of NULL depends on the session; a NULL has no size here.
        table.columns.append((f"{name}__size", F.when(value.isNotNull(), F.size(value))))
        table.children.append((name, value, kind))
    else:
        table.columns.append((name, value))


def _column(name: str) -> Column:
    return F.col(f"`{name}`")


def shred(df: DataFrame, keys: Sequence[str], sep: str = "_") -> dict[str, DataFrame]:
    """Table name to table: ``root``, and one for each array or map, named by its path.

    ``keys`` name a row of ``df``. A child table has them, the place of each enclosing element (``<path>__pos``,
    from 0, or ``<path>__key``) and its element's columns; a scalar element is in the column ``value``. An empty or
    NULL array has no rows. Every table is a projection with one generator per level: nothing is shuffled, and
    reading one table parses and explodes nothing of the others.
    """
    root = _Table(ROOT, [])
    for f in df.schema.fields:
        if f.name not in keys:
            _walk(root, f.name, _column(f.name), f.dataType, sep)
    out: dict[str, DataFrame] = {}
    _emit(df, root, list(keys), sep, out)
    return out


def _emit(df: DataFrame, table: _Table, keys: list[str], sep: str, out: dict[str, DataFrame]) -> None:
    ids = [*keys, *table.places]
    out[table.name] = df.select(*[_column(c) for c in ids], *[c.alias(n) for n, c in table.columns])
    for name, value, kind in table.children:
        path = name if table.name == ROOT else f"{table.name}.{name}"
        if isinstance(kind, T.ArrayType):
            place, element = f"{path}__pos", kind.elementType
            rows = df.select(*[_column(c) for c in ids], F.posexplode(value).alias(place, _ITEM))
        else:
            place, element = f"{path}__key", kind.valueType
            rows = df.select(*[_column(c) for c in ids], F.explode(value).alias(place, _ITEM))
        child = _Table(path, [*table.places, place])
        if isinstance(element, T.StructType):
            child.columns.append(("value__set", _column(_ITEM).isNotNull()))
            for f in element.fields:
                _walk(child, f.name, _column(_ITEM)[f.name], f.dataType, sep)
        else:
            _walk(child, "value", _column(_ITEM), element, sep)
        _emit(rows, child, keys, sep, out)


def _nested(name: str, kind: T.DataType, sep: str) -> Column:
    """The value of a column again, from the flat columns of a table to which its children have been joined."""
    if isinstance(kind, T.StructType):
        fields = [_nested(f"{name}{sep}{f.name}", f.dataType, sep).alias(f.name) for f in kind.fields]
        return F.when(_column(f"{name}__set"), F.struct(*fields)) if fields else F.when(_column(f"{name}__set"), F.struct())
    if isinstance(kind, T.ArrayType | T.MapType):
        none = F.array() if isinstance(kind, T.ArrayType) else F.create_map()
        return F.when(_column(f"{name}__size").isNotNull(), F.coalesce(_column(f"{name}__items"), none.cast(kind)))
    return _column(name)


def _collections(name: str, kind: T.DataType, sep: str) -> Iterator[tuple[str, T.DataType]]:
    if isinstance(kind, T.StructType):
        for f in kind.fields:
            yield from _collections(f"{name}{sep}{f.name}", f.dataType, sep)
    elif isinstance(kind, T.ArrayType | T.MapType):
        yield name, kind


def _fields_of(kind: T.DataType) -> list[tuple[str, T.DataType]]:
    return [(f.name, f.dataType) for f in kind.fields] if isinstance(kind, T.StructType) else [("value", kind)]


def _joined(tables: dict[str, DataFrame], name: str, ids: list[str], fields: list[tuple[str, T.DataType]], sep: str) -> DataFrame:
    df = tables[name]
    for column, kind in (c for f, k in fields for c in _collections(f, k, sep)):
        path = column if name == ROOT else f"{name}.{column}"
        element = kind.elementType if isinstance(kind, T.ArrayType) else kind.valueType
        place = f"{path}__pos" if isinstance(kind, T.ArrayType) else f"{path}__key"
        inner = _fields_of(element)
        child = _joined(tables, path, [*ids, place], inner, sep)
        if isinstance(element, T.StructType):
            whole = F.when(_column("value__set"), F.struct(*[_nested(f, k, sep).alias(f) for f, k in inner]))
        else:
            whole = _nested("value", element, sep)
        pairs = F.collect_list(F.struct(_column(place).alias("p"), whole.alias("v")))
        if isinstance(kind, T.ArrayType):
            # By place alone: values may hold maps, which have no order.
            items = F.transform(F.array_sort(pairs, lambda a, b: F.when(a["p"] < b["p"], -1).otherwise(1)), lambda x: x["v"])
        else:
            items = F.map_from_entries(pairs)
        grouped = child.groupBy(*[_column(c) for c in ids]).agg(items.alias(f"{column}__items"))
        # Equal by content and NULL, as keys of maps and rows may be NULL.
        own = [f"__id{i}" for i in range(len(ids))]
        grouped = grouped.toDF(*own, f"{column}__items")
        same = [_column(a).eqNullSafe(_column(b)) for a, b in zip(ids, own)]
        condition = same[0]
        for c in same[1:]:
            condition = condition & c
        df = df.join(grouped, condition, "left").drop(*own)
    return df


def unshred(tables: dict[str, DataFrame], schema: T.StructType, keys: Sequence[str], sep: str = "_") -> DataFrame:
    """The rows that ``shred`` made ``tables`` of, which had ``schema``: one grouping for each array and map.

    Elements of one array meet in one group, as they do in the result.
    """
    fields = [(f.name, f.dataType) for f in schema.fields if f.name not in keys]
    df = _joined(tables, ROOT, list(keys), fields, sep)
    return df.select(*[(_column(f.name) if f.name in keys else _nested(f.name, f.dataType, sep)).alias(f.name) for f in schema.fields])
