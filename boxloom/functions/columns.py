"""Helpers for composing columns: local bindings, blanks, literals and VARIANT access."""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

_NESTED = (T.StructType, T.ArrayType, T.MapType, T.VariantType)


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """Evaluate `value` once per row and use it any number of times in `body`."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def bind(rows: DataFrame, values: dict[str, Column], drop: Iterable[str] = ()) -> DataFrame:
    """Add or replace columns that are costly to compute, evaluated exactly once per row.

    The optimizer copies a projected expression into every filter it pushes down, also into the ones it
    infers from `explode`, and nested copies multiply. Values that come out of `inline` are not copied.
    Plain columns pass beside it, so join keys keep their partitioning. Structs and arrays pass through
    it: Spark 4.1 can lose track of a struct's fields when they are read across a generator. Columns to `drop` can be
    used by the values and are not passed through.
    """
    plain, nested = [], []
    for field in rows.schema.fields:
        if field.name not in values and field.name not in drop:
            (nested if isinstance(field.dataType, _NESTED) else plain).append(field.name)
    row = F.struct(*nested, *[value.alias(name) for name, value in values.items()])
    # computed in a projection, which is compiled; the generator itself only passes the struct on
    return rows.select(*plain, row.alias("_row")).select(*plain, F.inline(F.array("_row")))


def null(kind: str | T.DataType) -> Column:
    return F.lit(None).cast(kind)


def strings(values: Iterable[str]) -> Column:
    return F.array(*[F.lit(value) for value in values]).cast("array<string>")


def nonblank(column: Column) -> Column:
    """Empty text becomes null; anything else, spaces included, is kept."""
    return F.nullif(column, F.lit(""))


def positive_or(column: Column, fallback: Column) -> Column:
    return F.coalesce(F.nullif(column, F.lit(0)), fallback)


def literal_map(mapping: dict[str, str]) -> Column:
    pairs = [F.lit(part) for pair in mapping.items() for part in pair]
    return F.create_map(*pairs) if pairs else null("map<string,string>")


def lookup(mapping: dict[str, str], key: Column) -> Column:
    if not mapping:
        return null("string")
    return F.try_element_at(literal_map(mapping), key)


def path(*keys: str) -> str:
    """A VARIANT path that also works for keys with dots and spaces."""
    return "$" + "".join(f'["{key}"]' if "'" in key else f"['{key}']" for key in keys)


def item(variant: Column, *keys: str) -> Column:
    """Member as VARIANT: SQL NULL when the key is absent, a VARIANT null when it holds null."""
    return F.try_variant_get(variant, path(*keys), "variant")


def read(variant: Column, kind: str, *keys: str) -> Column:
    """Member cast leniently to `kind`; null when absent, null or not convertible."""
    return F.try_variant_get(variant, path(*keys), kind)


def members(variant: Column, *names: str) -> Column:
    """Several members at once, as a struct of VARIANTs; null when the value is no object.

    One pass over the object, where `item` walks and copies it once per key. Absent members are SQL NULL.
    """
    fields = ",".join(f"`{name}`:variant" for name in names)
    return F.try_variant_get(variant, "$", f"struct<{fields}>")


def number(variant: Column) -> Column:
    return F.try_variant_get(variant, "$", "double")


def kind_of(variant: Column) -> Column:
    return F.schema_of_variant(variant)


def is_object(variant: Column) -> Column:
    return F.try_variant_get(variant, "$", "struct<`-`:variant>").isNotNull()


def is_array(variant: Column) -> Column:
    return F.try_variant_get(variant, "$", "array<struct<`-`:variant>>").isNotNull()


def is_boolean(variant: Column) -> Column:
    return F.coalesce(kind_of(variant) == "BOOLEAN", F.lit(False))


def is_explicit_null(variant: Column) -> Column:
    return F.coalesce(F.is_variant_null(variant), F.lit(False))


def text_of(variant: Column) -> Column:
    """The text of a JSON string; null for every other kind of value."""
    return F.when(kind_of(variant) == "STRING", F.try_variant_get(variant, "$", "string"))


def items_of(variant: Column) -> Column:
    """Elements of a JSON array; null for every other kind of value."""
    return F.try_variant_get(variant, "$", "array<variant>")


def truthy(variant: Column) -> Column:
    """JSON truth as annotation scripts apply it: absent, null, false, 0, '' and empty containers are false."""

    def decide(both: Column) -> Column:
        value, kind = both["value"], both["kind"]
        return (
            F.when(kind.isNull() | (kind == "VOID"), F.lit(False))
            .when(kind == "BOOLEAN", F.try_variant_get(value, "$", "boolean"))
            .when(kind == "STRING", F.try_variant_get(value, "$", "string") != "")
            .when(kind.startswith("OBJECT<"), kind != "OBJECT<>")
            .when(kind.startswith("ARRAY<"), F.size(items_of(value)) > 0)
            .otherwise(F.coalesce(number(value) != 0.0, F.lit(True)))
        )

    return let(F.struct(variant.alias("value"), kind_of(variant).alias("kind")), decide)
