"""Items as tagged attribute-value JSON, to and from typed columns."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..errors import ValidationError
from ..table import quoted
from . import documents, walks
from .types import SET_DESCRIPTORS, descriptor_of, spark_type
from .values import format_number, parse_number

PRESENT = "_present"
ERRORS = "_errors"

FieldType = str | T.DataType


def _declared(kind: FieldType) -> tuple[str, T.DataType]:
    """Descriptor and Spark type of a declaration (a descriptor, a DDL text or a type)."""
    if isinstance(kind, T.DataType):
        return descriptor_of(kind), kind
    if kind.upper() == kind and kind in ("S", "N", "BOOL", "B", "SS", "NS", "BS", "L", "M", "NULL"):
        return kind, spark_type(kind)
    parsed = T._parse_datatype_string(kind)
    return descriptor_of(parsed), parsed


# -- decoding ---------------------------------------------------------------------------------


def _is_document(kind: T.DataType) -> bool:
    """Values of undeclared shape, and lists and maps of nothing else."""
    if isinstance(kind, T.ArrayType):
        return _is_document(kind.elementType)
    if isinstance(kind, T.MapType):
        return isinstance(kind.keyType, T.StringType) and _is_document(kind.valueType)
    return isinstance(kind, T.VariantType)


def _tag_type(descriptor: str, kind: T.DataType) -> T.StructType:
    """Shape of ``{"<descriptor>": value}`` (or the null marker) for ``from_json``."""
    if descriptor == "BOOL":
        inner: T.DataType = T.BooleanType()
    elif descriptor in SET_DESCRIPTORS:
        inner = T.ArrayType(T.StringType())
    elif isinstance(kind, T.StructType):
        inner = T.StructType([T.StructField(f.name, _tag_type(descriptor_of(f.dataType), f.dataType)) for f in kind])
    elif _is_document(kind):
        inner = T.VariantType()
    elif isinstance(kind, T.MapType):
        inner = T.MapType(T.StringType(), _tag_type(descriptor_of(kind.valueType), kind.valueType))
    elif isinstance(kind, T.ArrayType):
        inner = T.ArrayType(_tag_type(descriptor_of(kind.elementType), kind.elementType))
    else:
        inner = T.StringType()
    fields = [] if descriptor == "NULL" else [T.StructField(descriptor, inner)]
    return T.StructType([*fields, T.StructField("NULL", T.BooleanType())])


def _value(tag: Column, descriptor: str, kind: T.DataType, number_type: str, depth: int | None) -> Column:
    if descriptor == "NULL":
        return F.lit(None).cast(kind)
    raw = tag[descriptor]
    if descriptor == "S":
        return raw.try_cast(kind) if not isinstance(kind, T.StringType) else raw
    if descriptor == "N":
        exact = number_type if isinstance(kind, (T.DoubleType, T.FloatType)) else kind.simpleString()
        return parse_number(raw, exact)
    if descriptor == "BOOL":
        return raw
    if descriptor == "B":
        return F.try_to_binary(raw, F.lit("base64"))
    if descriptor == "SS":
        return F.array_distinct(raw)
    if descriptor == "NS":
        element = kind.elementType
        exact = number_type if isinstance(element, (T.DoubleType, T.FloatType)) else element.simpleString()
        return F.transform(F.array_distinct(raw), lambda x: parse_number(x, exact))
    if descriptor == "BS":
        return F.transform(F.array_distinct(raw), lambda x: F.try_to_binary(x, F.lit("base64")))

    def below(node: Column, inner: T.DataType) -> Column:
        # walks through whole documents do not go into lambda functions
        return _value(node, descriptor_of(inner), inner, number_type, documents.DEFAULT_DEPTH if depth is None else depth)

    if isinstance(kind, T.StructType):
        fields = F.struct(*[_value(raw[f.name], descriptor_of(f.dataType), f.dataType, number_type, depth).alias(f.name) for f in kind])
        return F.when(raw.isNotNull(), fields)
    if _is_document(kind):
        # of undeclared shape: the members carry tags, the value itself is bare
        wrapped = F.concat(F.lit('{"' + descriptor + '":'), F.to_json(raw), F.lit("}"))
        if depth is None:
            found = F.parse_json(walks.untag_text(wrapped))
        else:
            found = F.parse_json(documents.bound(F.parse_json(wrapped), lambda v: documents.untag_text(v, depth)))
        return F.when(raw.isNotNull(), found if isinstance(kind, T.VariantType) else found.try_cast(kind))
    if isinstance(kind, T.MapType):
        return F.transform_values(raw, lambda _, v: below(v, kind.valueType))
    if isinstance(kind, T.ArrayType):
        return F.transform(raw, lambda v: below(v, kind.elementType))
    raise ValidationError(f"{kind.simpleString()} cannot be read with descriptor {descriptor}")


def decode_items(
    df: DataFrame,
    col: str,
    schema: Mapping[str, FieldType],
    number_type: str = "double",
    depth: int | None = None,
    keep: Sequence[str] = (),
) -> DataFrame:
    """Typed columns of items in column ``col``.

    ``_present`` names the attributes an item carries (a null marker counts), ``_errors`` those
    whose value does not fit the declared descriptor. ``keep`` columns pass through.
    """
    documents.room_for(depth or 0)
    declared = {name: _declared(kind) for name, kind in schema.items()}
    tags = T.StructType([T.StructField(n, _tag_type(d, k)) for n, (d, k) in declared.items()])
    parsed = df.select(
        *[quoted(c) for c in keep],
        F.json_object_keys(quoted(col)).alias(PRESENT),
        F.from_json(quoted(col), tags).alias("__item"),
    )
    columns, bad = [], []
    for name, (descriptor, kind) in declared.items():
        tag = F.col("__item").getField(name)
        value = _value(tag, descriptor, kind, number_type, depth)
        columns.append(value.alias(name))
        wrong = tag.isNotNull() & ~F.coalesce(tag["NULL"], F.lit(False)) & value.isNull()
        if descriptor == "NS" or descriptor == "BS":
            wrong = wrong | F.coalesce(F.exists(value, lambda x: x.isNull()), F.lit(False))
        bad.append(F.when(wrong, F.lit(name)))
    unreadable = F.when(F.col(PRESENT).isNull(), F.lit("*"))
    errors = F.array_compact(F.array(*bad, unreadable)).alias(ERRORS)
    return parsed.select(*[quoted(c) for c in keep], *columns, PRESENT, errors)


def decode_columns(df: DataFrame, schema: Mapping[str, FieldType], **options) -> DataFrame:
    """Per-attribute tagged text columns to typed ones; other columns pass through."""
    out = []
    for name in df.columns:
        if name in schema:
            descriptor, kind = _declared(schema[name])
            tag = F.from_json(quoted(name), _tag_type(descriptor, kind))
            value = _value(
                tag, descriptor, kind, options.get("number_type", "double"), options.get("depth")
            )
            out.append(value.alias(name))
        else:
            out.append(quoted(name))
    return df.select(*out)


# -- encoding ---------------------------------------------------------------------------------


def _tagged(col: Column, descriptor: str, kind: T.DataType, markers: bool, depth: int | None) -> Column:
    """Struct or variant that ``to_json`` prints as the tagged value."""
    null_tag = F.when(col.isNull(), F.lit(True)).alias("NULL")
    if _is_document(kind):
        node = col if isinstance(kind, T.VariantType) else F.to_variant_object(col)
        if depth is None:
            text = F.coalesce(F.parse_json(walks.tag_text(F.to_json(node))), F.parse_json(F.lit('{"NULL":true}')))
        else:
            text = F.parse_json(documents.bound(node, lambda v: documents.tag_text(v, depth)))
        return text if markers else F.when(col.isNotNull(), text)
    if descriptor in SET_DESCRIPTORS:
        # an empty set is an absent attribute
        members = F.when(F.size(col) > 0, F.array_distinct(_set_texts(col, descriptor, kind)))
        return F.when(members.isNotNull(), F.struct(members.alias(descriptor)))
    body = _body(col, descriptor, kind, depth)
    if descriptor == "NULL":
        value = F.struct(F.lit(True).alias("NULL"))
        return value if markers else F.when(F.lit(False), value)
    if markers:
        return F.struct(body.alias(descriptor), null_tag)
    return F.when(col.isNotNull(), F.struct(body.alias(descriptor)))


def _set_texts(col: Column, descriptor: str, kind: T.DataType) -> Column:
    if descriptor == "NS":
        # a zero of either sign is one member
        zero = F.lit(0).cast(kind.elementType)
        return F.transform(F.array_compact(col), lambda x: format_number(F.when(x == 0, zero).otherwise(x), kind.elementType))
    if descriptor == "BS":
        return F.transform(F.array_compact(col), F.base64)
    return F.array_compact(col)


def _body(col: Column, descriptor: str, kind: T.DataType, depth: int | None) -> Column:
    if descriptor == "N":
        return format_number(col, kind)
    if descriptor == "B":
        return F.base64(col)
    if descriptor == "S":
        return col.cast("string")
    if descriptor in ("BOOL", "NULL"):
        return col

    def below(node: Column, inner: T.DataType) -> Column:
        nested = descriptor_of(inner)
        # a list of scalars inside a document is a list: documents hold no sets
        return _tagged(node, "L" if nested in SET_DESCRIPTORS else nested, inner, True, within)

    within = depth
    if isinstance(kind, T.StructType):
        return F.when(
            col.isNotNull(), F.struct(*[below(col.getField(f.name), f.dataType).alias(f.name) for f in kind])
        )
    # walks through whole documents do not go into lambda functions
    within = documents.DEFAULT_DEPTH if depth is None else depth
    if isinstance(kind, T.MapType):
        return F.transform_values(col, lambda _, v: below(v, kind.valueType))
    if isinstance(kind, T.ArrayType):
        return F.transform(col, lambda v: below(v, kind.elementType))
    raise ValidationError(f"{kind.simpleString()} cannot be written with descriptor {descriptor}")


def tagged_column(
    col: Column,
    kind: T.DataType,
    descriptor: str | None = None,
    markers: bool = True,
    depth: int | None = None,
) -> Column:
    return _tagged(col, descriptor or descriptor_of(kind), kind, markers, depth)


def item_json(
    df: DataFrame,
    columns: Sequence[str] | None = None,
    descriptors: Mapping[str, str] | None = None,
    nulls: str = "marker",
    prefix: str = "",
    depth: int | None = None,
) -> Column:
    """Tagged JSON text of the given columns (all by default), read under ``prefix`` + name."""
    documents.room_for(depth or 0)
    if nulls not in ("marker", "absent"):
        raise ValidationError("nulls is 'marker' or 'absent'")
    kinds = {f.name: f.dataType for f in df.schema.fields}
    names = list(columns) if columns is not None else [c for c in df.columns if c not in (PRESENT, ERRORS)]
    chosen = descriptors or {}
    fields = []
    for name in names:
        kind = kinds[prefix + name]
        value = tagged_column(quoted(prefix + name), kind, chosen.get(name), nulls == "marker", depth)
        fields.append(value.alias(name))
    return F.to_json(F.struct(*fields))


def encode_items(
    df: DataFrame,
    columns: Sequence[str] | None = None,
    descriptors: Mapping[str, str] | None = None,
    nulls: str = "marker",
    keep: Sequence[str] = (),
    output: str = "item",
    depth: int | None = None,
) -> DataFrame:
    """One tagged JSON text per row, next to the ``keep`` columns.

    ``nulls="marker"`` writes ``{"NULL":true}`` for a null, ``"absent"`` leaves the attribute out.
    A ``_present`` column wins: attributes it does not name are left out.
    """
    text = item_json(df, columns, descriptors, nulls, depth=depth)
    if PRESENT in df.columns:
        fields = F.map_entries(F.from_json(text, "map<string,variant>"))
        carried = F.filter(fields, lambda e: F.array_contains(F.col(PRESENT), e["key"]))
        text = F.to_json(F.map_from_entries(carried))
    return df.select(*[quoted(c) for c in keep], text.alias(output))


# -- checks -----------------------------------------------------------------------------------


def nested_set_attributes(col: Column, depth: int | None = None) -> Column:
    """Names of attributes of an item text that hold a set inside a map or list."""
    if depth is None:
        return walks.nested_set_names(F.to_json(F.from_json(col, "map<string,variant>")))
    documents.room_for(depth)
    entries = F.map_entries(F.from_json(col, "map<string,variant>"))
    bad = F.filter(entries, lambda e: documents.has_nested_set(e["value"], depth))
    return F.transform(bad, lambda e: e["key"])


def validate_nested_sets(df: DataFrame, col: str, depth: int | None = None) -> DataFrame:
    """Rows whose item breaks the rule, with the attributes that do in ``bad_attributes``."""
    checked = df.withColumn("bad_attributes", nested_set_attributes(quoted(col), depth))
    return checked.where(F.size("bad_attributes") > 0)


def read_row_types(df: DataFrame, schema: Mapping[str, str]) -> DataFrame:
    """Columns cast to the types of their descriptors; a column without descriptor is an error.

    Null members of sets go, and an empty set is absent (null).
    """
    out = []
    for name in df.columns:
        if name == "commit_timestamp":
            continue
        if name not in schema:
            raise ValidationError(f"column {name!r} has no descriptor")
        descriptor = schema[name]
        col, have = quoted(name), df.schema[name].dataType
        if descriptor in ("L", "M") and isinstance(have, T.StringType):
            value = F.try_parse_json(col)
        elif descriptor == "N" and isinstance(have, T.StringType):
            value = parse_number(col)
        else:
            value = col.try_cast(spark_type(descriptor))
        if descriptor in SET_DESCRIPTORS:
            value = F.array_compact(value)
            value = F.when(F.size(value) > 0, value)
        out.append(value.alias(name))
    return df.select(*out)
