"""Single values: numbers, sets, nulls, binaries, literals. All are column expressions."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..errors import ValidationError

# Text forms that count as a number, as base64, and as a truth value.
NUMBER_PATTERN = r"^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?$"
BASE64_PATTERN = r"^([A-Za-z0-9+/]{4})*([A-Za-z0-9+/]{3}=|[A-Za-z0-9+/]{2}==)?$"
TRUE_TEXTS = ("1", "t", "T", "TRUE", "true", "True")
FALSE_TEXTS = ("0", "f", "F", "FALSE", "false", "False")

INFINITY = float("inf")
#: below this every whole number is a double
EXACT_WHOLE = float(2**53)


def is_infinite(col: Column) -> Column:
    return F.abs(col.cast("double")) == F.lit(INFINITY)


def parse_number(col: Column, number_type: str = "double") -> Column:
    """Number of a text; null for text that is no finite number."""
    parsed = F.when(col.rlike(NUMBER_PATTERN), col.try_cast(number_type))
    if number_type not in ("double", "float"):
        return parsed
    return F.when(~is_infinite(parsed), parsed)


def format_number(col: Column, kind: T.DataType | None = None) -> Column:
    """Shortest decimal text of a number, never with an exponent: ``3000``, ``1000.5``; a negative zero keeps its sign."""
    if isinstance(kind, T.IntegralType):
        return col.cast("string")
    if isinstance(kind, T.DecimalType):
        text = col.cast("string")
        return F.when(text.contains("."), F.regexp_replace(text, r"\.?0+$", "")).otherwise(text)
    text, size = col.cast("string"), F.abs(col)
    whole = col.try_cast("bigint")
    # from 1e7 up Spark writes an exponent; a double has 17 digits at most, so this decimal is exact
    exact = F.rtrim(F.rtrim(col.try_cast("decimal(38,17)").cast("string"), F.lit("0")), F.lit("."))
    digits = F.rtrim(F.translate(F.substring_index(text, "E", 1), "-.", ""), F.lit("0"))
    exponent = F.substring_index(text, "E", -1).try_cast("int")
    sign = F.when(col < 0, F.lit("-")).otherwise(F.lit(""))
    shifted = F.when(exponent > 0, F.rpad(digits, exponent + 1, F.lit("0"))).otherwise(
        F.concat(F.lit("0."), F.repeat(F.lit("0"), -exponent - 1), digits)
    )
    return (
        F.when(text == "-0.0", F.lit("-0"))
        .when((size < EXACT_WHOLE) & (whole.cast("double") == col), whole.cast("string"))
        .when(~text.contains("E"), text)
        .when((size >= 1e7) & (size < 1e20), exact)
        .otherwise(F.concat(sign, shifted))
    )


def dedupe_set(col: Column) -> Column:
    """Set without repeated members, first occurrence kept."""
    return F.array_distinct(col)


def encode_null(col: Column) -> Column:
    """Null marker text for a null, nothing for a value."""
    return F.when(col.isNull(), F.lit('{"NULL":true}'))


def decode_null(col: Column, inner: Callable[[Column], Column]) -> Column:
    """``inner`` of the tagged text, null for a null marker."""
    marker = F.get_json_object(col, "$.NULL") == F.lit("true")
    return F.when(~F.coalesce(marker, F.lit(False)), inner(col))


def decoded_base64(col: Column) -> Column:
    """Bytes of base64 text; null for anything else."""
    return F.when(col.rlike(BASE64_PATTERN), F.try_to_binary(col, F.lit("base64")))


def decode_string(col: Column, base64: bool = False) -> Column:
    """Text; with ``base64``, padded base64 of UTF-8 text is decoded."""
    if not base64:
        return col
    text = F.try_validate_utf8(decoded_base64(col).cast("string"))
    return F.when(col.endswith("="), F.coalesce(text, col)).otherwise(col)


def strict_json(col: Column) -> Column:
    """Variant of a text that is one JSON value and nothing else; null otherwise.

    The JSON reader stops after the first value, so the text is read inside a list and inside an
    object: what follows a value breaks at least one of the two.
    """
    listed = F.try_parse_json(F.concat(F.lit("["), col, F.lit("]"))).try_cast("array<variant>")
    named = F.try_parse_json(F.concat(F.lit('{"v":'), col, F.lit("}"))).try_cast("map<string,variant>")
    return F.when((F.size(listed) == 1) & (F.size(named) == 1), listed[0])


def is_json_object(col: Column) -> Column:
    kind = F.schema_of_variant(strict_json(col))
    return F.coalesce(kind.startswith("OBJECT"), F.lit(False))


def convert_literal(col: Column, descriptor: str) -> Column:
    """Typed value of a statement literal; null where the text does not fit the descriptor."""
    if descriptor == "S":
        quoted = col.startswith("'") & col.endswith("'") & (F.length(col) >= 2)
        return F.when(quoted, F.substring(col, F.lit(2), F.length(col) - 2)).otherwise(col)
    if descriptor == "N":
        return parse_number(col)
    if descriptor == "BOOL":
        return F.when(col.isin(*TRUE_TEXTS), F.lit(True)).when(col.isin(*FALSE_TEXTS), F.lit(False))
    if descriptor == "L":
        return F.when(F.schema_of_variant(F.try_parse_json(col)).startswith("ARRAY"), F.try_parse_json(col))
    raise ValidationError(f"no literals of descriptor {descriptor}")


def literal_error(col: Column, descriptor: str) -> Column:
    """True where a given literal cannot be converted."""
    return col.isNotNull() & convert_literal(col, descriptor).isNull()
