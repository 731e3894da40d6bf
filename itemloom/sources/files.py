"""Items in text files: tagged JSON lines and tab separated tables."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.codec import FieldType, decode_items, encode_items
from ..functions.values import parse_number
from ..table import quoted


def read_items_json(spark: SparkSession, path: str, schema: Mapping[str, FieldType] | None = None, **options) -> DataFrame:
    """Lines of tagged item JSON as column ``item``; with ``schema`` decoded, next to the text."""
    lines = spark.read.text(path).withColumnRenamed("value", "item")
    if schema is None:
        return lines
    return decode_items(lines, "item", schema, keep=("item",), **options)


def write_items_json(df: DataFrame, path: str, **options) -> None:
    """One tagged JSON item per line."""
    encode_items(df, output="value", **options).write.text(path)


def read_items_tsv(
    spark: SparkSession, path: str, numbers: Sequence[str] = (), schema: T.StructType | str | None = None, escaped: bool = True
) -> DataFrame:
    """Tab separated items with a header row. Columns named in ``numbers`` are cast; the rest stay text.

    Without ``schema`` only the header is looked at; empty fields are absent attributes. Texts come back as ``write_items_tsv``
    escaped them; ``escaped=False`` leaves backslashes of other writers alone.
    """
    reader = spark.read.options(**_TSV, header=True)
    if schema is not None:
        reader = reader.schema(schema)
    df = reader.csv(path)
    columns = []
    for field in df.schema.fields:
        value = quoted(field.name)
        if escaped and isinstance(field.dataType, T.StringType):
            value = _unescaped(value)
        columns.append((parse_number(value) if field.name in numbers else value).alias(field.name))
    return df.select(*columns)


def write_items_tsv(df: DataFrame, path: str) -> None:
    """One item a line, so files can be split anywhere: breaks, tabs and backslashes inside texts are escaped, an absent attribute is an
    empty field and an empty text a mark of its own."""
    df.select(*[_escaped(quoted(c).cast("string")).alias(c) for c in df.columns]).write.options(**_TSV, header=True).csv(path)


# No quotes, nothing trimmed; what stands for a character behind a backslash.
_TSV = {"sep": "\t", "quote": "", "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False, "emptyValue": "", "nullValue": ""}
_ESCAPES = {"t": "\t", "n": "\n", "r": "\r", "z": "\0"}
_EMPTY = "\\e"


def _escaped(text: Column) -> Column:
    out = F.replace(text, F.lit("\\"), F.lit("\\\\"))
    for letter, char in _ESCAPES.items():
        out = F.replace(out, F.lit(char), F.lit(f"\\{letter}"))
    return F.when(out == "", F.lit(_EMPTY)).otherwise(out)


def _unescaped(text: Column) -> Column:
    """Doubled backslashes first: between them every backslash leads a letter."""

    def part(x: Column) -> Column:
        for letter, char in _ESCAPES.items():
            x = F.replace(x, F.lit(f"\\{letter}"), F.lit(char))
        return x

    parts = F.transform(F.split(text, r"\\\\", -1), part)
    plain = F.when(text == _EMPTY, F.lit("")).otherwise(F.array_join(parts, "\\"))
    return F.when(text.contains("\\"), plain).otherwise(text)
