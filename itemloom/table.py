"""Item tables: a DataFrame plus the names of its key columns."""

from __future__ import annotations

from dataclasses import dataclass, field, replace
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .errors import TableNotFound, ValidationError

#: written by the store itself and never part of an item
HIDDEN_COLUMNS = ("commit_timestamp",)


@dataclass(frozen=True)
class Index:
    """Another key pair over the same items; ``include`` narrows what it carries."""

    partition_key: str
    sort_key: str | None = None
    include: tuple[str, ...] | None = None


@dataclass(frozen=True)
class ItemTable:
    name: str
    df: DataFrame
    partition_key: str
    sort_key: str | None = None
    indexes: dict[str, Index] = field(default_factory=dict)
    #: keys of the table an index view was taken from
    base_keys: tuple[str, ...] = ()

    def __post_init__(self) -> None:
        for key in self.keys:
            if key not in self.df.columns:
                raise ValidationError(f"key column {key!r} is not in table {self.name!r}")

    @property
    def keys(self) -> list[str]:
        return [self.partition_key] + ([self.sort_key] if self.sort_key else [])

    @property
    def columns(self) -> list[str]:
        return [c for c in self.df.columns if c not in HIDDEN_COLUMNS]

    @property
    def attributes(self) -> list[str]:
        """Columns that are not part of the key."""
        return [c for c in self.columns if c not in self.keys]

    def with_df(self, df: DataFrame) -> "ItemTable":
        return replace(self, df=df)

    def with_indexes(self, indexes: dict[str, Index]) -> "ItemTable":
        return replace(self, indexes=indexes)

    def index(self, name: str) -> "ItemTable":
        """The same items addressed by the key pair of an index."""
        index = self.indexes.get(name)
        if index is None:
            raise ValidationError(f"table {self.name!r} has no index {name!r}")
        df = self.df
        if index.include is not None:
            wanted = {*self.keys, index.partition_key, index.sort_key, *index.include}
            df = df.select(*[quoted(c) for c in df.columns if c in wanted])
        return ItemTable(self.name, df, index.partition_key, index.sort_key, base_keys=tuple(self.keys))

    @property
    def has_key(self) -> Column:
        """True where every part of the key is there."""
        return reduce(lambda a, b: a & b, (quoted(k).isNotNull() for k in self.keys))


def quoted(name: str) -> Column:
    """Column by its exact name, dots and dashes included."""
    return F.col("`" + name.replace("`", "``") + "`")


def clean_name(name: str) -> str:
    """Table name as it is used in SQL: dashes become underscores."""
    return name.replace("-", "_")


class Catalog:
    """Tables by name. An alias stands for its actual table, whose keys it takes."""

    def __init__(self, spark: SparkSession):
        self.spark = spark
        self._tables: dict[str, ItemTable] = {}
        self._aliases: dict[str, str] = {}

    def register_table(
        self,
        name: str,
        df: DataFrame | None = None,
        partition_key: str | None = None,
        sort_key: str | None = None,
        indexes: dict[str, Index] | None = None,
        alias_of: str | None = None,
    ) -> ItemTable:
        clean = clean_name(name)
        if alias_of is not None:
            actual = self.table(alias_of)
            self._aliases[clean] = actual.name
            actual.df.createOrReplaceTempView(clean)
            return actual
        if df is None or partition_key is None:
            raise ValidationError(f"table {name!r} needs a DataFrame and a partition key")
        table = ItemTable(clean, df, partition_key, sort_key, dict(indexes or {}))
        self._tables[clean] = table
        df.createOrReplaceTempView(clean)
        return table

    def table(self, name: str) -> ItemTable:
        clean = clean_name(name)
        clean = self._aliases.get(clean, clean)
        if clean not in self._tables:
            raise TableNotFound(name)
        return self._tables[clean]

    def replace(self, name: str, df: DataFrame) -> ItemTable:
        """Point a name (and its aliases) at a new state of the table."""
        table = self.table(name).with_df(df)
        self._tables[table.name] = table
        for view in [table.name, *(a for a, t in self._aliases.items() if t == table.name)]:
            df.createOrReplaceTempView(view)
        return table

    def names(self) -> list[str]:
        return sorted([*self._tables, *self._aliases])
