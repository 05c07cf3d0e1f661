"""Raw tables: declared columns, keys, load rule and storage layout."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from forgemeter.session import path_exists


SPARK_TYPES = {
    "string": T.StringType(),
    "int": T.IntegerType(),
    "bigint": T.LongType(),
    "date": T.DateType(),
    "timestamp_ntz": T.TimestampNTZType(),
}


@dataclass(frozen=True)
class ColumnSpec:
    name: str
    type: str
    required: bool = False
    max_length: int | None = None

    def ddl(self) -> str:
        declared = f"VARCHAR({self.max_length})" if self.max_length else self.type
        return f"{self.name} {declared}" + (" NOT NULL" if self.required else "")


@dataclass(frozen=True)
class TableSpec:
    """One raw table.

    ``load`` is ``merge_fields`` (a row with a known key takes over only
    ``update_fields``) or ``replace_row`` (it takes over the whole row).
    ``layout`` is (directory column, type, SQL expression over the row): rows are
    stored by it, so a load rewrites only the directories its batch touches. The
    expression uses key columns only, so that a row never moves.
    """

    name: str
    columns: tuple[ColumnSpec, ...]
    primary_key: tuple[str, ...]
    load: str
    layout: tuple[str, str, str]
    update_fields: tuple[str, ...] = ()
    options: dict = field(default_factory=dict)

    def __post_init__(self) -> None:
        names = set(self.column_names)
        if not names:
            raise ValueError(f"{self.name}: no columns declared")
        if not self.primary_key or not set(self.primary_key) <= names:
            raise ValueError(f"{self.name}: the primary key must name declared columns")
        if self.load not in ("merge_fields", "replace_row"):
            raise ValueError(f"{self.name}: unknown load rule {self.load!r}")
        if self.load == "merge_fields":
            if not self.update_fields:
                raise ValueError(f"{self.name}: merge_fields needs update_fields")
            if not set(self.update_fields) <= set(self.payload_names):
                raise ValueError(f"{self.name}: update_fields must name non-key columns")

    @property
    def column_names(self) -> list[str]:
        return [c.name for c in self.columns]

    @property
    def payload_names(self) -> list[str]:
        return [c.name for c in self.columns if c.name not in self.primary_key]

    @property
    def replaced_fields(self) -> list[str]:
        """Non-key columns that a later row for the same key takes over."""
        return self.payload_names if self.load == "replace_row" else list(self.update_fields)

    def schema(self) -> T.StructType:
        return T.StructType(
            [T.StructField(c.name, SPARK_TYPES[c.type], not c.required) for c in self.columns]
        )

    def ddl(self) -> str:
        """Column list with constraints, as documentation of the contract."""
        lines = [c.ddl() for c in self.columns]
        lines.append(f"PRIMARY KEY ({', '.join(self.primary_key)})")
        return ",\n".join(lines)

    def layout_column(self) -> Column:
        return F.expr(self.layout[2])


# Column names, types, lengths, keys and thresholds of the contract.
RAW_CONTRIBUTIONS = TableSpec(
    name="raw_contributions",
    columns=(
        ColumnSpec("username", "string", required=True, max_length=255),
        ColumnSpec("date", "date", required=True),
        ColumnSpec("contribution_count", "int", required=True),
    ),
    primary_key=("username", "date"),
    load="merge_fields",
    update_fields=("contribution_count",),
    layout=("month", "date", "trunc(date, 'month')"),
    options={"restatement_window": 7, "backfill_threshold": 30, "start_year": 2023},
)

# Review ids grow with time, so a daily batch touches few id blocks, and since
# the id is unique a block never holds more rows than its width.
RAW_PULLS = TableSpec(
    name="raw_pulls",
    columns=(
        ColumnSpec("repo_name", "string", required=True, max_length=255),
        ColumnSpec("pr_id", "bigint", required=True),
        ColumnSpec("state", "string", max_length=50),
        ColumnSpec("created_at", "timestamp_ntz"),
        ColumnSpec("merged_at", "timestamp_ntz"),
        ColumnSpec("user_login", "string", max_length=255),
    ),
    primary_key=("pr_id",),
    load="replace_row",
    layout=("id_block", "bigint", "pr_id div 100000000"),
)

TABLES = {t.name: t for t in (RAW_CONTRIBUTIONS, RAW_PULLS)}


def table_spec(name: str) -> TableSpec:
    if name not in TABLES:
        raise KeyError(f"table {name!r} not found; declared: {sorted(TABLES)}")
    return TABLES[name]


def stored_schema(spec: TableSpec) -> T.StructType:
    name, kind, _ = spec.layout
    return spec.schema().add(name, SPARK_TYPES[kind])


def ensure_table(spark: SparkSession, spec: TableSpec, path: str) -> None:
    """Create the empty dataset unless it is there already."""
    if not path_exists(spark, path):
        empty = spark.createDataFrame([], stored_schema(spec))
        empty.write.partitionBy(spec.layout[0]).parquet(path)


def read_table(spark: SparkSession, spec: TableSpec, path: str) -> DataFrame:
    """The stored rows, layout column included so that filters on it prune directories."""
    return spark.read.schema(stored_schema(spec)).parquet(path)


def contributions_since(stored: DataFrame, first_day: Column) -> DataFrame:
    """Rows from ``first_day`` on; older month directories are not listed."""
    return stored.filter((F.col("month") >= F.trunc(first_day, "month")) & (F.col("date") >= first_day))
