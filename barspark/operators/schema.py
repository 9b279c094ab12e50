"""Schema contracts (C1-C6, P1, P11): named ``StructType``s and the issues a frame has
with one. A comparison is a list of ``Issue`` rows; reports, errors and frames
derive from it."""
from __future__ import annotations

from typing import Iterable, Mapping, NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The golden schemas (names, order, types; "!" marks a column without NULLs).
CONTRACT_DDL = {
    "market_data": "timestamp timestamp!, symbol string!, open double, high double, low double, close double, "
                   "volume bigint, trade_count bigint",
    "corporate_actions": "symbol string!, ex_date date!, split_ratio double, cash_dividend double, close double",
}


_TYPES = {t.simpleString(): t for t in (T.TimestampType(), T.DateType(), T.StringType(), T.DoubleType(), T.LongType())}


def _parse(text: str) -> T.StructType:
    """``name type`` entries of the types above, without a session."""
    pairs = [entry.split() for entry in text.split(",")]
    return T.StructType([T.StructField(name, _TYPES[kind.rstrip("!")], not kind.endswith("!")) for name, kind in pairs])


CONTRACTS: dict[str, T.StructType] = {name: _parse(ddl) for name, ddl in CONTRACT_DDL.items()}


def set_contract(name: str, schema: T.StructType | str) -> None:
    """Add or replace a contract (a StructType, or text as above)."""
    CONTRACTS[name] = _parse(schema) if isinstance(schema, str) else schema


def contract(name: str) -> T.StructType:
    if name not in CONTRACTS:
        raise KeyError(f"unknown contract {name!r} (known: {sorted(CONTRACTS)})")
    return CONTRACTS[name]


class Issue(NamedTuple):
    column: str
    kind: str                 # missing, unexpected, type, nulls
    expected: str | None = None
    observed: str | None = None


ISSUE_SCHEMA = "dataset string, column string, kind string, expected string, observed string"


def structure_issues(schema: T.StructType, observed: T.StructType) -> list[Issue]:
    """Names and types side by side; no job."""
    want = {f.name: f.dataType.simpleString() for f in schema.fields}
    have = {f.name: f.dataType.simpleString() for f in observed.fields}
    return [Issue(c, "missing" if c not in have else "unexpected" if c not in want else "type", want.get(c), have.get(c))
            for c in sorted(want.keys() | have.keys()) if want.get(c) != have.get(c)]


def null_counts(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    """A3: one aggregate (one scan) with the NULL count of every column, as
    rows (column, null_count)."""
    cols = list(columns)
    if not cols:
        return df.sparkSession.createDataFrame([], "column string, null_count long")
    wide = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in cols])
    return wide.unpivot([], cols, "column", "null_count")


def null_issues(schema: T.StructType, df: DataFrame) -> list[Issue]:
    """Columns that must not hold NULLs and do (one aggregate over those present)."""
    strict = [f.name for f in schema.fields if not f.nullable and f.name in df.columns]
    found = null_counts(df, strict).filter("null_count > 0").collect()
    return sorted(Issue(r["column"], "nulls", "0", str(r["null_count"])) for r in found)


def compare(df: DataFrame, schema: T.StructType) -> list[Issue]:
    """C2."""
    return structure_issues(schema, df.schema) + null_issues(schema, df)


def issue_frame(spark: SparkSession, dataset: str, issues: list[Issue]) -> DataFrame:
    """C3 as rows."""
    return spark.createDataFrame([(dataset, *i) for i in issues], ISSUE_SCHEMA)


def issue_report(issues: list[Issue]) -> dict[str, dict[str, str]]:
    """C3 as a nested report: kind -> column -> what was expected and seen."""
    out: dict[str, dict[str, str]] = {}
    for i in sorted(issues):
        out.setdefault(i.kind, {})[i.column] = " / ".join(x for x in (i.expected, i.observed) if x)
    return out


def _refuse(name: str, issues: list[Issue]) -> None:
    if issues:
        raise ValueError(f"{name} breaks its contract: {issue_report(issues)}")


def check(df: DataFrame, schema: T.StructType, name: str = "dataset") -> None:
    """C4: ValueError unless the frame has no issue."""
    _refuse(name, compare(df, schema))


def conform(df: DataFrame, schema: T.StructType, name: str = "dataset") -> DataFrame:
    """The contract's columns in its order, differing types cast strictly (ANSI: a value
    that does not convert fails the job). ValueError for missing or unexpected columns,
    or NULLs where there must be none."""
    issues = [i for i in structure_issues(schema, df.schema) if i.kind != "type"]
    _refuse(name, issues or null_issues(schema, df))
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields])


def require_columns(df: DataFrame, columns: Iterable[str], what: str = "frame") -> None:
    """C6."""
    missing = sorted(set(columns) - set(df.columns))
    if missing:
        raise KeyError(f"{what}: missing columns {missing}")


def with_defaults(df: DataFrame, defaults: Mapping[str, tuple[object, T.DataType]]) -> DataFrame:
    """Add ``lit`` columns for the absent ones."""
    for name, (value, dtype) in defaults.items():
        if name not in df.columns:
            df = df.withColumn(name, F.lit(value).cast(dtype))
    return df
