"""Scans of the relational inputs and the contract they must meet."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from meterloom import schemas
from meterloom.functions.time import epoch_of, epoch_to_ntz, in_range

REQUIRED = ("statistics_meta", schemas.LONG_TERM, schemas.SHORT_TERM)
ATTRIBUTE_TABLES = ("states_meta", "states", "state_attributes")
TABLE_RANK = {schemas.SHORT_TERM: 0, schemas.LONG_TERM: 1}


@dataclass(frozen=True)
class Inputs:
    """The input tables. `attributes` is None when the optional tables are absent."""

    statistics_meta: DataFrame
    short_term: DataFrame
    long_term: DataFrame
    attributes: tuple[DataFrame, DataFrame, DataFrame] | None = None
    # Reads (table, start, end) with the range pushed into the scan, where that is possible.
    scan: Callable[[str, str | None, str | None], DataFrame] | None = None

    def readings(self, start: str | None = None, end: str | None = None) -> DataFrame:
        """Both readings tables, short-term first, within a half-open range."""
        tables = (schemas.SHORT_TERM, schemas.LONG_TERM)
        short_term, long_term = (self.table_readings(t, start, end) for t in tables)
        return short_term.unionByName(long_term)

    def table_readings(self, table: str, start: str | None = None, end: str | None = None) -> DataFrame:
        """One readings table within a half-open range."""
        if self.scan is not None:
            found = self.scan(table, start, end)
        else:
            found = self.short_term if table == schemas.SHORT_TERM else self.long_term
        return found.filter(in_range("start_ts", start, end))


# Types that may stand in for another. Decimals are numbers, whatever their size; void is a column of
# nulls.
_WHOLE = {"bigint", "int", "smallint", "tinyint"}
_NUMBERS = _WHOLE | {"double", "float", "decimal"}
_WIDER = {
    "bigint": _WHOLE | {"decimal"},
    "int": _WHOLE | {"decimal"},
    "double": _NUMBERS,
    "boolean": {"boolean", "decimal"} | _WHOLE,
    "string": {"string", "varchar", "char"},
}


def require_columns(df: DataFrame, table: str, expected) -> DataFrame:
    missing = [c for c in expected.names if c not in df.columns]
    if missing:
        raise ValueError(f"table {table} lacks columns: {missing}")
    for field in expected:
        found, wanted = (t.dataType.simpleString() for t in (df.schema[field.name], field))
        kind = found.partition("(")[0]
        fraction = isinstance(df.schema[field.name].dataType, T.DecimalType) and not found.endswith(",0)")
        whole_only = fraction and wanted not in ("double", "boolean")
        if kind != "void" and (kind not in _WIDER.get(wanted, {wanted}) or whole_only):
            raise ValueError(f"table {table}: column {field.name} is {found}, not {wanted}")
    return df


def open_inputs(
    available: Mapping[str, Callable[[], DataFrame]],
    start: str | None = None,
    end: str | None = None,
) -> Inputs:
    """Check the contract, then open the tables. `available` maps a table name to a reader,
    for example ``lambda: spark.read.parquet(path)`` or a JDBC read. The optional half-open
    range restricts both readings tables at the scan."""
    missing = [t for t in REQUIRED if t not in available]
    if missing:
        raise ValueError(f"required tables missing: {missing}")
    meta = require_columns(
        available["statistics_meta"](), "statistics_meta", schemas.STATISTICS_META
    )
    attributes = None
    if all(t in available for t in ATTRIBUTE_TABLES):
        shapes = (schemas.STATES_META, schemas.STATES, schemas.STATE_ATTRIBUTES)
        attributes = tuple(
            require_columns(available[t](), t, s) for t, s in zip(ATTRIBUTE_TABLES, shapes)
        )
    return Inputs(
        statistics_meta=meta,
        short_term=scan_readings(available, schemas.SHORT_TERM, start, end),
        long_term=scan_readings(available, schemas.LONG_TERM, start, end),
        attributes=attributes,
        scan=lambda table, since, until: scan_readings(
            available, table, _later(start, since), _earlier(end, until)
        ),
    )


def _later(*times: str | None) -> str | None:
    return max((t for t in times if t is not None), key=epoch_of, default=None)


def _earlier(*times: str | None) -> str | None:
    return min((t for t in times if t is not None), key=epoch_of, default=None)


def parquet_tables(spark: SparkSession, root: str) -> dict[str, Callable[[], DataFrame]]:
    """Readers for ``<root>/<table>.parquet``, for those tables that exist."""
    path = spark._jvm.org.apache.hadoop.fs.Path
    fs = path(root).getFileSystem(spark._jsc.hadoopConfiguration())
    names = REQUIRED + ATTRIBUTE_TABLES
    return {
        t: (lambda p=f"{root}/{t}.parquet": spark.read.parquet(p))
        for t in names
        if fs.exists(path(f"{root}/{t}.parquet"))
    }


_PARTITIONED = ("partitionColumn", "lowerBound", "upperBound", "numPartitions")


def jdbc_options(
    options: Mapping[str, str], per_table: Mapping[str, Mapping[str, str]], table: str
) -> dict[str, str]:
    """Options of one table: the common ones and its own. Fact tables must be read by several
    tasks, so they need a partition column with bounds."""
    merged = {**options, **per_table.get(table, {}), "dbtable": table}
    missing = [o for o in _PARTITIONED if o not in merged]
    if table in (*TABLE_RANK, "states") and missing:
        raise ValueError(f"table {table} would be read by one task; it lacks {missing}")
    return merged


def jdbc_tables(
    spark: SparkSession,
    options: Mapping[str, str],
    names: tuple[str, ...],
    per_table: Mapping[str, Mapping[str, str]] | None = None,
) -> dict[str, Callable[[], DataFrame]]:
    """Readers over JDBC. `options` holds for all tables (url, driver, user); `per_table` holds
    partitionColumn, lowerBound, upperBound and numPartitions, which differ by table."""
    every = {t: jdbc_options(options, per_table or {}, t) for t in names}
    return {t: (lambda o=o: spark.read.format("jdbc").options(**o).load()) for t, o in every.items()}


def scan_readings(
    available: Mapping[str, Callable[[], DataFrame]],
    table: str,
    start: str | None = None,
    end: str | None = None,
) -> DataFrame:
    """One readings table in its working shape. The optional half-open range is applied to
    the raw epoch column, so it reaches the scan."""
    if table not in TABLE_RANK:
        raise ValueError(f"not a readings table: {table}")
    raw = require_columns(available[table](), table, schemas.STATISTICS)
    if start is not None:
        raw = raw.filter(F.col("start_ts") >= epoch_of(start))
    if end is not None:
        raw = raw.filter(F.col("start_ts") < epoch_of(end))
    return working_readings(raw, table, epoch_to_ntz("start_ts"))


def working_readings(raw: DataFrame, table: str, start_ts: str = "start_ts") -> DataFrame:
    """Rename the source columns and add the table rank (short-term first)."""
    return raw.selectExpr(
        "id",
        "created_ts",
        "metadata_id",
        f"{start_ts} AS start_ts",
        "mean",
        "mean_weight",
        "min AS min_value",
        "max AS max_value",
        "last_reset_ts",
        "state AS value",
        "sum AS sum_value",
        f"{TABLE_RANK[table]} AS table_rank",
    )


def basic_metadata(meta: DataFrame) -> DataFrame:
    """Metadata columns with 0/1 flags as booleans; a null flag counts as false."""
    return meta.selectExpr(
        "id",
        "statistic_id",
        "source",
        "unit_of_measurement",
        "coalesce(CAST(has_mean AS BOOLEAN), false) AS has_mean",
        "coalesce(CAST(has_sum AS BOOLEAN), false) AS has_sum",
        "name",
        "mean_type",
        "unit_class",
    )
