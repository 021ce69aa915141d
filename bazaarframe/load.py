"""Loads raw CSV files into a published snapshot."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from bazaarframe.operators.checks import check_columns, constraint_violations, require_valid, union_all
from bazaarframe.operators.clean import clean_text_columns, project_to_spec
from bazaarframe.schema import TABLES, TableSpec
from bazaarframe.session import shuffles_dropped, size_for, tune
from bazaarframe.sources.csv_source import find_csv, scan_csv, scan_csv_table
from bazaarframe.sources.snapshot import open_snapshot, publish_snapshot, replace_table, row_counts, write_table

# Fixed value: the column that the single-table customer file must have although it is not kept.
CUSTOMER_FILE_COLUMNS = ("customer_zip_code_prefix",)


def _typed(name: str, kind: T.DataType) -> str:
    """SQL for the typed value of a text column, NULL if it does not convert."""
    if isinstance(kind, T.IntegerType):
        # Through a decimal: "500.0" and "5e2" are whole numbers too, and halves round up.
        return f"try_cast(round(try_cast({name} as decimal(38,10)), 0) as int)"
    return f"try_cast({name} as {kind.simpleString()})"


def coerce(df: DataFrame, spec: TableSpec) -> DataFrame:
    """Cast text columns to the declared types; a value that does not convert fails the job."""
    columns = []
    for c in spec.columns:
        kind = c.type.simpleString()
        if isinstance(c.type, T.StringType):
            columns.append(f"cast({c.name} as string) as {c.name}")
            continue
        typed = _typed(c.name, c.type)
        message = f"concat('{spec.name}.{c.name}: not a {kind}: ', {c.name})"
        columns.append(
            f"coalesce({typed}, case when {c.name} is not null then cast(raise_error({message}) as {kind}) end) as {c.name}"
        )
    return df.selectExpr(*columns)


def prepare(df: DataFrame, spec: TableSpec, also: tuple[str, ...] = ()) -> DataFrame:
    """From a raw text frame to the typed, tidied table."""
    check_columns(df, spec, also)
    return coerce(clean_text_columns(project_to_spec(df, spec)), spec)


def rejects(
    spark: SparkSession, raw_dir: str, names: dict[str, str] | None = None, line_breaks: dict[str, bool] | None = None
) -> DataFrame:
    """Values that do not convert to their column's type: (table_name, column_name, file, value, rows), in one pass a table.

    ``file`` is the name of the table's file or folder. For finding all faults of a delivery at once; a load stops at the
    first.
    """
    size_for(tune(spark), raw_dir)
    found = []
    for name, spec in TABLES.items():
        path = find_csv(spark, raw_dir, spec, names)
        text = clean_text_columns(project_to_spec(scan_csv(spark, path, (line_breaks or {}).get(name)).frame(), spec))
        typed = [c for c in spec.columns if not isinstance(c.type, T.StringType)]
        if not typed:
            continue
        bad = [
            f"case when {c.name} is not null and {_typed(c.name, c.type)} is null"
            f" then named_struct('column_name', '{c.name}', 'value', {c.name}) end"
            for c in typed
        ]
        rows = text.selectExpr(f"inline(array_compact(array({', '.join(bad)})))")
        file = F.lit(path.rstrip("/").rsplit("/", 1)[-1]).alias("file")
        found.append(
            rows.groupBy("column_name", "value")
            .agg(F.count("*").alias("rows"))
            .select(F.lit(name).alias("table_name"), "column_name", file, "value", "rows")
        )
    return union_all(found)


def refusals(
    spark: SparkSession, raw_dir: str, folder: str, names: dict[str, str] | None = None, line_breaks: dict[str, bool] | None = None
) -> DataFrame:
    """What a load of these files would be refused for: (table_name, rule, violations), none if it would pass.

    The tables are written below ``folder`` and checked there, as a load does; nothing is published.
    """
    size_for(tune(spark), raw_dir)
    stored = {}
    for name, spec in TABLES.items():
        scan = scan_csv_table(spark, raw_dir, spec, names, (line_breaks or {}).get(name))
        path = f"{folder.rstrip('/')}/{name}"
        with shuffles_dropped(spark):
            write_table(prepare(scan.frame(), spec), path, name)
        stored[name] = spark.read.schema(spec.struct).parquet(path)
    return constraint_violations(stored).where("violations > 0")


def source_and_stored_counts(spark: SparkSession, raw_dir: str, root: str, names: dict[str, str] | None = None) -> DataFrame:
    """(table_name, source_rows, stored_rows) of the published snapshot and the files it came from."""
    counts = row_counts(open_snapshot(spark, root)).withColumnRenamed("row_count", "stored_rows")
    sources = [(name, scan_csv_table(spark, raw_dir, spec, names).count()) for name, spec in TABLES.items()]  # one number a table
    return spark.createDataFrame(sources, "table_name string, source_rows long").join(counts, "table_name")


def run_load(
    spark: SparkSession,
    raw_dir: str,
    root: str,
    names: dict[str, str] | None = None,
    derived: tuple[str, ...] = (),
    line_breaks: dict[str, bool] | None = None,
) -> str:
    """Load all eight files and publish them together; returns the snapshot's version.

    All files are found and their columns checked before anything is written. Keys, references and
    value rules are checked on the written Parquet, which is far cheaper to scan than the text, and
    before the snapshot becomes current. ``derived`` names tables to compute from it and publish with it. Rows are
    counted where they pass on their way into the files; ``line_breaks`` says of which tables it is known whether records go
    over several lines, and spares their files the pass that finds out.
    """
    size_for(tune(spark), raw_dir)
    known = line_breaks or {}
    scans = {name: scan_csv_table(spark, raw_dir, spec, names, known.get(name)) for name, spec in TABLES.items()}
    prepared = {name: prepare(scan.frame(), TABLES[name]) for name, scan in scans.items()}
    expected = {name: scan.rows for name, scan in scans.items() if scan.rows is not None}
    return publish_snapshot(spark, root, prepared, expected, derived)


def customers_to_reload(spark: SparkSession, raw_dir: str, names: dict[str, str] | None = None) -> tuple[DataFrame, int | None]:
    """The customer file as a typed table, and the number of its records if it is known."""
    spec = TABLES["customers"]
    path = find_csv(spark, raw_dir, spec, names)
    size_for(tune(spark), path)
    scan = scan_csv(spark, path)
    return prepare(scan.frame(), spec, CUSTOMER_FILE_COLUMNS), scan.rows


def reload_customers(
    spark: SparkSession, raw_dir: str, root: str, names: dict[str, str] | None = None, rebuild: bool = False
) -> str:
    """Reload customers alone from their file, as replace_table does."""
    table, rows = customers_to_reload(spark, raw_dir, names)
    return replace_table(spark, root, "customers", table, rows, rebuild)


def validate_frame(df: DataFrame, spec: TableSpec) -> None:
    """Column, key and uniqueness check of any frame, stored or not."""
    check_columns(df, spec)
    require_valid(df, spec)
