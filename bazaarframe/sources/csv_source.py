"""CSV scan that stays splittable where records keep to one line.

Spark reads plain CSV in splits, but needs one task per file once ``multiLine`` is on. Here a first pass over the
text finds the files in which some line ends inside a quoted field. Only those are read with ``multiLine``; all others line by
line. Line breaks inside quoted fields come out as a single line feed.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from bazaarframe.schema import TableSpec
from bazaarframe.sources import files

# Words that stand for a missing value, as pandas' CSV reader knows them.
NULL_WORDS = (
    "",
    "#N/A",
    "#N/A N/A",
    "#NA",
    "-1.#IND",
    "-1.#QNAN",
    "-NaN",
    "-nan",
    "1.#IND",
    "1.#QNAN",
    "<NA>",
    "N/A",
    "NA",
    "NULL",
    "NaN",
    "None",
    "n/a",
    "nan",
    "null",
)

_CSV_OPTIONS = {"quote": '"', "escape": '"', "mode": "FAILFAST"}

# A line in which every quoted field is closed. Possessive throughout, so it runs in linear time.
_FIELD = r'(?:"(?:[^"]++|"")*+"[^,]*+|[^",][^,]*+)?+'
_WHOLE_LINE = rf"\A{_FIELD}(?:,{_FIELD})*+\z"


@dataclass
class CsvScan:
    """The outcome of the first pass: which files have records over several lines, and the size of the others."""

    spark: SparkSession
    columns: list[str]
    plain_files: list[str]
    joined_files: dict[str, range]  # read whole by one task each, with the splits that they would have otherwise
    plain_rows: int | None  # None: not counted

    def frame(self) -> DataFrame:
        """All records as text columns named by the header, missing-value words as NULL."""
        frames = []
        if self.plain_files:
            frames.append(_read(self.spark, self.plain_files, self.columns))
        if self.joined_files:
            frames.append(_read(self.spark, sorted(self.joined_files), self.columns, multiLine=True))
        df = reduce(DataFrame.unionByName, frames)
        words = ", ".join(f"'{word}'" for word in NULL_WORDS)
        return df.selectExpr(*[f"if({c} in ({words}), null, {c}) as {c}" for c in map(_quoted, df.columns)])

    @property
    def rows(self) -> int | None:
        """Number of source records if the first pass could count them, line by line; else None."""
        return None if self.joined_files else self.plain_rows

    def count(self) -> int:
        """Number of source records, with a pass over the files that the first pass could not count."""
        known = self.rows
        return self.frame().count() if known is None else known


def _quoted(column: str) -> str:
    return "`" + column.replace("`", "``") + "`"


def _text_schema(columns: list[str]) -> str:
    return ", ".join(f"{_quoted(c)} string" for c in columns)


def _read(spark: SparkSession, paths: list[str], columns: list[str], **options) -> DataFrame:
    # enforceSchema=False compares every file's header with the columns instead of trusting order. Without pruning the
    # parser counts a row's fields even if some columns are dropped later.
    options = dict(_CSV_OPTIONS, header=True, enforceSchema=False, columnPruning=False, **options)
    return spark.read.schema(_text_schema(columns)).options(**options).csv(paths)


def scan_csv(spark: SparkSession, path: str, line_breaks: bool | None = None) -> CsvScan:
    """First pass over a CSV file or a folder of CSV parts that each carry the header.

    ``line_breaks`` tells whether records may go over several lines, if that is known; it spares the pass, and nothing is
    counted then. A file with such records is read by one task: large ones should come in parts.
    """
    header = spark.read.options(header=True, **_CSV_OPTIONS).csv(path).columns
    if line_breaks is not None:
        found = [path] if line_breaks else []
        return CsvScan(spark, header, [] if line_breaks else [path], {f: range(1) for f in found}, None)
    lines = spark.read.text(path).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("split"), "value"
    )
    quotes = F.length("value") - F.length(F.replace("value", F.lit('"'), F.lit("")))
    per_split = lines.groupBy("file", "split").agg(
        F.count_if(F.col("value").rlike(r"[^\x00-\x20]")).alias("lines"),
        F.sum(quotes).alias("quotes"),
        # A line without quotes is whole.
        F.count_if(F.contains("value", F.lit('"')) & ~F.col("value").rlike(_WHOLE_LINE)).alias("open_lines"),
    )
    per_file = per_split.groupBy("file").agg(
        *[F.sum(c).alias(c) for c in ("lines", "quotes", "open_lines")], F.count("*").alias("splits")
    )
    plain, joined, plain_rows = [], {}, 0
    for row in per_file.collect():  # one row per file
        if row["open_lines"]:
            if row["quotes"] % 2:
                raise ValueError(f"{row['file']}: the file ends inside a quoted field, or a quote inside an unquoted field hides where it ends")
            joined[row["file"]] = range(row["splits"])
        else:
            plain.append(row["file"])
            plain_rows += max(row["lines"] - 1, 0)
    return CsvScan(spark, header, sorted(plain), joined, plain_rows)


def find_csv(spark: SparkSession, raw_dir: str, spec: TableSpec, names: dict[str, str] | None = None) -> str:
    """Path of a table's CSV file or folder of parts; ``names`` overrides the accepted names."""
    patterns = (names[spec.name],) if names and spec.name in names else spec.file_patterns
    found = sorted({path for pattern in patterns for path in files.glob(spark, f"{raw_dir.rstrip('/')}/{pattern}")})
    if not found:
        raise FileNotFoundError(f"Dataset not found: {raw_dir} has no file named {' or '.join(patterns)}")
    if len(found) > 1:
        raise ValueError(f"{spec.name}: several files match: {found}")
    return found[0]


def scan_csv_table(
    spark: SparkSession, raw_dir: str, spec: TableSpec, names: dict[str, str] | None = None, line_breaks: bool | None = None
) -> CsvScan:
    return scan_csv(spark, find_csv(spark, raw_dir, spec, names), line_breaks)


def read_csv_table(
    spark: SparkSession, raw_dir: str, spec: TableSpec, names: dict[str, str] | None = None
) -> DataFrame:
    """A table's source file as text columns, extra columns included."""
    return scan_csv_table(spark, raw_dir, spec, names).frame()


def read_csv_folder(spark: SparkSession, raw_dir: str) -> dict[str, DataFrame]:
    """Every ``*.csv`` of a folder by file name, in name order."""
    found = files.glob(spark, f"{raw_dir.rstrip('/')}/*.csv")
    if not found:
        raise FileNotFoundError(f"No CSV files found in {raw_dir}")
    return {path.rsplit("/", 1)[-1]: scan_csv(spark, path).frame() for path in found}
