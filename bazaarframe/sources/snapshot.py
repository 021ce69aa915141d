"""Parquet snapshots published all or nothing.

Each table version is a directory of its own; a numbered file in ``_manifests`` names the version of every
table, and the highest number is current. A load writes new directories, checks them, and creates the next number
last, which never overwrites: of two loads at once the later one checks its tables against the other's and takes the number
after. Readers resolve the manifest once, so they keep a consistent set of tables while a load is running, and a failed load
changes nothing.

A manifest may also name derived tables, each with the versions of the tables it was computed from. A load that replaces one of
those either computes the derived table again from its own staged tables or leaves it out, so no reader meets one that is
older than its inputs.
"""

from __future__ import annotations

import json
import uuid
from datetime import datetime, timezone

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from bazaarframe.operators.checks import constraint_violations, key_changes, orphaned_by, union_all
from bazaarframe.plans.derived import COMPRESSION, DERIVED, write_derived
from bazaarframe.schema import TABLES
from bazaarframe.session import shuffles_dropped
from bazaarframe.sources import files
from bazaarframe.tables import Tables

# Tables stored in ranges of a column, so that files outside a filtered period are skipped by their
# minimum and maximum. The key behind it splits runs of equal or unknown times.
STORED_BY = {"orders": ("order_purchase_timestamp", "order_id")}


def _manifests(root: str) -> str:
    return f"{root.rstrip('/')}/_manifests"


def _latest(spark: SparkSession, root: str) -> int:
    """Number of the current manifest; 0 if nothing is published."""
    names = [path.rsplit("/", 1)[-1] for path in files.glob(spark, f"{_manifests(root)}/*.json")]
    return max((int(name.split(".")[0]) for name in names if name.split(".")[0].isdigit()), default=0)


class StaleDerivedTable(ValueError):
    """A derived table whose inputs are not the tables beside it."""


def _content(spark: SparkSession, root: str, number: int) -> dict:
    """A manifest as written: version, tables, derived; empty for number 0."""
    if not number:
        return {"tables": {}, "derived": {}}
    return {"derived": {}} | json.loads(files.read_text(spark, f"{_manifests(root)}/{number:06}.json"))


def _absolute(root: str, tables: dict[str, str]) -> dict[str, str]:
    return {name: f"{root.rstrip('/')}/{relative}" for name, relative in tables.items()}


def _manifest(spark: SparkSession, root: str, number: int) -> dict[str, str]:
    return _absolute(root, _content(spark, root, number)["tables"])


def _fresh(tables: dict[str, str], entry: dict) -> bool:
    """Whether a derived table was computed from these versions."""
    return all(tables.get(name) == version for name, version in entry["inputs"].items())


def derived_paths(spark: SparkSession, root: str, content: dict | None = None) -> dict[str, str]:
    """Directories of the current derived tables; raises if one is older than the tables beside it."""
    content = content or _content(spark, root, _latest(spark, root))
    for name, entry in content["derived"].items():
        if not _fresh(content["tables"], entry):
            raise StaleDerivedTable(f"{name} was computed from {entry['inputs']}, the snapshot has other versions")
    return _absolute(root, {name: entry["path"] for name, entry in content["derived"].items()})


def write_table(df: DataFrame, path: str, name: str, mode: str = "errorifexists") -> int:
    """Write a table's modelled columns by name; ``mode='append'`` adds to what is there. Returns the rows written.

    Rows are counted by the job that writes them, behind the exchange: a range exchange reads its input twice.
    """
    df = df.select(*TABLES[name].column_names)
    if name in STORED_BY:
        df = df.repartitionByRange(*STORED_BY[name]).sortWithinPartitions(*STORED_BY[name])
    seen = Observation()
    df.observe(seen, F.count(F.lit(1)).alias("rows")).write.mode(mode).parquet(path, compression=COMPRESSION)
    return seen.get["rows"]


def current_paths(spark: SparkSession, root: str) -> dict[str, str]:
    """Table directories of the published snapshot."""
    number = _latest(spark, root)
    if not number:
        raise FileNotFoundError(f"No snapshot published under {root}")
    return _manifest(spark, root, number)


def _read(spark: SparkSession, paths: dict[str, str]) -> dict[str, DataFrame]:
    return {name: spark.read.schema(TABLES[name].struct).parquet(path) for name, path in paths.items()}


def open_snapshot(spark: SparkSession, root: str, derived: bool = True) -> Tables:
    """The published tables, with the derived ones unless they are not wanted. The pointer is read once, here."""
    number = _latest(spark, root)
    if not number:
        raise FileNotFoundError(f"No snapshot published under {root}")
    content = _content(spark, root, number)
    t = Tables(**_read(spark, _absolute(root, content["tables"])))
    if derived:
        stored = derived_paths(spark, root, content)
        t = t.with_derived(**{name: spark.read.parquet(path) for name, path in stored.items() if name in DERIVED})
    return t


def row_counts(tables: Tables | dict[str, DataFrame]) -> DataFrame:
    """(table_name, row_count) of each table; Parquet answers it from file footers."""
    frames = tables.as_dict() if isinstance(tables, Tables) else tables
    return union_all(
        [df.selectExpr(f"'{name}' as table_name", "count(*) as row_count") for name, df in frames.items()]
    )


def verify_counts(frames: dict[str, DataFrame], expected: dict[str, int]) -> dict[str, int]:
    """Stored row counts; raises if any differs from the number of source rows."""
    actual = {row["table_name"]: row["row_count"] for row in row_counts(frames).collect()}
    wrong = {n: (expected[n], actual.get(n)) for n in expected if expected[n] != actual.get(n)}
    if wrong:
        raise ValueError(f"source/stored row count mismatch: {wrong}")
    return actual


def _require(*violations: DataFrame) -> None:
    """Raise if any rule (table_name, rule, violations) is violated, with the broken ones of all frames."""
    broken = [row for rules in violations for row in rules.where("violations > 0").collect()]
    if broken:
        found = "; ".join(f"{r['table_name']}: {r['rule']} ({r['violations']} rows)" for r in broken)
        raise ValueError(f"constraints violated: {found}")


def _check_groups() -> list[list[str]]:
    """All tables, in the groups that are checked one after another, so that only one group's keys are shuffled to disk at once.

    The small ones and those that others refer to come together; of the others each for itself.
    """
    parents = {fk.parent for spec in TABLES.values() for fk in spec.foreign_keys}
    alone = [name for name, spec in TABLES.items() if spec.foreign_keys and name not in parents]
    return [[name for name in TABLES if name not in alone], *[[name] for name in alone]]


def _require_constraints(frames: dict[str, DataFrame], names: list[str], changes: DataFrame | None = None) -> None:
    """Check the named tables with the others; with the key changes of the only one, dependants meet the removed keys alone."""
    if set(names) == set(TABLES):  # every reference starts from one of them
        _require(*[constraint_violations(frames, group, incoming=False) for group in _check_groups()])
    else:
        _require(constraint_violations(frames, names, incoming=changes is None))
    if changes is not None and not changes.where("change = 'removed'").isEmpty():
        orphans = orphaned_by(changes, frames, names[0])
        rule = F.concat(F.lit("reference "), F.col("column_name")).alias("rule")
        _require(orphans.groupBy("table_name", rule).agg(F.sum("rows").alias("violations")))


def _version() -> str:
    return f"{datetime.now(timezone.utc):%Y%m%dT%H%M%S}-{uuid.uuid4().hex[:8]}"


def _publish(
    spark: SparkSession,
    root: str,
    changed: dict[str, DataFrame],
    expected: dict[str, int],
    derived: tuple[str, ...] = (),
    by_difference: bool = False,
) -> str:
    """Write the changed tables, check them with the others as they are published, and publish all together.

    ``by_difference``: a single table takes the place of an older one; their key changes are stored beside it, named in the manifest, and
    dependants are checked against the removed keys only.

    ``derived`` tables are computed from the tables as they will be published, unless the manifest has them already from
    the same versions; others that are no longer good are left out. If another load publishes meanwhile, all
    of this is done again with its tables. Once a manifest was tried, the staged tables stay unless the manifest of that number can be read
    and does not name them.
    """
    root = root.rstrip("/")
    version = _version()
    staged = {name: f"{root}/{name}/{version}" for name in changed}
    built: dict[str, dict] = {}  # derived tables written by this load
    scrap: list[str] = []  # those of them that another load has made old
    tried = None
    try:
        written = {name: write_table(df, staged[name], name) for name, df in changed.items()}
        if staged:
            verify_counts(_read(spark, staged), {**written, **expected})
        while True:
            number = _latest(spark, root)
            before = _content(spark, root, number)
            paths = {**_absolute(root, before["tables"]), **staged}
            changes, compared = {}, None
            if by_difference:
                (name,) = staged
                place = f"changes/{name}/{_version()}"
                changes[name] = {"path": place, "from": before["tables"][name]}
                scrap.append(f"{root}/{place}")
                old = _read(spark, _absolute(root, {name: before["tables"][name]}))[name]
                key_changes(old, _read(spark, staged)[name], TABLES[name]).write.parquet(scrap[-1])
                compared = spark.read.parquet(scrap[-1])
            if staged:
                _require_constraints(_read(spark, paths), list(staged), compared)
            relative = {name: path[len(root) + 1 :] for name, path in paths.items()}
            known = {**before["derived"], **built}
            entries = {name: entry for name, entry in known.items() if _fresh(relative, entry)}
            scrap += [f"{root}/{entry['path']}" for name, entry in built.items() if name not in entries]
            for name in derived:
                if name not in entries:
                    entries[name] = built[name] = _build(spark, root, name, paths, relative, entries)
            content = {"version": version, "tables": relative, "derived": entries, "changes": changes}
            text = json.dumps(content, indent=1, sort_keys=True)
            tried = number + 1
            if files.create_text(spark, f"{_manifests(root)}/{tried:06}.json", text, f"{_manifests(root)}/{version}.new"):
                for path in scrap:
                    if path not in _absolute(root, {n: c["path"] for n, c in changes.items()}).values():
                        files.delete(spark, path)
                return version
            tried = None
    except Exception:
        mine = {**staged, **{name: f"{root}/{entry['path']}" for name, entry in built.items()}}
        if tried is None or not _may_be_published(spark, root, tried, mine):
            for path in [*mine.values(), *scrap]:
                files.delete(spark, path)
        raise


def _build(
    spark: SparkSession, root: str, name: str, paths: dict[str, str], relative: dict[str, str], known: dict[str, dict]
) -> dict:
    """Compute a derived table from tables at these paths and the derived ones known already; its entry in the manifest."""
    place = f"derived/{name}/{_version()}"
    others = {other: spark.read.parquet(f"{root}/{entry['path']}") for other, entry in known.items() if other in DERIVED}
    write_derived(Tables(**_read(spark, paths)).with_derived(**others), name, f"{root}/{place}")
    return {"path": place, "inputs": {table: relative[table] for table in DERIVED[name].inputs}}


def _may_be_published(spark: SparkSession, root: str, number: int, staged: dict[str, str]) -> bool:
    """Whether the manifest of that number names the staged tables, or cannot be read to tell."""
    try:
        if _latest(spark, root) < number:
            return False
        content = _content(spark, root, number)
        named = {**content["tables"], **{name: entry["path"] for name, entry in content["derived"].items()}}
        return any(path in staged.values() for path in _absolute(root, named).values())
    except Exception:  # no answer is no licence to delete
        return True


def publish_snapshot(
    spark: SparkSession,
    root: str,
    tables: Tables | dict[str, DataFrame],
    expected: dict[str, int] | None = None,
    derived: tuple[str, ...] = (),
) -> str:
    """Write all eight tables as a new snapshot and make it current; returns its version.

    ``expected`` holds source row counts to verify the stored tables against, ``derived`` names tables to compute from it.
    """
    frames = tables.as_dict() if isinstance(tables, Tables) else tables
    missing = [name for name in TABLES if name not in frames]
    if missing:
        raise ValueError(f"a full snapshot needs all tables, missing {missing}")
    with shuffles_dropped(spark):
        return _publish(spark, root, {name: frames[name] for name in TABLES}, expected or {}, derived)


def _to_rebuild(spark: SparkSession, root: str, rebuild: bool) -> tuple[str, ...]:
    return tuple(_content(spark, root, _latest(spark, root))["derived"]) if rebuild else ()


def replace_table(
    spark: SparkSession, root: str, name: str, df: DataFrame, expected_rows: int | None = None, rebuild: bool = False
) -> str:
    """Publish a snapshot with one table replaced and the other seven shared, not copied.

    The new version is compared with the old one by key. Tables that refer to it are checked against the removed keys: unlike an
    emptying cascade, a reload that would orphan their rows is refused, and one that removes no key reads none of them.
    Derived tables that read it are dropped from the snapshot, or computed again and published with it if ``rebuild`` is
    true.
    """
    current_paths(spark, root)  # there must be a snapshot
    expected = {} if expected_rows is None else {name: expected_rows}
    with shuffles_dropped(spark):
        return _publish(spark, root, {name: df}, expected, _to_rebuild(spark, root, rebuild), by_difference=True)


def last_changes(spark: SparkSession, root: str) -> dict[str, DataFrame]:
    """By table the key changes (key columns, change) that the current manifest's load made, if it replaced a table."""
    changes = _content(spark, root, _latest(spark, root)).get("changes", {})
    return {name: spark.read.parquet(f"{root.rstrip('/')}/{entry['path']}") for name, entry in changes.items()}


def would_orphan(spark: SparkSession, root: str, name: str, df: DataFrame) -> DataFrame:
    """Rows (table_name, column_name, key, rows) that a reload with this table would leave without parent; nothing is changed."""
    paths = current_paths(spark, root)
    frames = _read(spark, paths)
    return orphaned_by(key_changes(frames[name], df, TABLES[name]), frames, name)


def derive(spark: SparkSession, root: str, *names: str) -> str:
    """Compute derived tables (all known ones by default) of the current snapshot where they are missing, and publish them.

    Tables that a load replaces meanwhile are read again: what is published fits the tables beside it.
    """
    unknown = [name for name in names if name not in DERIVED]
    if unknown:
        raise ValueError(f"no such derived table: {unknown}; known are {sorted(DERIVED)}")
    current_paths(spark, root)
    with shuffles_dropped(spark):
        return _publish(spark, root, {}, {}, names or tuple(DERIVED))
