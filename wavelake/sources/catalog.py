"""Expose tables to SQL: temp views, or catalog tables over existing files."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame, SparkSession

from ..functions.columns import ident, sql_str
from . import versions


def register_views(tables: Mapping[str, DataFrame]) -> None:
    for name, df in tables.items():
        df.createOrReplaceTempView(name)


def _qualified(spark: SparkSession, name: str) -> str:
    """The catalog's table, never a temporary view of the same name."""
    return name if "." in name else f"{spark.catalog.currentCatalog()}.{spark.catalog.currentDatabase()}.{name}"


def table_location(spark: SparkSession, name: str) -> str | None:
    """Folder of a catalog table, empty for one that keeps its own data;
    None if there is no such table."""
    table = _qualified(spark, name)
    if not spark.catalog.tableExists(table):
        return None
    facts = {r["col_name"]: r["data_type"] for r in spark.sql(f"DESCRIBE TABLE EXTENDED {table}").collect()}
    return facts.get("Location", "") if facts.get("Type") == "EXTERNAL" else ""


def _plain(location: str) -> str:
    return location.removeprefix("file:").replace("///", "/").rstrip("/")


def register_external(spark: SparkSession, name: str, path: str, partitioned: bool = True) -> None:
    """A catalog table over Parquet files already written; partitions are
    discovered from the folder layout (``MSCK REPAIR TABLE``).  A table of
    that name over the same folder is refreshed.  One over another folder, or
    a managed one, is left alone and refused.  A temporary view of that name,
    which would hide the table, goes; it has no data."""
    table, known = _checked(spark, name, path)
    if not known:
        spark.sql(f"CREATE TABLE {table} USING PARQUET LOCATION {sql_str(path)}")
    if partitioned:
        spark.sql(f"MSCK REPAIR TABLE {table} SYNC PARTITIONS")
    spark.catalog.refreshTable(table)
    if "." not in name:
        spark.catalog.dropTempView(name)


def _checked(spark: SparkSession, name: str, path: str) -> tuple[str, bool]:
    """Qualified name, and whether the table is there; refuses one over
    another folder."""
    table, found = _qualified(spark, name), table_location(spark, name)
    if found is not None and _plain(found) != _plain(path):
        raise ValueError(f"table {name} exists over {found or 'its own data'}, not over {path}")
    return table, found is not None


def register_version(spark: SparkSession, name: str, root: str, table: str, state: versions.Table,
                     held: Iterable[int | str | None] | None = None) -> None:
    """A catalog table over the published version of a table: one partition
    per wave, at the folder of the run that holds it.  With ``held`` only the
    partitions of these waves are set and no other folder is looked at; a new
    table gets all.  Location rules as in ``register_external``."""
    path = f"{root.rstrip('/')}/{table}"
    qualified, known = _checked(spark, name, path)
    if not known:
        columns = ", ".join(f"{ident(f.name)} {f.dataType.simpleString()}" for f in state.struct())
        spark.sql(f"CREATE TABLE {qualified} ({columns}) USING PARQUET PARTITIONED BY ({ident(state.wave)}) "
                  f"LOCATION {sql_str(path)}")
    values = set(state.runs) if not known or held is None else {versions.partition_value(w) for w in held}
    for value in sorted(values):
        spec = f"PARTITION ({ident(state.wave)} = {'null' if value == versions.NULL_PARTITION else sql_str(value)})"
        spark.sql(f"ALTER TABLE {qualified} DROP IF EXISTS {spec}")
        if value in state.runs:
            where = versions.folder(root, table, state.runs[value], state.wave, value)
            spark.sql(f"ALTER TABLE {qualified} ADD {spec} LOCATION {sql_str(where)}")
    spark.catalog.refreshTable(qualified)
    if "." not in name:
        spark.catalog.dropTempView(name)
