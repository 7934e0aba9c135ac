"""End-to-end medallion job: bronze editions -> silver -> gold, persisted.

Each layer is written as wave-partitioned Parquet below ``root`` (a shared
folder, e.g. under ``spark.checkpoint.dir`` or the lake), in folders of this
run, and the next layer reads the written files back; one manifest publishes
all tables at the end.  That cuts the lineage at every layer, so a lost
executor recomputes at most one layer from files, never from the raw CSVs, and
every check or report re-reads compact Parquet instead of re-running the job.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import scratch
from ..functions.columns import ident, tolerant_int_sql
from ..sources import versions
from ..sources.catalog import register_version, register_views
from ..sources.landing import land
from . import gold, silver
from .config import Questionnaire

SILVER = ("entities", "selections", "answers")
GOLD = ("profile", "pay", "technologies", "gold_answers")


def _rename(df: DataFrame, names: Mapping[str, str]) -> DataFrame:
    return df.select(*[F.col(c).alias(names.get(c, c)) for c in df.columns]) if names else df


def held_waves(q: Questionnaire, bronze: Mapping[str, DataFrame]) -> list[int | None]:
    """The waves that these editions hold: as configured, or for an edition
    with a wave column the values in it (a scan of that column)."""
    held: set[int | None] = set()
    for e in q.editions:
        if isinstance(e.wave, int):
            held.add(e.wave)
        else:
            column = bronze[e.name].selectExpr(f"{tolerant_int_sql(ident(e.wave))} AS w")
            held |= {r["w"] for r in column.distinct().collect()}
    return sorted(held, key=lambda w: (w is None, w))


class _Run:
    """One run's writes: every table goes to folders of its own, and nothing
    is seen before ``publish``."""

    def __init__(self, spark: SparkSession, root: str, wave: str, held: list[int | None]):
        self.spark, self.root, self.wave, self.held = spark, root, wave, held
        self.seen, self.run = versions.current(spark, root), versions.new_run()
        self.tables: dict[str, versions.Table] = {}

    def write(self, df: DataFrame, table: str, names: Mapping[str, str]) -> DataFrame:
        """Write a table under its stored column names and read it back under
        the engine's, in the order of ``df``."""
        self.tables[table] = versions.write_run(_rename(df, names), self.root, table, self.run,
                                                names.get(self.wave, self.wave), self.held)
        return self._engine(versions.read_run(self.spark, self.root, table, self.tables[table]), df.columns, names)

    def publish(self) -> versions.Manifest:
        return versions.publish(self.spark, self.root, self.seen, self.tables, self.held)

    @staticmethod
    def _engine(stored: DataFrame, columns: list[str], names: Mapping[str, str]) -> DataFrame:
        return _rename(stored, {v: k for k, v in names.items()}).select(*columns)


def run(spark: SparkSession, q: Questionnaire, bronze: Mapping[str, DataFrame], root: str,
        table_names: Mapping[str, str] | None = None,
        output_names: Mapping[str, Mapping[str, str]] | None = None,
        land_bronze: bool = True, catalog: bool = False) -> dict[str, DataFrame]:
    """Build, write and register all seven tables; returns them as read back.

    Only the waves held by ``bronze`` are rebuilt, in silver and in gold;
    other waves of tables already below ``root`` stay.  All tables change at
    once, by one manifest (``sources.versions``): a run that fails anywhere
    before leaves every reader on the version before.  The tables are
    registered as temporary views, or with ``catalog`` as durable external
    tables over the published folders, after the manifest; a run that dies in
    between is made good by the next one or by ``register_catalog``.

    ``table_names`` name the registered views / folders; ``output_names``
    rename stored columns per table (e.g. to a legacy schema).  With
    ``land_bronze`` each wide edition is read once and landed as Parquet, so
    the three silver builds read only their own columns."""
    table_names = dict(table_names or {k: k for k in SILVER + GOLD})
    output_names = output_names or {}
    root = root.rstrip("/")
    with scratch.scope(spark):
        if land_bronze:
            bronze = {name: land(df, f"{root}/bronze_landed/{name}") for name, df in bronze.items()}
        held = held_waves(q, bronze)
        work = _Run(spark, root, q.wave_name, held)
        builders = {"entities": silver.entities, "selections": silver.selections, "answers": silver.answers}
        new = {key: work.write(builders[key](q, bronze), _table(key, table_names), output_names.get(key, {}))
               for key in SILVER}
        gold_frames = {"profile": lambda: gold.profile(q, new["entities"]), "pay": lambda: gold.pay(q, new["entities"]),
                       "technologies": lambda: gold.technologies(q, new["selections"]),
                       "gold_answers": lambda: gold.answers(q, new["answers"])}
        for key in GOLD:
            new[key] = work.write(gold_frames[key](), _table(key, table_names), output_names.get(key, {}))
        published = work.publish()
    out = {}
    for key in SILVER + GOLD:
        name, names = _table(key, table_names), output_names.get(key, {})
        out[key] = work._engine(versions.read_run(spark, root, name, published.tables[name]), new[key].columns, names)
    if catalog:
        register_catalog(spark, root, table_names, published, held)
    else:
        register_views({table_names[k]: _rename(df, output_names.get(k, {})) for k, df in out.items()})
    return out


def _table(key: str, table_names: Mapping[str, str]) -> str:
    """Folder of a table below the root."""
    return f"{'silver' if key in SILVER else 'gold'}/{table_names[key]}"


def register_catalog(spark: SparkSession, root: str, table_names: Mapping[str, str],
                     published: versions.Manifest | None = None, held: list[int | None] | None = None) -> None:
    """External tables over the published folders; all waves, or the ``held``
    ones of tables that are registered already."""
    published = published or versions.current(spark, root)
    for key, name in table_names.items():
        table = _table(key, table_names)
        register_version(spark, name, root, table, published.tables[table], held)
