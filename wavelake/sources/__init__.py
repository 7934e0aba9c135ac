"""Sources and sinks: wide CSV waves, wave-partitioned Parquet, catalog, report CSV."""

from .catalog import register_external, register_version, register_views
from .csv import read_wave_csv, write_wave_csv
from .export import export_report, read_report
from .landing import land, read_landed
from .parquet import read_table, replace_waves, write_partitioned

__all__ = ["register_external", "register_version", "register_views", "read_wave_csv", "write_wave_csv",
           "export_report", "read_report", "land", "read_landed", "read_table", "replace_waves", "write_partitioned"]
