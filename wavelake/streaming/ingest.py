"""New wave files -> silver rows, incrementally.

The reference re-runs its batch jobs over whole folders.  When editions
arrive as files over time, the same per-row silver operators (harmonise,
multi-select unpivot with a static option table, answer normalisation) run
as a Structured Streaming query over the CSV folder:

* source: file stream with the edition's all-string schema (no inference);
* transform: the stateless part of the silver builders (no dedupe, so no
  unbounded streaming state);
* sink: Parquet, append, partitioned by wave, with a checkpoint location in
  the shared folder -- the file source and sink together are exactly-once
  and a restarted query resumes where it stopped;
* ``trigger(availableNow=True)``: process what has arrived, then stop.

The de-duplicated silver is ``read_silver``: the batch dedupe operator over
the accumulated table (deterministic, combined map-side).
"""

from __future__ import annotations

import dataclasses

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from ..operators.dedupe import dedupe
from ..plans import silver
from ..plans.config import Edition, Questionnaire
from ..sources.csv import CSV_OPTIONS
from ..sources.parquet import read_table

BUILDERS = {"entities": silver.entities, "selections": silver.selections, "answers": silver.answers}
KEYS = {"entities": [], "selections": ["category", "item"], "answers": ["dimension", "answer"]}


def stream_silver(spark: SparkSession, q: Questionnaire, edition: Edition, headers: list[str], source_dir: str,
                  target: str, checkpoint: str, table: str = "entities", available_now: bool = True,
                  processing_time: str | None = None) -> StreamingQuery:
    """Start the incremental silver query for one edition's folder."""
    schema = T.StructType([T.StructField(h, T.StringType(), True) for h in headers])
    # a file whose header differs from the schema fails instead of being read by position
    stream = spark.readStream.options(**CSV_OPTIONS, enforceSchema="false").schema(schema).csv(source_dir)
    one = dataclasses.replace(q, editions=[edition])
    rows = BUILDERS[table](one, {edition.name: stream}, deduplicate=False)
    writer = (rows.writeStream.format("parquet").outputMode("append").partitionBy(q.wave_name)
              .option("path", target).option("checkpointLocation", checkpoint))
    if processing_time:
        writer = writer.trigger(processingTime=processing_time)
    elif available_now:
        writer = writer.trigger(availableNow=True)
    return writer.start()


def read_silver(spark: SparkSession, q: Questionnaire, target: str, table: str = "entities") -> DataFrame:
    """The accumulated rows, de-duplicated on the table key."""
    rows = read_table(spark, target)
    keys = [q.wave_name, q.id_name] + KEYS[table]
    order = {"entities": list(q.dedupe_order), "selections": ["item_original", "question"],
             "answers": ["block", "answer_original"]}[table]
    cols = [c for c in rows.columns if c != q.wave_name]
    cols.insert(1, q.wave_name)
    return dedupe(rows.select(*cols), keys, order=order)
