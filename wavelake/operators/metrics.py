"""Indicators: distinct-entity shares with correct denominators, ranks, top-k.

Core shape (``distinct_share``): one aggregate with two grouping sets,

    (outer..., inner..., numerator-flag)   -> numerator
    (outer...)                              -> denominator

both as ``count(DISTINCT id)``, then the denominator is spread to its detail
rows by a window over ``outer`` where these are few, one per option of a form,
else together with the ranks (``row_numbers``).  One scan of the input.  The distinct aggregate is
planned as partial dedupe -> shuffle on (keys, id) -> count, so a hot key is
combined map-side and never lands whole on one task.

Where an id stands at most once per (outer) already (``unique_ids``), a plain
``count(id)`` per detail group is enough and the denominator is the sum of
the group counts: the shuffle carries one row per group and task, no id.
Where it stands at most once per (outer, inner) (``unique_items``), as after
the dedupe of a long table, the numerator is a plain count as well and only
(outer, id) is made distinct, for the denominator.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .. import scratch
from ..functions.bands import BandSpec, band_anomaly, band_order
from ..functions.columns import not_blank, safe_col
from ..functions.numeric import percent


def _c(x: str | Column) -> Column:
    return safe_col(x) if isinstance(x, str) else x


Stored = Callable[[DataFrame], DataFrame]


def row_numbers(df: DataFrame, partition: Sequence[str], order: Sequence[Column], name: str,
                stored: Stored | None = None, bounded: bool = False, numbered: Column | None = None,
                total: tuple[str, Column, Callable[[Column], Column]] | None = None) -> DataFrame:
    """``row_number`` within ``partition``.

    No task holds a whole group, since free text can have any number of
    values: rows are range partitioned by group and order and written with the
    number of their range, numbered within it, and raised by the sizes of the
    group's lower ranges.  The written copy (``scratch.store``, or ``stored``)
    keeps both passes on the same ranges.  ``bounded`` states that a group is
    small, such as the options of a form: a window then sorts it in one task,
    without a copy.

    ``numbered`` leaves only these rows; ``total`` = (name, aggregate, how
    aggregates combine) adds an aggregate over all rows of the group, put
    together from one value per range."""
    if bounded:
        out = df
        if total:
            out = out.withColumn(total[0], total[1].over(Window.partitionBy(*partition)))
        out = out if numbered is None else out.filter(numbered)
        return out.withColumn(name, F.row_number().over(Window.partitionBy(*partition).orderBy(*order)))
    stored = stored or (lambda frame: scratch.store(frame, "ranges"))
    columns = df.columns
    ranged = stored(df.repartitionByRange(*[F.col(c) for c in partition], *order)
                    .withColumn("_range", F.spark_partition_id()))
    wanted = F.lit(True) if numbered is None else numbered
    sizes = ranged.groupBy(*partition, "_range").agg(F.count_if(wanted).alias("_n"),
                                                     (total[1] if total else F.lit(0)).alias("_part"))
    group = Window.partitionBy(*partition)  # one row per range
    lower = group.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select(*[F.col(c).alias(f"_g{i}") for i, c in enumerate(partition)], F.col("_range").alias("_r"),
                           F.coalesce(F.sum("_n").over(lower), F.lit(0)).alias("_offset"),
                           (total[2]("_part").over(group) if total else F.lit(0)).alias("_total"))
    own = ranged.filter(wanted).withColumn(
        name, F.row_number().over(Window.partitionBy(*partition, "_range").orderBy(*order)))
    same = F.col("_range") == F.col("_r")
    for i, c in enumerate(partition):
        same &= F.col(c).eqNullSafe(F.col(f"_g{i}"))
    return own.join(offsets, same).select(*columns, *([F.col("_total").alias(total[0])] if total else []),
                                          (F.col(name) + F.col("_offset")).cast("int").alias(name))


def distinct_share(df: DataFrame, outer: Sequence[str], inner: Sequence[str], id_col: str, *,
                   count_name: str = "count", total_name: str = "total", pct_name: str = "percent",
                   numerator: Column | None = None, rank_name: str | None = None,
                   rank_order: Sequence[Column] | None = None, unique_ids: bool = False,
                   unique_items: bool = False, stored: Stored | None = None, bounded: bool = False) -> DataFrame:
    """Per (outer, inner): distinct ids (numerator rows only), distinct ids of
    all rows of (outer) as the base, the percentage and optionally a
    ``row_number`` rank within (outer).  ``unique_ids`` states that no id
    occurs twice in (outer), ``unique_items`` that none does in (outer,
    inner); ``stored`` and ``bounded`` say how ranks are made (see
    ``row_numbers``).  They change the plan, not the result."""
    outer, inner = list(outer), list(inner)
    flag = (numerator if numerator is not None else F.lit(True)).alias("_num")
    base = df.select(*[_c(c) for c in outer + inner], _c(id_col).alias("_id"), flag)
    keys = outer + inner + ["_num"]
    if unique_ids:
        agg = base.groupBy(*keys).agg(F.count("_id").alias(count_name))
        wanted, total = F.col("_num"), (total_name, F.sum(count_name), F.sum)
    elif unique_items:
        agg = base.groupBy(*keys).agg(F.count("_id").alias(count_name)).withColumn("_g", F.lit(0)).unionByName(
            base.groupBy(*outer).agg(F.count_distinct("_id").alias(count_name)).withColumn("_g", F.lit(1)),
            allowMissingColumns=True)
    else:
        agg = (base.groupingSets([keys, outer], *keys)
               .agg(F.count_distinct("_id").alias(count_name), F.grouping_id().alias("_g")))
    if not unique_ids:
        wanted = (F.col("_g") == 0) & F.col("_num")
        total = (total_name, F.max(F.when(F.col("_g") != 0, F.col(count_name))), F.max)
    if rank_name:
        order = list(rank_order) if rank_order else [F.desc(count_name)] + [F.asc(c) for c in inner[:1]]
        out = row_numbers(agg, outer, order, rank_name, stored, bounded, wanted, total)
    else:
        out = agg.withColumn(total_name, total[1].over(Window.partitionBy(*outer))).filter(wanted)
    return out.select(*outer, *inner, count_name, total_name, percent(count_name, total_name).alias(pct_name),
                      *([rank_name] if rank_name else []))


def unpivot_dimensions(df: DataFrame, ids: Sequence[str], dims: Sequence[str], dim_name: str, value_name: str,
                       constant: tuple[str, str] | None = None) -> DataFrame:
    """Several categorical columns -> (dimension, value) rows; one scan.
    ``constant=(name, value)`` adds a pseudo-dimension whose value is fixed
    (e.g. an overall analysis next to per-dimension ones)."""
    cols = [_c(i) for i in ids]
    names = []
    if constant:
        cols.append(F.lit(constant[1]).cast("string").alias(constant[0]))
        names.append(constant[0])
    cols += [_c(d).cast("string").alias(d) for d in dims]
    names += list(dims)
    return df.select(*cols).unpivot(list(ids), names, dim_name, value_name)


def profile_distribution(df: DataFrame, wave: str, id_col: str, dims: Sequence[str], *,
                         dim_name: str = "dimension", cat_name: str = "category", count_name: str = "count",
                         total_name: str = "total_valid", pct_name: str = "percent",
                         rank_name: str = "rank", unique_ids: bool = False,
                         stored: Stored | None = None) -> DataFrame:
    """Share of entities per category of each dimension; the base is the
    entities with a non-blank value in that dimension."""
    if not dims:
        raise ValueError("profile_distribution needs at least one dimension")
    long = unpivot_dimensions(df, [wave, id_col], dims, dim_name, cat_name).filter(not_blank(cat_name))
    return distinct_share(long, [wave, dim_name], [cat_name], id_col, count_name=count_name,
                          total_name=total_name, pct_name=pct_name, rank_name=rank_name, unique_ids=unique_ids,
                          stored=stored)


def band_distribution(df: DataFrame, wave: str, id_col: str, band_col: str, dims: Sequence[str],
                      spec: BandSpec, *, overall: tuple[str, str] | None = ("overall", "all"),
                      dim_name: str = "analysis_dimension", cat_name: str = "analysis_category",
                      band_name: str | None = None, order_name: str = "band_order",
                      anomaly_name: str = "band_anomaly", count_name: str = "count",
                      total_name: str = "total_valid", pct_name: str = "percent",
                      unique_ids: bool = False) -> DataFrame:
    """Band shares overall and within each category of each dimension; the
    base is the entities with a valid band (and category).  Adds the band
    order key and the anomaly flag; anomalous bands are kept."""
    band_name = band_name or band_col
    if not dims and not overall:
        raise ValueError("band_distribution needs dimensions or an overall analysis")
    valid = df.filter(not_blank(band_col))
    long = unpivot_dimensions(valid, [wave, id_col, band_col], dims, dim_name, cat_name, constant=overall)
    long = long.filter(not_blank(cat_name))
    out = distinct_share(long, [wave, dim_name, cat_name], [band_col], id_col, count_name=count_name,
                         total_name=total_name, pct_name=pct_name, unique_ids=unique_ids)
    return out.select(wave, dim_name, cat_name, F.col(band_col).alias(band_name),
                      band_order(band_col, spec).alias(order_name),
                      band_anomaly(band_col, spec).alias(anomaly_name),
                      count_name, total_name, pct_name)


def adoption_share(df: DataFrame, wave: str, id_col: str, category: str, item: str, extra: Sequence[str],
                   numerator: Column, *, count_name: str = "adopters", total_name: str = "category_base",
                   pct_name: str = "adoption_percent", rank_name: str = "rank",
                   unique_items: bool = False) -> DataFrame:
    """Adopters of each item over everyone who answered the category (any
    option, including 'none'-type ones that are not counted as adoption)."""
    return distinct_share(df, [wave, category], [item, *extra], id_col, count_name=count_name,
                          total_name=total_name, pct_name=pct_name, numerator=numerator,
                          rank_name=rank_name, rank_order=[F.desc(count_name), F.asc(item)],
                          unique_items=unique_items, bounded=True)  # the items are columns of the form


def answer_share(df: DataFrame, wave: str, id_col: str, dimension: str, answer: str, extra: Sequence[str], *,
                 single_choice: Column, count_name: str = "respondents", total_name: str = "dimension_base",
                 pct_name: str = "percent", rank_name: str = "rank",
                 sums_name: str = "percents_sum_to_100", unique_items: bool = False,
                 stored: Stored | None = None) -> DataFrame:
    """Answer shares per dimension; for multi-select dimensions percentages do
    not sum to 100, which ``sums_name`` states per row."""
    out = distinct_share(df, [wave, dimension], [answer, *extra], id_col, count_name=count_name,
                         total_name=total_name, pct_name=pct_name, rank_name=rank_name,
                         rank_order=[F.desc(count_name), F.asc(answer)], unique_items=unique_items, stored=stored)
    return out.withColumn(sums_name, F.coalesce(single_choice, F.lit(False)))


def share_of_sum(df: DataFrame, partition: Sequence[str], count_col: str, pct_name: str = "percent") -> DataFrame:
    """Percentage of each row's count in the sum of counts of its partition
    (equal to the distinct base only for single-answer data).  Without a
    partition the total is a scalar subquery, a sum with partial sums per
    task, so no task holds all rows."""
    if partition:
        return df.withColumn(pct_name, percent(count_col, F.sum(count_col).over(Window.partitionBy(*partition))))
    total = df.agg(F.sum(count_col))
    return df.select("*", percent(F.col(count_col), total.scalar()).alias(pct_name))


def top_k(df: DataFrame, partition: Sequence[str], order: Sequence[Column], k: int,
          rank_name: str | None = None) -> DataFrame:
    """Rows ranked 1..k per partition by ``row_number`` (planned as a
    WindowGroupLimit, so each task keeps only k rows per group before the
    shuffle)."""
    name = rank_name or "_rn"
    ranked = df.withColumn(name, F.row_number().over(Window.partitionBy(*partition).orderBy(*order)))
    out = ranked.filter(F.col(name) <= k)
    return out if rank_name else out.drop(name)
