"""Silver -> the four indicator (gold) tables.

Entities come de-duplicated, so an id counts once per wave without a distinct
(``unique_ids``); selections and answers hold an id once per item
(``unique_items``)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import metrics
from .config import Questionnaire

def profile(q: Questionnaire, entities: DataFrame, stored: metrics.Stored | None = None) -> DataFrame:
    out = metrics.profile_distribution(entities, q.wave_name, q.id_name, q.profile_dims,
                                       unique_ids=True, stored=stored)
    return out.select(q.wave_name, "dimension", "category", "count", "total_valid", "percent", "rank")


def pay(q: Questionnaire, entities: DataFrame, dims=None, overall=True) -> DataFrame:
    return metrics.band_distribution(entities, q.wave_name, q.id_name, q.band_field,
                                     q.band_dims if dims is None else dims, q.band_spec,
                                     overall=q.band_overall if overall else None, unique_ids=True)


def technologies(q: Questionnaire, selections: DataFrame) -> DataFrame:
    out = metrics.adoption_share(selections, q.wave_name, q.id_name, "category", "item", ["comparability"],
                                 numerator=F.col("item_type") == q.item_class, unique_items=True)
    return out.select(q.wave_name, "category", "item", "adopters", "category_base", "adoption_percent",
                      "rank", "comparability")


def answers(q: Questionnaire, answers_df: DataFrame, stored: metrics.Stored | None = None) -> DataFrame:
    out = metrics.answer_share(answers_df, q.wave_name, q.id_name, "dimension", "answer",
                               ["answer_type", "comparability"],
                               single_choice=F.col("answer_type") == q.single_choice, unique_items=True,
                               stored=stored)
    return out.select(q.wave_name, "dimension", "answer", "respondents", "dimension_base", "percent", "rank",
                      "answer_type", "percents_sum_to_100", "comparability")
