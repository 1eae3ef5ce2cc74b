"""League labels for the team dimension.

Two forms with the same semantics (unmatched or NULL id -> 'Unknown'):
* ``league_case``: a CASE expression from a small fixed mapping (constant-folded, no join);
* a labels table given to ``with_league_labels``: a left join, for catalogs too large for a CASE.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from snapmart.schemas import LEAGUE_LABELS, UNKNOWN_LABEL


def league_case(league_id: Column | str, mapping: Mapping[int, tuple[str, str]] = LEAGUE_LABELS,
                field: int = 0) -> Column:
    """CASE WHEN id = k THEN label ... ELSE 'Unknown' END; field 0 = league name, 1 = country."""
    col = F.col(league_id) if isinstance(league_id, str) else league_id
    expr = None
    for k, labels in mapping.items():
        cond = col == F.lit(k)
        expr = F.when(cond, F.lit(labels[field])) if expr is None else expr.when(cond, F.lit(labels[field]))
    return F.lit(UNKNOWN_LABEL) if expr is None else expr.otherwise(F.lit(UNKNOWN_LABEL))


def with_league_labels(df: DataFrame, labels: Mapping[int, tuple[str, str]] | DataFrame = LEAGUE_LABELS,
                       league_col: str = "league_id") -> DataFrame:
    """Append league_name and country to ``df``.

    ``labels`` is either a mapping (CASE) or a DataFrame (league_id, league_name, country). The join
    form is a left join; a league_id that the labels hold twice fails the job instead of multiplying
    rows. AQE broadcasts the labels side only when its measured size is under the broadcast threshold.
    """
    if isinstance(labels, DataFrame):
        twice = F.raise_error(F.concat(F.lit("labels hold this league_id twice: "), F.col("league_id").cast("string")))
        lab = labels.where(F.col("league_id").isNotNull()).groupBy("league_id").agg(
            F.count("*").alias("n"), F.first("league_name").alias("_lab_name"), F.first("country").alias("_lab_country"))
        lab = lab.select(F.when(F.col("n") == 1, F.col("league_id")).otherwise(twice.cast(
            labels.schema["league_id"].dataType)).alias("_lab_id"), "_lab_name", "_lab_country")
        out = df.join(lab, df[league_col] == lab["_lab_id"], "left")
        return (out.withColumn("league_name", F.coalesce("_lab_name", F.lit(UNKNOWN_LABEL)))
                   .withColumn("country", F.coalesce("_lab_country", F.lit(UNKNOWN_LABEL)))
                   .drop("_lab_id", "_lab_name", "_lab_country"))
    return (df.withColumn("league_name", league_case(league_col, labels, 0))
              .withColumn("country", league_case(league_col, labels, 1)))
