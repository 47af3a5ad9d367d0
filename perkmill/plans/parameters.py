"""Revisions of effective-dated parameters, on the raw text relation."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame, functions as F

from perkmill import vocabulary as V
from perkmill.functions.text import clean_text
from perkmill.operators.quality import Audit, row_rule
from perkmill.operators.tables import assign_where, replace_by_source_file
from perkmill.schemas import RAW


def check_rate(rate: Decimal | str) -> Decimal:
    """A bonus rate must lie within its bounds."""
    value = Decimal(rate)
    low, high = map(Decimal, V.RATE_BOUNDS)
    if not low <= value <= high:
        raise ValueError(f"rate {value} is outside {low}..{high}")
    return value


def rate_bounds(relation: str = "config_benefit_parameters") -> Audit:
    """Versions of the bonus rate must lie within its bounds; other parameters pass."""
    low, high = map(Decimal, V.RATE_BOUNDS)
    is_rate = lambda: F.coalesce(F.col("parameter_name") == V.BONUS_RATE, F.lit(False))
    return row_rule("bonus_rate_within_bounds", relation, lambda: ~is_rate() | F.col("parameter_value").between(low, high))


def _text(value: Column | str) -> Column:
    return value if isinstance(value, Column) else F.lit(value)


def revise_parameter(
    stored: DataFrame, name: str, value: str, valid_from: Column | str, close_on: Column | str,
    source_file: str, comment: str = V.REVISED_RATE_COMMENT, closing_comment: str = V.CLOSED_RATE_COMMENT,
    only_version_from: str | None = None,
) -> DataFrame:
    """Close open versions of ``name`` and add the next version; repeatable.

    Rows of an earlier run with the same ``source_file`` are dropped first. All open
    versions are closed, or only the one that starts on ``only_version_from``.
    """
    is_open = (F.col("parameter_name") == name) & clean_text(F.col("valid_to")).isNull()
    if only_version_from is not None:
        is_open = is_open & (F.col("valid_from") == only_version_from)
    version = stored.sparkSession.range(1).select(
        F.lit(source_file).alias("source_file"), F.lit("1").alias("source_row_number"),
        F.lit(name).alias("parameter_name"), F.lit(value).alias("parameter_value"),
        _text(valid_from).alias("valid_from"), F.lit("").alias("valid_to"),
        F.lit(comment).alias("parameter_comment"),
    ).select(*RAW["benefit_parameters_txt"].names)
    # Closing before or after the replacement is the same: dropped rows are not seen again.
    closed = assign_where(
        stored, is_open, {"valid_to": _text(close_on), "parameter_comment": F.lit(closing_comment)}
    )
    return replace_by_source_file(closed, version, source_file)


def revise_rate_now(
    stored: DataFrame, rate: Decimal | str, source_file: str, now: Column | None = None,
) -> DataFrame:
    """Close every open bonus rate at ``now`` and start ``rate`` at the same moment.

    Old and new version both cover the day of the revision; the newer one wins. Using the
    same ``source_file`` again drops the earlier revision without reopening the version
    before it, so pass another one for each revision unless it is a repetition.
    """
    moment = F.current_timestamp() if now is None else now
    text = F.concat(F.date_format(moment, "yyyy-MM-dd HH:mm:ss.SSSSSS"), F.lit("+00"))
    return revise_parameter(
        stored, V.BONUS_RATE, str(check_rate(rate)), text, text, source_file
    )


def parameter_history(stored: DataFrame, name: str) -> DataFrame:
    """Versions of one parameter in order of their first day; blank ends shown as NULL."""
    return stored.filter(F.col("parameter_name") == name).select(
        F.col("parameter_value").alias(name), "valid_from",
        F.nullif(F.col("valid_to"), F.lit("")).alias("valid_to"), "parameter_comment",
    ).orderBy("valid_from")
