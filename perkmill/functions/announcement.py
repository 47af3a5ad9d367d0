"""Text of an activity announcement."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from perkmill import vocabulary as V
from perkmill.functions.text import collapse_whitespace


def distance_text(metres: Column) -> Column:
    """``12.35 km``. The format rounds the binary value, as C-style formatting does."""
    km = metres.cast("double") / F.lit(1000.0)
    return F.when(metres.isNull(), F.lit(V.NOT_GIVEN)).otherwise(
        F.concat(F.call_function("format_number", km, F.lit("0.00")), F.lit(" km"))
    )


def duration_text(seconds: Column) -> Column:
    """``1 h 05 min`` from one hour on, else ``5 min 07 s``."""
    hours = F.floor(seconds / 3600)
    minutes = F.floor(F.pmod(seconds, F.lit(3600)) / 60)
    rest = F.pmod(seconds, F.lit(60))
    return (
        F.when(seconds.isNull(), F.lit(V.NOT_GIVEN))
        .when(hours != 0, F.format_string("%d h %02d min", hours, minutes))
        .otherwise(F.format_string("%d min %02d s", minutes, rest))
    )


def moment_text(moment: Column) -> Column:
    """``21/06/2026 à 18:30 UTC``; expects a session in UTC."""
    return F.date_format(moment, "dd/MM/yyyy 'à' HH:mm 'UTC'")


def announcement_text(
    activity_id: Column, employee_id: Column, start: Column, sport: Column,
    metres: Column, seconds: Column, comment: Column,
) -> Column:
    """Seven lines, and one with the comment when there is one."""
    def line(label: str, value: Column) -> Column:
        return F.concat(F.lit(f"{label} : "), value)

    return F.concat_ws(
        "\n",
        F.lit(V.ANNOUNCEMENT_TITLE),
        line("Activité", sport),
        line("Salarié", employee_id.cast("string")),
        line("Début", moment_text(start)),
        line("Distance", distance_text(metres)),
        line("Durée", duration_text(seconds)),
        line("Identifiant activité", activity_id.cast("string")),
        F.when(comment != "", line("Commentaire", collapse_whitespace(comment))),
    )
