"""Raw, typed and queue schemas, and the header contracts of the source files."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

from perkmill.vocabulary import PENDING

# Numbers without a bound of their own: all 38 digits, with the decimals the column needs.
AMOUNT = T.DecimalType(38, 10)  # salaries and distances
RATE = T.DecimalType(38, 14)  # values of parameters
MONEY = T.DecimalType(38, 2)
WHOLE = T.DecimalType(20, 0)  # any count
KILOMETRES = T.DecimalType(18, 6)  # whole metres by 1000, exact
LINEAGE = ("source_file", "source_row_number")


def text_schema(*names: str) -> T.StructType:
    """Every column text; only the lineage columns are required."""
    return T.StructType([T.StructField(n, T.StringType(), n not in LINEAGE) for n in names])


@dataclass(frozen=True)
class SourceSpec:
    """Header a source file must carry, and the raw column each header becomes."""

    relation: str
    source_columns: tuple[str, ...]
    target_columns: tuple[str, ...]

    def __post_init__(self) -> None:
        if len(self.source_columns) != len(self.target_columns):
            raise ValueError(f"{self.relation}: every source column needs one target column")

    @property
    def raw_schema(self) -> T.StructType:
        return text_schema(*LINEAGE, *self.target_columns)


# Header contracts (source header, raw column), in file order.
HR_SOURCE = SourceSpec(
    relation="hr_employees_txt",
    source_columns=(
        "ID salarié", "Nom", "Prénom", "Date de naissance", "BU", "Date d'embauche",
        "Salaire brut", "Type de contrat", "Nombre de jours de CP",
        "Adresse du domicile", "Moyen de déplacement",
    ),
    target_columns=(
        "employee_id", "last_name", "first_name", "birth_date", "business_unit", "hire_date",
        "gross_salary", "contract_type", "paid_leave_days", "home_address", "commute_mode",
    ),
)
PROFILE_SOURCE = SourceSpec(
    relation="employee_sport_profile_txt",
    source_columns=("ID salarié", "Pratique d'un sport"),
    target_columns=("employee_id", "declared_sport"),
)
SOURCES = (HR_SOURCE, PROFILE_SOURCE)

# Columns of the raw relations. All are text, typed only by the staging plans.
RAW = {
    HR_SOURCE.relation: HR_SOURCE.raw_schema,
    PROFILE_SOURCE.relation: PROFILE_SOURCE.raw_schema,
    "sport_activities_txt": text_schema(
        *LINEAGE, "activity_id", "employee_id", "activity_start_datetime", "sport_type",
        "distance_meters", "activity_end_datetime", "elapsed_seconds", "activity_comment",
        "source_system",
    ),
    "google_routes_responses_txt": text_schema(
        *LINEAGE, "request_key", "employee_id", "home_address", "office_address",
        "declared_commute_mode", "google_travel_mode", "request_payload_json",
        "response_http_status", "response_payload_json", "requested_at",
    ),
    "benefit_parameters_txt": text_schema(
        *LINEAGE, "parameter_name", "parameter_value", "valid_from", "valid_to",
        "parameter_comment",
    ),
}

# Columns of the publication queue.
QUEUE = T.StructType([
    T.StructField("activity_id", T.LongType(), False),
    T.StructField("employee_id", T.IntegerType(), False),
    T.StructField("activity_start_datetime", T.TimestampType(), False),
    T.StructField("sport_type", T.StringType(), False),
    T.StructField("distance_meters", AMOUNT),
    T.StructField("elapsed_seconds", T.IntegerType()),
    T.StructField("activity_comment", T.StringType()),
    T.StructField("source_system", T.StringType()),
    T.StructField("publication_status", T.StringType(), False),
    T.StructField("attempt_count", T.IntegerType(), False),
    T.StructField("claimed_at", T.TimestampType()),
    T.StructField("published_at", T.TimestampType()),
    T.StructField("slack_channel_id", T.StringType()),
    T.StructField("slack_message_ts", T.StringType()),
    T.StructField("slack_permalink", T.StringType()),
    T.StructField("last_error", T.StringType()),
    T.StructField("created_at", T.TimestampType(), False),
    T.StructField("updated_at", T.TimestampType(), False),
])
QUEUE_FACT_COLUMNS = tuple(f.name for f in QUEUE.fields[:8])
QUEUE_REQUIRED = tuple(f.name for f in QUEUE.fields if not f.nullable)
QUEUE_DEFAULTS = {"publication_status": PENDING, "attempt_count": 0}
