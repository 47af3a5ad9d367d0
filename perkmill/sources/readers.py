"""Contracted text reads and the raw relations."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from perkmill import vocabulary as V
from perkmill.operators.ranking import earliest_by_key
from perkmill.operators.joins import missing_of_batch
from perkmill.schemas import LINEAGE, RAW, SourceSpec
from perkmill.sources.lineage import FIRST_ROW, PLACE, has_block, number_rows, with_block_position


class HeaderMismatch(ValueError):
    """The columns found are not the contracted ones in the contracted order."""


def check_header(found: Sequence[str], spec: SourceSpec) -> None:
    if tuple(found) != spec.source_columns:
        raise HeaderMismatch(
            f"{spec.relation}: expected columns {list(spec.source_columns)}, found {list(found)}"
        )


def _csv(spark: SparkSession, multi_line: bool):
    return (
        spark.read.option("header", True).option("mode", "FAILFAST").option("multiLine", multi_line)
        .option("quote", '"').option("escape", '"')
    )


def scan_contracted(
    spark: SparkSession, spec: SourceSpec, path: str, format: str = "csv", multi_line: bool = False,
) -> DataFrame:
    """Read a source as text with the raw column names and the file of every row.

    Parquet rows have their number; CSV rows have their block and position instead, from which
    the number follows once the rows are stored. The header is compared eagerly; every further
    CSV file of a folder is compared by Spark while it is read. A missing path raises. Set
    ``multi_line`` if quoted CSV values contain line breaks: a file is then read by one task.
    NULL becomes empty text.
    """
    if format == "parquet":
        data = spark.read.parquet(path)
        check_header(data.columns, spec)
        lineage = list(LINEAGE)
        data = data.select("*", F.col("_metadata.file_name").alias("source_file"),
                           (F.col("_metadata.row_index") + FIRST_ROW).cast("string").alias("source_row_number"))
    elif format == "csv":
        check_header(_csv(spark, multi_line).load(path, format="csv", inferSchema=False).columns, spec)
        header = T.StructType([T.StructField(c, T.StringType()) for c in spec.source_columns])
        data = _csv(spark, multi_line).schema(header).option("enforceSchema", False).csv(path)
        lineage = ["source_file", *PLACE.names]
        data = with_block_position(data)
    else:
        raise ValueError(f"unknown format: {format}")
    renamed = [F.coalesce(F.col(f"`{s}`").cast("string"), F.lit("")).alias(t)
               for s, t in zip(spec.source_columns, spec.target_columns)]
    return data.select(*lineage, *renamed)


def read_contracted(
    spark: SparkSession, spec: SourceSpec, path: str, format: str = "csv", multi_line: bool = False,
) -> DataFrame:
    """A source as its raw relation, without storing it as a table: text only, lineage columns first.

    As ``scan_contracted``; CSV rows are checkpointed to be numbered.
    """
    data = scan_contracted(spark, spec, path, format, multi_line)
    if has_block(data):
        data = number_rows(data)
    return data.select(*LINEAGE, *spec.target_columns)


def read_raw(spark: SparkSession, relation: str, path: str, format: str = "parquet") -> DataFrame:
    """A stored raw relation with its fixed schema."""
    reader = spark.read.schema(RAW[relation])
    if format == "csv":
        return reader.option("header", True).option("enforceSchema", False).csv(path)
    return reader.format(format).load(path)


def initial_parameters(spark: SparkSession, source_file: str = "initial_parameters") -> DataFrame:
    """The initial parameter versions as raw rows."""
    rows = [
        (source_file, str(i), name, value, day, "", comment)
        for i, (name, value, day, comment) in enumerate(V.INITIAL_PARAMETERS, start=1)
    ]
    return spark.createDataFrame(rows, RAW["benefit_parameters_txt"])


def append_responses(stored: DataFrame, arrived: DataFrame) -> DataFrame:
    """Stored responses plus the arrived ones whose key is new.

    Of several arrivals with one key the earliest request is kept. Rows without a key
    are always appended. Columns that the stored responses lack are left out.
    """
    keyed = arrived.filter(F.col("request_key").isNotNull())
    order = ["requested_at", "source_row_number", "employee_id", "response_payload_json"]
    fresh = earliest_by_key(missing_of_batch(keyed, stored, "request_key"), ["request_key"], order)
    return (
        stored.unionByName(fresh.select(*stored.columns))
        .unionByName(arrived.filter(F.col("request_key").isNull()).select(*stored.columns))
    )


def blank_relations(spark: SparkSession) -> Mapping[str, DataFrame]:
    """Every raw relation without rows: the state after a full reset."""
    return {name: spark.createDataFrame([], schema) for name, schema in RAW.items()}
