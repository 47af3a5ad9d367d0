"""Rows by key, stored as a base and a log of changed rows.

    root/base/v=.../rows     all rows up to some change, partitioned by state
    root/log/v=.../rows      the rows that one change added or altered, whole
    root/log/v=.../<other>   what belongs to that change: a ledger, refused rows

A change writes its own rows only, whatever the store holds, and is seen whole or not at all,
as each entry of the log is one committed version. Readers take the newest row of each key.
Reading some states opens only their partitions of the base, and the log. ``compact`` writes a
new base. One writer at a time.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from perkmill.operators.ranking import latest_by_key
from perkmill.sources.snapshots import Snapshot, committed_version, committed_versions, folder_bytes, markers, remove_table, table_path

ROWS, NUMBER = "rows", "change_number"
_UP_TO, _TAG = "_UP_TO_", "_TAG_"
# Keys of a log of at most this many stored bytes are sent to all tasks; beyond that Spark chooses.
BROADCAST_BYTES = 32 << 20


class ChangeStore:
    """A keyed table below ``root``; ``state`` is the column its base is partitioned by."""

    def __init__(self, spark: SparkSession, root: str, schema: T.StructType, key: str, state: str):
        self.spark, self.root = spark, root.rstrip("/")
        self.schema, self.key, self.state = schema, key, state

    # -- reading ----------------------------------------------------------------------

    def _base_version(self) -> int | None:
        return committed_version(self.spark, f"{self.root}/base")

    def exists(self) -> bool:
        return self._base_version() is not None

    def _compacted(self) -> int:
        """Number of the last change that the base holds."""
        base = self._base_version()
        if base is None:
            raise FileNotFoundError(f"no store at {self.root}")
        return int(markers(self.spark, f"{self.root}/base", base, _UP_TO)[0])

    def entries(self, newer_than: int = 0) -> list[int]:
        """Numbers of the committed changes, oldest first."""
        return [v for v in committed_versions(self.spark, f"{self.root}/log") if v > newer_than]

    def _entry_tables(self, name: str, numbers: Sequence[int]) -> list[str]:
        return [table_path(self.spark, f"{self.root}/log", name, n) for n in numbers]

    def base(self, *states: str) -> DataFrame:
        path = table_path(self.spark, f"{self.root}/base", ROWS, self._base_version())
        rows = self.spark.read.schema(self.schema).parquet(path).select(*self.schema.names)
        return rows.filter(F.col(self.state).isin(*states)) if states else rows

    def read(self, *states: str) -> DataFrame:
        """The current rows, or those in one of ``states``."""
        changes = self.entries(newer_than=self._compacted())
        if not changes:
            return self.base(*states)
        paths = self._entry_tables(ROWS, changes)
        log = self.spark.read.schema(self._logged).parquet(*paths)
        newest = latest_by_key(log, [self.key], [NUMBER]).drop(NUMBER)
        if states:
            newest = newest.filter(F.col(self.state).isin(*states))
        changed = log.select(self.key)
        if sum(folder_bytes(self.spark, p) for p in paths) <= BROADCAST_BYTES:
            changed = F.broadcast(changed)
        return self.base(*states).join(changed, self.key, "left_anti").select(*self.schema.names).unionByName(newest)

    def keys(self) -> DataFrame:
        """Every key, some of them repeated: nothing but the key column is read."""
        changes = self.entries(newer_than=self._compacted())
        stored = self.base().select(self.key)
        if not changes:
            return stored
        return stored.unionByName(self.spark.read.schema(self._logged).parquet(*self._entry_tables(ROWS, changes)).select(self.key))

    def logged(self, newer_than: int = 0) -> DataFrame:
        """All rows of the log, with the number of the change that wrote them."""
        return self.spark.read.schema(self._logged).parquet(*self._entry_tables(ROWS, self.entries(newer_than)))

    def companions(self, name: str, schema: T.StructType) -> DataFrame:
        """A table that changes were written with, over all changes that have one."""
        numbers = [n for n in self.entries() if folder_bytes(self.spark, f"{self.root}/log/v={n:08d}/{name}") > 0]
        if not numbers:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(*self._entry_tables(name, numbers))

    def has(self, tag: str) -> bool:
        """Whether the change with this tag is committed."""
        return any(tag in markers(self.spark, f"{self.root}/log", n, _TAG) for n in reversed(self.entries()))

    @property
    def _logged(self) -> T.StructType:
        return T.StructType([*self.schema.fields, T.StructField(NUMBER, T.LongType())])

    # -- writing ----------------------------------------------------------------------

    def create(self, rows: DataFrame | None = None) -> None:
        """A new store, empty or with a first base."""
        if self._base_version() is not None:
            raise FileExistsError(self.root)
        self._write_base(self.spark.createDataFrame([], self.schema) if rows is None else rows, 0)

    def _write_base(self, rows: DataFrame, up_to: int) -> None:
        with Snapshot(self.spark, f"{self.root}/base") as base:
            base.write(ROWS, rows.hint("rebalance", F.col(self.state)), partition_by=[self.state])
            base.mark(f"{_UP_TO}{up_to}")

    def change(self, tag: str | None = None) -> "Change":
        return Change(self, tag)

    def replace(self, rows: DataFrame) -> None:
        """``rows`` instead of all that is stored; the log goes on from here."""
        self._write_base(rows, max(self.entries(), default=0))

    def compact(self) -> None:
        """A new base from the current rows."""
        self.replace(self.read())

    def remove_superseded(self) -> None:
        """Delete bases and logged rows that the newest base replaces; companions stay.

        To be called when nobody reads an older state any more.
        """
        base, compacted = self._base_version(), self._compacted()
        for version in committed_versions(self.spark, f"{self.root}/base"):
            if version < base:
                remove_table(self.spark, f"{self.root}/base", ROWS, version)
        for number in self.entries():
            if number <= compacted:
                remove_table(self.spark, f"{self.root}/log", ROWS, number)


class Change(Snapshot):
    """An entry of the log being written; leaving the ``with`` block normally commits it."""

    def __init__(self, store: ChangeStore, tag: str | None):
        super().__init__(store.spark, f"{store.root}/log")
        self.store, self.tag = store, tag

    def __exit__(self, error, *rest) -> None:
        if error is None and self.tag is not None:
            self.mark(f"{_TAG}{self.tag}")
        super().__exit__(error, *rest)

    def rows(self, changed: DataFrame) -> DataFrame:
        """Write the changed rows, whole, and return them as stored."""
        numbered = changed.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in self.store.schema.fields],
                                  F.lit(self.version).cast("long").alias(NUMBER))
        return self.write(ROWS, numbered).drop(NUMBER)
