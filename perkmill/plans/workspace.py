"""Raw relations, marts, audits and queue below one root, changed release by release.

    root/raw, root/marts, root/audit   versions of the layers
    root/queue/generation=...          queue stores; a reset begins the next one
    root/releases                      which of these are seen together

A step that writes several areas publishes them at once, at its end: if it fails before, every
reader goes on with the areas of the release before it.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession

from perkmill.operators.quality import Audit
from perkmill.plans import refresh as run
from perkmill.plans.audits import stored_failures
from perkmill.plans.load import load_sources, read_loaded, reset
from perkmill.plans.queue_store import QueueStore
from perkmill.schemas import RAW
from perkmill.sources.releases import publish, released
from perkmill.sources.snapshots import read_table, write_snapshot


class Workspace:
    """All layers below ``root``, read as of the newest release."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    def _released(self) -> dict[str, int]:
        return released(self.spark, f"{self.root}/releases")

    def _publish(self, versions: Mapping[str, int]) -> int:
        return publish(self.spark, f"{self.root}/releases", versions)

    # -- reading ----------------------------------------------------------------------

    def raw(self) -> dict[str, DataFrame]:
        """The five raw relations; one that was never stored has no rows."""
        versions = self._released()
        return {
            name: read_loaded(self.spark, f"{self.root}/raw", name, versions[f"raw.{name}"])
            if f"raw.{name}" in versions else self.spark.createDataFrame([], schema) for name, schema in RAW.items()}

    def table(self, name: str) -> DataFrame:
        """A mart."""
        return read_table(self.spark, f"{self.root}/marts", name, self._version("marts"))

    def failures(self, audit: Audit) -> DataFrame:
        """What an audit of the released run found."""
        relation = self.table(audit.relation) if audit.relation in run.MART_MODELS else run.stage(self.raw())[audit.relation]
        return stored_failures(self.spark, f"{self.root}/audit", audit, relation, self._version("audit"))

    def queue(self) -> QueueStore:
        return self._generation(self._version("queue"))

    def _version(self, area: str) -> int:
        version = self._released().get(area)
        if version is None:
            raise FileNotFoundError(f"{self.root} has no released {area}")
        return version

    def _generation(self, number: int) -> QueueStore:
        return QueueStore(self.spark, f"{self.root}/queue/generation={number:08d}")

    # -- steps ------------------------------------------------------------------------

    def load(self, paths: Mapping[str, str], format: str = "csv", multi_line: bool = False) -> int:
        """The contracted sources, loaded anew; other raw relations stay."""
        version = load_sources(self.spark, paths, f"{self.root}/raw", format, multi_line)
        return self._publish({f"raw.{name}": version for name in paths})

    def store_raw(self, relations: Mapping[str, DataFrame]) -> int:
        """New states of raw relations; the others stay."""
        rows = {name: df.select(*RAW[name].names) for name, df in relations.items()}
        version = write_snapshot(self.spark, f"{self.root}/raw", rows)
        return self._publish({f"raw.{name}": version for name in rows})

    def refresh(self) -> run.RefreshResult:
        """Marts and audits from the released raw relations, seen together."""
        result = run.refresh(self.spark, self.raw(), self.root)
        self._publish({"marts": result.version, "audit": result.audit_version})
        return result

    def reset(self) -> int:
        """Empty raw relations and an empty queue, seen together; marts stay as they are."""
        version = reset(self.spark, f"{self.root}/raw")
        return self._publish({**{f"raw.{name}": version for name in RAW}, "queue": self._new_queue()})

    def create_queue(self) -> QueueStore:
        """An empty queue, if none is released yet."""
        if "queue" not in self._released():
            self._publish({"queue": self._new_queue()})
        return self.queue()

    def _new_queue(self) -> int:
        """Number of a new, empty queue; one that a failed step left is passed over."""
        number = self._released().get("queue", 0) + 1
        while self._generation(number).exists():
            number += 1
        self._generation(number).create()
        return number
