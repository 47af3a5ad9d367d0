"""Versions of several roots that are seen together.

A release names one version of each area. Areas are written one after the other, each as a
version of its own; readers that go by the newest release see none of them before the release
is committed, and all of them from then on. A release is itself a version without tables whose
marker files carry the numbers. One writer at a time.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import SparkSession

from perkmill.sources.snapshots import Snapshot, committed_version, markers

_AREA = "_AREA_"


def released(spark: SparkSession, root: str, release: int | None = None) -> dict[str, int]:
    """Version of every area in a release, by default the newest; nothing before the first."""
    release = committed_version(spark, root) if release is None else release
    if release is None:
        return {}
    named = (m.rsplit("=", 1) for m in markers(spark, root, release, _AREA))
    return {area: int(version) for area, version in named}


def publish(spark: SparkSession, root: str, versions: Mapping[str, int]) -> int:
    """A new release: ``versions`` for the areas it names, the newest release for all others."""
    current = released(spark, root)
    with Snapshot(spark, root) as release:
        for area, version in {**current, **versions}.items():
            release.mark(f"{_AREA}{area}={version}")
    return release.version
