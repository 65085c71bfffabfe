"""Segments of an incremental cube: a published ledger of day segments and of the spans they were merged into.

Each refresh aggregates only the days it is asked for and writes them to a new folder; each merge folds complete windows
of 7 days, then of 28, into one segment. Both end by publishing the list of segments that count from now on, so readers
see one state throughout, and a job that fails changes nothing. A day inside a merged span is rebuilt by dissolving the span:
all its days come from the fact again, since an aggregate cannot give a day back.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import astuple, dataclass
from datetime import date, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sonomart.plans import cube as cb
from sonomart.sources import versions

# Days of the merge windows, aligned to the epoch; each is a multiple of the one before.
TIERS = (7, 28)
SCHEMA = "first int, last int, days int, folder string"
_EPOCH = date(1970, 1, 1)


@dataclass(frozen=True)
class Segment:
    """Days from ``first`` to ``last`` as yyyyMMdd; plays without a date form the segment -1."""

    first: int
    last: int
    days: int
    folder: str


def _day(key: int) -> date:
    return date(key // 10000, key // 100 % 100, key % 100)


def _key(day: date) -> int:
    return day.year * 10000 + day.month * 100 + day.day


def _window(key: int, days: int) -> tuple[int, int]:
    """First and last day of the window that holds the day."""
    first = _day(key) - timedelta((_day(key) - _EPOCH).days % days)
    return _key(first), _key(first + timedelta(days - 1))


def _keys(first: int, last: int) -> list[int]:
    return [_key(_day(first) + timedelta(i)) for i in range((_day(last) - _day(first)).days + 1)] if first > 0 else [first]


def due(segments: Sequence[Segment], days: int) -> dict[int, list[Segment]]:
    """Segments to merge by the first day of their window: windows that ended, and that shorter segments make up."""
    dated = [s for s in segments if s.first > 0]
    latest = max((s.last for s in dated), default=0)
    windows: dict[int, list[Segment]] = {}
    for s in dated:
        first, last = _window(s.first, days)
        if s.days < days and last <= latest:
            windows.setdefault(first, []).append(s)
    return windows


class SegmentLedger:
    """Segments of one group of dimensions below ``path``."""

    def __init__(self, spark: SparkSession, path: str, names: Sequence[str], model_filter: str | None = None, bitmap: bool | None = None):
        self.spark, self.path, self.names = spark, path, list(names)
        self.model_filter, self.bitmap = model_filter, bitmap

    def version(self) -> int:
        return max(versions.published(self.spark, self.path), default=0)

    def segments(self, version: int | None = None) -> list[Segment]:
        """The list of a version: at most a row per day of the calendar."""
        rows = versions.read(self.spark, self.path, SCHEMA, version).orderBy("first").collect()
        return [Segment(*r) for r in rows]

    def _publish(self, segments: Sequence[Segment], after: int) -> int:
        rows = self.spark.createDataFrame([astuple(s) for s in segments], SCHEMA).coalesce(1)
        return versions.publish(self.spark, self.path, rows, after)

    def _scan(self, segments: Sequence[Segment]) -> DataFrame:
        return self.spark.read.option("basePath", f"{self.path}/data").parquet(*[s.folder for s in segments]).drop("batch")

    def _write(self, rows: DataFrame, days: int) -> list[Segment]:
        """Rows by ``segmento`` as new segments of so many days; segments without rows do not come up."""
        folder = versions.data_folder(self.path)
        # Rebalanced: few files per segment, and one that is too large for one task is split.
        rows.hint("rebalance", "segmento").write.partitionBy("segmento").parquet(folder)
        firsts = [int(n.split("=")[1]) for n in versions.names(self.spark, folder) if n.startswith("segmento=")]
        return [Segment(first, _window(first, days)[1] if days > 1 else first, days, f"{folder}/segmento={first}") for first in firsts]

    def refresh(self, fact: DataFrame, dims: Mapping[str, DataFrame], days: Sequence[int] | None = None) -> int:
        """Aggregate the days (all by default) from the fact again; days without plays lose their segment."""
        before = self.version()
        held = self.segments(before)
        if days is not None:
            wanted = set(days)
            touched = [s for s in held if wanted.intersection(_keys(s.first, s.last))]
            wanted.update(k for s in touched for k in _keys(s.first, s.last))
            fact = fact.filter(F.col("IDDate").isin(*sorted(wanted)))
            held = [s for s in held if s not in touched]
        else:
            held = []
        base = cb.group_base(fact, dims, self.names, self.bitmap, self.model_filter, segment="IDDate")
        return self._publish([*held, *self._write(base.withColumnRenamed("IDDate", "segmento"), 1)], before)

    def merge(self, tiers: Sequence[int] = TIERS) -> int:
        """Fold all windows that are due, small ones first; returns the version in force."""
        before = self.version()
        held = self.segments(before)
        changed = False
        for days in tiers:
            windows = due(held, days)
            if windows:
                old = [s for some in windows.values() for s in some]
                new = self._write(cb.compact_segments(self._scan(old), days), days)
                held = [s for s in held if s not in old] + new
                changed = True
        return self._publish(held, before) if changed else before

    def read(self, version: int | None = None, first: int | None = None, last: int | None = None) -> DataFrame:
        """The base of a version by ``segmento``; segments wholly outside the days asked for are not read."""
        found = [s for s in self.segments(version)
                 if (first is None or s.last >= first) and (last is None or s.first <= last)]
        if not found:
            raise LookupError("no segment in this range")
        return self._scan(found)

    def vacuum(self, keep: int = 1) -> list[str]:
        """Delete data that the last versions do not name; no reader may be on an older one."""
        return versions.vacuum(self.spark, self.path, SCHEMA, keep)
