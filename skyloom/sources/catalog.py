"""Searches of a catalog as a data source: the window is cut into slices of time, and each is read page by page in a task.

No list of records passes through the driver, so a backfill of years is only more slices, and a slice whose executor
is lost is searched again.
"""

from __future__ import annotations

import datetime as dt
import json
from collections.abc import Callable, Iterator
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, EqualTo, GreaterThan, GreaterThanOrEqual, InputPartition, LessThan, LessThanOrEqual

from skyloom.sources.discovery import RECORD, normalise, window

Search = Callable[[str, str, str, int], list[dict]]  # concept, start and end of a window, page from 1 -> records; none after the last page
ISO = "%Y-%m-%dT%H:%M:%SZ"
TICK = dt.timedelta(microseconds=1)


@dataclass
class Slice(InputPartition):
    start: dt.datetime
    end: dt.datetime


class CatalogReader(DataSourceReader):
    def __init__(self, search: Search, options):
        self._search, self._concept = search, options["concept_id"]
        self._start, self._end = (dt.datetime.strptime(options[k], ISO) for k in ("start", "end"))
        self._step = dt.timedelta(hours=float(options.get("slice_hours", 6)))
        if self._end <= self._start or self._step <= dt.timedelta(0):
            raise ValueError("a window must end after its start, and slices need a length")
        self._low, self._high = dt.datetime.min, dt.datetime.max

    def partitions(self) -> list[Slice]:
        count = -((self._start - self._end) // self._step)
        starts = [self._start + k * self._step for k in range(count)]
        return [Slice(s, min(s + self._step, self._end)) for s in starts if self._low <= s <= self._high]

    def read(self, part: Slice | None) -> Iterator[tuple]:
        if part is None:  # no slice is left
            return
        page, last = 1, None
        while True:
            found = self._search(self._concept, part.start.strftime(ISO), part.end.strftime(ISO), page)
            if not found:
                return
            lines = [json.dumps(r, default=str, sort_keys=True) for r in found]
            if lines == last:
                raise ValueError(f"the search gives page {page - 1} again as page {page}")
            for line in lines:
                yield line, part.start, part.end
            page, last = page + 1, lines


class PruningCatalogReader(CatalogReader):
    def pushFilters(self, filters):
        """Bounds of slice_start choose the slices that are searched; Spark still tests their rows."""
        for f in filters:
            if getattr(f, "attribute", None) == ("slice_start",):
                value = f.value.replace(tzinfo=None) if isinstance(getattr(f, "value", None), dt.datetime) else None
                if value is not None and isinstance(f, (EqualTo, GreaterThan, GreaterThanOrEqual)):
                    self._low = max(self._low, value + isinstance(f, GreaterThan) * TICK)
                if value is not None and isinstance(f, (EqualTo, LessThan, LessThanOrEqual)):
                    self._high = min(self._high, value - isinstance(f, LessThan) * TICK)
            yield f


def catalog_source(search: Search) -> type[DataSource]:
    """The data source ``catalog`` of a search, for ``spark.dataSource.register``.

    Options: concept_id, start, end (as ``window`` gives them), slice_hours (6), prune (by filters on slice_start; needs
    ``spark.sql.python.filterPushdown.enabled``).  The search runs in tasks, so it must be possible to pickle it.
    """

    class Catalog(DataSource):
        @classmethod
        def name(cls) -> str:
            return "catalog"

        def schema(self) -> str:
            return "value string, slice_start timestamp_ntz, slice_end timestamp_ntz"

        def reader(self, schema) -> CatalogReader:
            prune = str(self.options.get("prune", "false")).lower() == "true"
            return (PruningCatalogReader if prune else CatalogReader)(search, self.options)

    return Catalog


def discover_paged(spark: SparkSession, search: Search, concept_id: str, slice_hours: float = 6, **bounds) -> DataFrame:
    """Granules of a window, see ``normalise``: one row a granule, that of its newest revision.

    A granule that lies in two slices, or moves to another page while pages are read, is there once.
    """
    start, end = window(**bounds)
    spark.dataSource.register(catalog_source(search))
    rows = spark.read.format("catalog").option("concept_id", concept_id).option("start", start).option("end", end).option("slice_hours", slice_hours).load()
    found = normalise(rows.select(F.from_json("value", RECORD).alias("r")).select("r.*"), concept_id)
    facts = ["cmr_revision_at", "acquisition_start", "acquisition_end", "download_url"]
    newest = found.groupBy("granule_id", "concept_id").agg(F.max(F.struct(*facts)).alias("_r"))
    return newest.select("granule_id", "concept_id", *[f"_r.{c}" for c in facts]).select(*found.columns)
