"""Maintenance of stored micro-batches: merged by level, switched by a manifest.

A stream stores every micro-batch in a folder of its own, ``batch=N``. A
maintenance run merges neighbouring folders into segments: ``fanout`` batches
become a segment of level one, ``fanout`` of those one of level two, and so on.
A manifest names the segments that stand for all batches up to one; readers open
the segments of the newest manifest and the batches after it, a number that
grows with the logarithm of the batches.

The manifest is a new file each time, created exclusively: a reader sees the old
or the new one, and of two maintenance runs only one can switch. A batch that is
replayed after it was merged writes its folder again, which nobody reads.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable
from dataclasses import asdict, dataclass

from pyspark.sql import DataFrame, SparkSession

from ..session import remove

FANOUT = 8
MANIFEST, SEGMENTS = "_manifest", "_segments"


@dataclass(frozen=True)
class Segment:
    """The batches ``first`` to ``last``, merged in ``folder``; level 0 is a batch's own folder."""

    level: int
    first: int
    last: int
    folder: str


class Store:
    """Folders of one table of micro-batches."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")
        self._fs = self._at(self.path).getFileSystem(spark._jsc.hadoopConfiguration())

    def _at(self, path: str):
        return self.spark._jvm.org.apache.hadoop.fs.Path(path)

    def _names(self, folder: str) -> list[str]:
        at = self._at(folder)
        return [s.getPath().getName() for s in self._fs.listStatus(at)] if self._fs.exists(at) else []

    def batches(self) -> list[int]:
        """Numbers of the batch folders that were written whole."""
        found = [int(n.split("=")[1]) for n in self._names(self.path) if n.startswith("batch=")]
        return sorted(n for n in found if self._fs.exists(self._at(f"{self.path}/batch={n}/_SUCCESS")))

    def versions(self) -> list[int]:
        return sorted(int(n.split(".")[0]) for n in self._names(f"{self.path}/{MANIFEST}") if n.endswith(".json"))

    def segments(self, version: int) -> list[Segment] | None:
        """Segments of a manifest, oldest batches first; None while it is being written or when it has gone."""
        try:
            stream = self._fs.open(self._at(f"{self.path}/{MANIFEST}/{version:012d}.json"))
            text = self.spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
            stream.close()
            return [Segment(**s) for s in json.loads(text)["segments"]]
        except Exception as error:  # noqa: BLE001
            if isinstance(error, (json.JSONDecodeError, KeyError)) or "FileNotFound" in str(error):
                return None
            raise

    def current(self) -> tuple[int, list[Segment]]:
        """(version, segments) of the newest whole manifest; version 0 without any."""
        for version in reversed(self.versions()):
            found = self.segments(version)
            if found is not None:
                return version, found
        return 0, []

    def switch(self, version: int, segments: list[Segment]) -> None:
        """Make ``segments`` the newest manifest; fails if another run has written this version already."""
        text = json.dumps({"segments": [asdict(s) for s in segments]})
        stream = self._fs.create(self._at(f"{self.path}/{MANIFEST}/{version:012d}.json"), False)
        stream.write(bytearray(text.encode()))
        stream.close()

    def units(self, segments: list[Segment]) -> list[Segment]:
        """What stands for all batches: the segments, then each later batch by itself."""
        covered = segments[-1].last if segments else -1
        return segments + [Segment(0, n, n, f"batch={n}") for n in self.batches() if n > covered]

    def read(self, units: list[Segment]) -> DataFrame:
        return self.spark.read.parquet(*[f"{self.path}/{u.folder}" for u in units])

    def clean(self) -> None:
        """Remove what neither the newest manifest nor the one before it names; readers of the latter may still run."""
        versions = self.versions()[-2:]
        kept = [self.segments(v) or [] for v in versions]
        folders = {s.folder for segments in kept for s in segments}
        for name in self._names(f"{self.path}/{SEGMENTS}"):
            if f"{SEGMENTS}/{name}" not in folders:
                remove(self.spark, f"{self.path}/{SEGMENTS}/{name}")
        covered = kept[0][-1].last if len(versions) == 2 and kept[0] else -1
        for name in self._names(self.path):
            if name.startswith("batch=") and int(name.split("=")[1]) <= covered:
                remove(self.spark, f"{self.path}/{name}")
        for version in self.versions()[:-2]:
            remove(self.spark, f"{self.path}/{MANIFEST}/{version:012d}.json")


def read_partials(spark: SparkSession, path: str) -> DataFrame:
    """All stored rows: the newest manifest's segments and the batches after them."""
    store = Store(spark, path)
    return store.read(store.units(store.current()[1]))


def _due(units: list[Segment], fanout: int) -> tuple[int, int] | None:
    """First stretch of ``fanout`` neighbours of one level."""
    begin = 0
    for at in range(1, len(units) + 1):
        if at == len(units) or units[at].level != units[begin].level:
            begin = at
        elif at - begin + 1 == fanout:
            return begin, at + 1
    return None


def compact(
    spark: SparkSession, path: str, merge: Callable[[DataFrame], DataFrame], fanout: int = FANOUT, through: int | None = None
) -> int:
    """Merge stored batches level by level; returns the number of new segments.

    ``merge`` reduces rows to fewer of the same columns and must not change
    what the table says (a view's ``merged`` for partials, the rows themselves
    for samples). Batches up to ``through`` take part, by default all but the
    newest one, which its stream may still replay. New segments are written
    first, then one manifest switches to all of them, then what is no longer
    named goes.
    """
    store = Store(spark, path)
    version, segments = store.current()
    units = store.units(segments)
    batches = [u.last for u in units if not u.level]
    through = batches[-2] if through is None and len(batches) > 1 else -1 if through is None else through
    units = [u for u in units if u.level or u.last <= through]
    new = 0
    while due := _due(units, fanout):
        merged = units[due[0] : due[1]]
        level, first, last = merged[0].level + 1, merged[0].first, merged[-1].last
        segment = Segment(level, first, last, f"{SEGMENTS}/{level}-{first}-{last}-{uuid.uuid4().hex[:12]}")
        rows = store.read(merged)
        merge(rows).select(*rows.columns).write.parquet(f"{store.path}/{segment.folder}")
        units[due[0] : due[1]] = [segment]
        new += 1
    if new:
        # batches after the last segment stay by themselves
        end = max(n for n, u in enumerate(units) if u.level)
        store.switch(version + 1, units[: end + 1])
        store.clean()
    return new
