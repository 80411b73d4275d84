"""Captured pages as a Spark data source, in batches and as a stream: ``spark.read.format("captured_pages").load(folder)``.

A capture is a folder with a folder per partition, in which page files are named by their number. The reader plans a task for every
``pagesPerTask`` pages of a folder. The stream's offset says which pages each partition has had, as ranges of their numbers, so a run
goes on where it stopped and a page that arrives after higher ones is still read.
"""

from __future__ import annotations

import os
import re
from bisect import bisect_right
from collections.abc import Iterator, Sequence

from pyspark.sql import SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition, SimpleDataSourceStreamReader

SCHEMA = "partition_id string, page int, body string"


def _files(folder: str, partition: str) -> list[tuple[int, str]]:
    at = os.path.join(folder, partition)
    found = [(int(m[1]), os.path.join(at, f)) for f in os.listdir(at) if (m := re.fullmatch(r"\D*(\d+)\.(?:html?|xml)", f))]
    return sorted(found)


def _partitions(folder: str, wanted: Sequence[str] | None) -> list[str]:
    have = sorted(d for d in os.listdir(folder) if os.path.isdir(os.path.join(folder, d)))
    return [d for d in have if wanted is None or d in wanted]


def _read(folder: str, partition: str, least: int = 0, most: int | None = None) -> Iterator[tuple[str, int, str]]:
    for page, path in _files(folder, partition):
        if page > least and (most is None or page <= most):
            with open(path, encoding="utf-8") as f:
                yield partition, page, f.read()


class _Pages(InputPartition):
    def __init__(self, folder: str, first: int, last: int):
        self.folder, self.first, self.last = folder, first, last


class _Reader(DataSourceReader):
    def __init__(self, options: dict[str, str]):
        self.path, self.wanted = options["path"], options["partitions"].split(",") if options.get("partitions") else None
        self.least, self.each = int(options.get("afterpage", 0)), int(options.get("pagespertask", 1000))
        self.most = self.least + int(options["maxpages"]) if options.get("maxpages") else None

    def partitions(self) -> list[_Pages]:
        out = []
        for p in _partitions(self.path, self.wanted):
            pages = [n for n, _ in _files(self.path, p) if n > self.least and (self.most is None or n <= self.most)]
            out += [_Pages(p, pages[k], pages[min(k + self.each, len(pages)) - 1]) for k in range(0, len(pages), self.each)]
        return out

    def read(self, partition: _Pages) -> Iterator[tuple[str, int, str]]:
        yield from _read(self.path, partition.folder, partition.first - 1, partition.last)


Ranges = list[list[int]]


def _within(ranges: Ranges, n: int) -> bool:
    at = bisect_right(ranges, n, key=lambda r: r[0]) - 1
    return at >= 0 and n <= ranges[at][1]


def _with(ranges: Ranges, pages: Sequence[int]) -> Ranges:
    """Ranges of page numbers with some more pages; there is one range more than there are gaps."""
    out: Ranges = []
    for lo, hi in sorted([*ranges, *([n, n] for n in pages)]):
        if out and lo <= out[-1][1] + 1:
            out[-1][1] = max(out[-1][1], hi)
        else:
            out.append([lo, hi])
    return out


class _Stream(SimpleDataSourceStreamReader):
    """One trigger reads at most ``pagesPerTrigger`` new pages of each partition."""

    def __init__(self, options: dict[str, str]):
        self.folder, self.each = options["path"], int(options.get("pagespertrigger", 10))

    def initialOffset(self) -> dict[str, Ranges]:  # noqa: N802
        return {}

    def read(self, start: dict[str, Ranges]) -> tuple[Iterator[tuple[str, int, str]], dict[str, Ranges]]:
        end = dict(start)
        for p in _partitions(self.folder, None):
            had = start.get(p, [])
            new = [n for n, _ in _files(self.folder, p) if not _within(had, n)][: self.each]
            if new:
                end[p] = _with(had, new)
        return self.readBetweenOffsets(start, end), end

    def readBetweenOffsets(self, start: dict[str, Ranges], end: dict[str, Ranges]) -> Iterator[tuple[str, int, str]]:  # noqa: N802
        rows = []
        for p, ranges in end.items():
            had = start.get(p, [])
            for page, path in _files(self.folder, p) if ranges != had else ():
                if _within(ranges, page) and not _within(had, page):
                    with open(path, encoding="utf-8") as f:
                        rows.append((p, page, f.read()))
        return iter(rows)

    def commit(self, end: dict[str, Ranges]) -> None:
        pass


class CapturedPages(DataSource):
    """Options: path, partitions (names, comma between), afterPage, maxPages, pagesPerTask, pagesPerTrigger."""

    @classmethod
    def name(cls) -> str:
        return "captured_pages"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema: object) -> DataSourceReader:
        return _Reader({k.lower(): v for k, v in self.options.items()})

    def simpleStreamReader(self, schema: object) -> SimpleDataSourceStreamReader:  # noqa: N802
        return _Stream({k.lower(): v for k, v in self.options.items()})


def register(spark: SparkSession) -> None:
    spark.dataSource.register(CapturedPages)
