"""Saved pages as a Spark data source: ``page-<number>.html`` files by source, read in batch or as a stream of page numbers, and written.

    register_saved_pages(spark)
    spark.read.format("saved_pages").option("path", folder).option("last_page", 50).load()
    spark.readStream.format("saved_pages").option("path", folder).load()
    pages.write.format("saved_pages").option("path", folder).mode("append").save()

Options: ``path``; ``platforms`` (names by comma; default: all folders under the path); ``first_page`` (1) and ``last_page`` (no limit);
``stop_at_empty`` (true): a source's pages end before its first empty file, as a crawl ends at its first empty page;
``pages_per_task`` (64).

Numbers may have gaps. A batch read takes what is there; conditions on ``page_no`` and ``platform`` choose files before any is
opened. A stream's offset is the highest page number of every source: a page counts as new if its number is higher, so pages are to
be saved in order, and a page that is replaced later is not read again. A batch takes all pages that are new. Files are opened by the tasks: ``path`` is a folder that all
executors see, or an address that Arrow's file systems know. Rows have the columns of ``RAW_PAGE_DDL``; ``fetched_at`` is the file's
time in UTC, ``page_id`` a number made of source and page number. Bytes that are no UTF-8 become replacement characters. Written
rows need platform, page_no and html; a page written twice is replaced whole, a task that is repeated writes the same files.
"""

from __future__ import annotations

import datetime as dt
import json
import os
import re
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

from pyspark.sql import SparkSession
from pyspark.sql import datasource as source

from vacancylake.schemas import RAW_PAGE_DDL
from vacancylake.session import ship_package

NAME = "saved_pages"
_FILE = re.compile(r"page-(\d{1,9})\.html")


class _Folder:
    """Listing, reading and writing below a path, by Arrow's file systems."""

    def __init__(self, path: str):
        from pyarrow import fs

        if "://" in path or path.startswith("file:"):
            self.store, self.path = fs.FileSystem.from_uri(path)
        else:
            self.store, self.path = fs.LocalFileSystem(), os.path.abspath(path)

    def platforms(self) -> list[str]:
        from pyarrow import fs

        found = self.store.get_file_info(fs.FileSelector(self.path, allow_not_found=True))
        return sorted(f.base_name for f in found if f.type == fs.FileType.Directory and not f.base_name.startswith(("_", ".")))

    def pages(self, platform: str) -> list[tuple[int, int, float]]:
        """(page number, bytes, time) of every saved page, in order."""
        from pyarrow import fs

        found = self.store.get_file_info(fs.FileSelector(f"{self.path}/{platform}", allow_not_found=True))
        named = [(m, f) for f in found if f.type == fs.FileType.File and (m := _FILE.fullmatch(f.base_name))]
        return sorted((int(m[1]), f.size, f.mtime.timestamp() if f.mtime else 0.0) for m, f in named)

    def file(self, platform: str, page: int) -> str:
        return f"{self.path}/{platform}/page-{page}.html"


@dataclass
class _Task(source.InputPartition):
    platform: str
    pages: list[tuple[int, float]]


def page_key(platform: str, page: int) -> int:
    return zlib.crc32(platform.encode()) << 31 | page


class _Pages:
    """What the options ask for."""

    def __init__(self, options: dict[str, str]):
        if not options.get("path"):
            raise ValueError("saved_pages needs a path")
        self.path = options["path"]
        self.names = [p.strip() for p in options.get("platforms", "").split(",") if p.strip()]
        self.first, self.last = int(options.get("first_page", 1)), int(options["last_page"]) if options.get("last_page") else None
        self.stop_at_empty = options.get("stop_at_empty", "true").lower() == "true"
        self.per_task = max(1, int(options.get("pages_per_task", 64)))

    def found(self) -> dict[str, list[tuple[int, float]]]:
        """Page numbers with file times by source, within the limits."""
        folder, out = _Folder(self.path), {}
        for platform in self.names or folder.platforms():
            pages = []
            for number, size, time in folder.pages(platform):
                if number < self.first:
                    continue
                if (self.last is not None and number > self.last) or (self.stop_at_empty and size == 0):
                    break
                pages.append((number, time))
            out[platform] = pages
        return out

    def tasks(self, chosen: dict[str, list[tuple[int, float]]]) -> list[_Task]:
        tasks = [_Task(p, pages[k : k + self.per_task]) for p, pages in sorted(chosen.items()) for k in range(0, len(pages), self.per_task)]
        return tasks or [_Task("", [])]  # a read has one task at least

    def rows(self, task: _Task) -> Iterator[tuple]:
        folder = _Folder(self.path)
        for number, time in task.pages:
            name = folder.file(task.platform, number)
            with folder.store.open_input_stream(name) as file:
                html = file.read().decode("utf-8", errors="replace")
            fetched = dt.datetime.fromtimestamp(time, dt.UTC).replace(tzinfo=None)
            yield page_key(task.platform, number), task.platform, name, number, fetched, 200, html


class _Reader(source.DataSourceReader):
    def __init__(self, pages: _Pages):
        self.pages = pages
        self.low, self.high, self.only, self.platforms = None, None, None, None

    def pushFilters(self, filters: list[source.Filter]) -> Iterator[source.Filter]:
        """Page numbers and sources are looked at before a file is opened; all else is left to Spark."""
        for f in filters:
            column = getattr(f, "attribute", None)
            value = getattr(f, "value", None)
            if column == ("page_no",) and isinstance(f, source.GreaterThanOrEqual | source.GreaterThan):
                least = value + isinstance(f, source.GreaterThan)
                self.low = least if self.low is None else max(self.low, least)
            elif column == ("page_no",) and isinstance(f, source.LessThanOrEqual | source.LessThan):
                most = value - isinstance(f, source.LessThan)
                self.high = most if self.high is None else min(self.high, most)
            elif column == ("page_no",) and isinstance(f, source.EqualTo | source.In):
                numbers = set(value) if isinstance(f, source.In) else {value}
                self.only = numbers if self.only is None else self.only & numbers
            elif column == ("platform",) and isinstance(f, source.EqualTo | source.In):
                names = set(value) if isinstance(f, source.In) else {value}
                self.platforms = names if self.platforms is None else self.platforms & names
            else:
                yield f

    def _wanted(self, number: int) -> bool:
        return (self.low is None or number >= self.low) and (self.high is None or number <= self.high) and (self.only is None or number in self.only)

    def partitions(self) -> list[_Task]:
        found = self.pages.found()
        return self.pages.tasks({
            p: [x for x in pages if self._wanted(x[0])] for p, pages in found.items() if self.platforms is None or p in self.platforms
        })

    def read(self, partition: _Task) -> Iterator[tuple]:
        return self.pages.rows(partition)


class _StreamReader(source.DataSourceStreamReader):
    """Offsets are {source: highest page number}; a source that appears later starts at its first page."""

    def __init__(self, pages: _Pages):
        self.pages = pages

    def initialOffset(self) -> dict:
        return {"pages": {}}

    def latestOffset(self) -> dict:
        return {"pages": {p: pages[-1][0] for p, pages in sorted(self.pages.found().items()) if pages}}

    def partitions(self, start: dict, end: dict) -> list[_Task]:
        before = start["pages"]
        return self.pages.tasks({
            p: [x for x in pages if before.get(p, 0) < x[0] <= end["pages"].get(p, 0)] for p, pages in self.pages.found().items()
        })

    def read(self, partition: _Task) -> Iterator[tuple]:
        return self.pages.rows(partition)


@dataclass
class _Written(source.WriterCommitMessage):
    pages: int


class _Writer(source.DataSourceWriter):
    def __init__(self, path: str, overwrite: bool):
        if overwrite:
            raise ValueError("saved pages are added or replaced one by one: use mode append")
        self.path = path

    def write(self, iterator: Iterator) -> _Written:
        folder, n, made = _Folder(self.path), 0, set()
        for row in iterator:
            if not row["platform"] or row["page_no"] is None or "/" in row["platform"] or row["page_no"] < 0:
                raise ValueError("a saved page needs a platform (a folder's name) and a page number")
            if row["platform"] not in made:
                folder.store.create_dir(f"{folder.path}/{row['platform']}", recursive=True)
                made.add(row["platform"])
            name = folder.file(row["platform"], row["page_no"])
            partial = f"{name}.{uuid.uuid4().hex}.partial"  # readers see whole pages only
            with folder.store.open_output_stream(partial) as out:
                out.write((row["html"] or "").encode())
            folder.store.move(partial, name)
            n += 1
        return _Written(n)

    def commit(self, messages: list) -> None:
        folder = _Folder(self.path)
        folder.store.create_dir(folder.path, recursive=True)
        with folder.store.open_output_stream(f"{folder.path}/_written-{uuid.uuid4().hex}.json") as out:
            out.write(json.dumps({"pages": sum(m.pages for m in messages if m)}).encode())


class SavedPages(source.DataSource):
    @classmethod
    def name(cls) -> str:
        return NAME

    def schema(self) -> str:
        return RAW_PAGE_DDL

    def reader(self, schema) -> source.DataSourceReader:
        return _Reader(_Pages(self.options))

    def streamReader(self, schema) -> source.DataSourceStreamReader:
        return _StreamReader(_Pages(self.options))

    def writer(self, schema, overwrite: bool) -> source.DataSourceWriter:
        return _Writer(_Pages(self.options).path, overwrite)


def register_saved_pages(spark: SparkSession) -> None:
    ship_package(spark)
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(SavedPages)
