"""A portal that serves events in pages, as a Python data source over pages that were landed as JSON files.

Register with ``spark.dataSource.register(PortalSource)`` and read with ``spark.read.format("portal")
.option("path", folder).load()``.  The folder holds <category>/<skip>.json, each a list of events, as the portal's
pages would be; a category is one partition and its pages are read until one is empty or missing, moving on by the
rows received, as the portal gives fewer a page than asked for.  That ends with the landed files, so a category is read
whole, however long; only where the option ``guard`` is given are more events than that an error.  A filter on the date
reaches the reader.
"""

from __future__ import annotations

import json
from collections.abc import Iterator

from pyspark.sql.datasource import DataSource, DataSourceReader, EqualTo, Filter, GreaterThanOrEqual, InputPartition

SCHEMA = "id bigint, category string, date string, name string, has_media boolean, published boolean"


def _files(folder: str):
    """The file system of a folder, which may be an address such as hdfs:// or s3://, and its path there."""
    from pyarrow import fs

    return fs.FileSystem.from_uri(folder.replace("file:/", "file:///", 1) if folder.startswith("file:/") and "://" not in folder else folder) if ":/" in folder else (fs.LocalFileSystem(), folder)


def _page(where, path: str) -> list[dict]:
    from pyarrow import fs

    if where.get_file_info(path).type != fs.FileType.File:
        return []
    with where.open_input_stream(path) as file:
        return json.loads(file.read())


class Category(InputPartition):
    def __init__(self, name: str):
        self.name = name


class PortalReader(DataSourceReader):
    def __init__(self, options: dict):
        self.folder, self.guard = options["path"], int(options["guard"]) if "guard" in options else None
        self.since, self.only = "", None

    def pushFilters(self, filters: list[Filter]) -> Iterator[Filter]:
        for f in filters:
            if isinstance(f, GreaterThanOrEqual) and f.attribute == ("date",):
                self.since = max(self.since, str(f.value))
            elif isinstance(f, EqualTo) and f.attribute == ("category",):
                self.only = f.value
            else:
                yield f

    def partitions(self) -> list[Category]:
        from pyarrow import fs

        where, root = _files(self.folder)
        names = sorted(f.base_name for f in where.get_file_info(fs.FileSelector(root)) if f.type == fs.FileType.Directory)
        return [Category(n) for n in names if self.only in (None, n)]

    def read(self, partition: Category) -> Iterator[tuple]:
        skip, (where, root) = 0, _files(self.folder)
        while rows := _page(where, f"{root}/{partition.name}/{skip}.json"):
            if self.guard is not None and skip >= self.guard:
                raise ValueError(f"category {partition.name} goes on beyond the guard of {self.guard} events; raise the option guard")
            for r in rows:
                date = str(r.get("eventDate") or "")[:10]
                if date >= self.since:
                    yield r.get("id"), partition.name, date, r.get("eventName"), bool(r.get("hasMedia")), str(r.get("isPublished")).lower() in ("published", "true")
            skip += len(rows)


class PortalSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "portal"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> PortalReader:
        return PortalReader(self.options)
