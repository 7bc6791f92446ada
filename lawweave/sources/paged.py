"""A data source for listings that come in pages: JSON pages under a folder or any file system Python can open.

``spark.read.format("paged_json").option("path", folder).option("field", "records").option("pages_per_task", 4).load()``

Each task reads a range of pages, each page's records become rows (page, position, record as JSON).  Equality
filters on ``page`` are taken over by the source, so other pages are never opened.  Network access is left to a
fetcher that lands pages in the folder.
"""

from __future__ import annotations

import json
import os
import re
from collections.abc import Iterator

from pyspark.sql import SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, EqualTo, Filter, InputPartition


class Pages(InputPartition):
    def __init__(self, files: list[tuple[int, str]]):
        super().__init__(None)
        self.files = files


class PagedReader(DataSourceReader):
    def __init__(self, options: dict):
        self.folder = options["path"]
        self.field = options.get("field", "records")
        self.step = max(1, int(options.get("pages_per_task", "4")))
        self.page: int | None = None

    def pushFilters(self, filters: list[Filter]) -> Iterator[Filter]:
        for f in filters:
            if isinstance(f, EqualTo) and f.attribute == ("page",) and self.page in (None, f.value):
                self.page = f.value
            else:
                yield f

    def partitions(self) -> list[InputPartition]:
        found = [(int(m[1]), os.path.join(self.folder, n)) for n in os.listdir(self.folder) if (m := re.fullmatch(r"\D*(\d+)\.json", n))]
        found = sorted(x for x in found if self.page is None or x[0] == self.page)
        return [Pages(found[i : i + self.step]) for i in range(0, len(found), self.step)] or [Pages([])]

    def read(self, partition: Pages) -> Iterator[tuple]:
        for page, path in partition.files:
            with open(path, encoding="utf-8") as f:
                body = f.read()
            m = re.fullmatch(r"\s*[\w.$]+\s*\((.*)\)\s*;?\s*", body, re.S)  # a page wrapped for a script
            for i, r in enumerate(json.loads(m[1] if m else body).get(self.field) or []):
                yield page, i, json.dumps(r, ensure_ascii=False, sort_keys=True)


class PagedSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "paged_json"

    def schema(self) -> str:
        return "page int, position int, record string"

    def reader(self, schema) -> PagedReader:
        return PagedReader(dict(self.options))


def register(spark: SparkSession) -> None:
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(PagedSource)


def total_pages(rows: int, size: int) -> int:
    """Pages of a listing of so many rows."""
    return -(-rows // size) if size > 0 else 0
