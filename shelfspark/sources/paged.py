"""Saved pages as a Python data source: one partition a category, filters pushed to it.

Pages are files on storage that driver and executors see as a folder (a service is read by ``remote``):
``<folder>/<category>/<page>.json`` (an array each). A category ends at its first empty or
missing page or after ``pages`` pages; a page that can't be read ends it and keeps what came before.
"""

from __future__ import annotations

import json
import os
from collections.abc import Iterable, Iterator

from pyspark.sql import SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, EqualTo, Filter, In, InputPartition


class _Category(InputPartition):
    def __init__(self, name: str):
        self.name = name


class _Reader(DataSourceReader):
    def __init__(self, options: dict):
        self.folder, self.pages = options["path"], int(options.get("pages", "50"))
        self.categories = [c for c in options.get("categories", "").split(",") if c] or None

    def pushFilters(self, filters: list[Filter]) -> Iterable[Filter]:
        for f in filters:
            if isinstance(f, EqualTo) and f.attribute == ("category",):
                self._only([f.value])
            elif isinstance(f, In) and f.attribute == ("category",):
                self._only(list(f.value))
            else:
                yield f

    def _only(self, names: list[str]) -> None:
        """Several filters hold together."""
        self.categories = [c for c in names if self.categories is None or c in self.categories]

    def partitions(self) -> list[InputPartition]:
        names = self.categories if self.categories is not None else sorted(os.listdir(self.folder))
        return [_Category(n) for n in names]

    def read(self, partition: _Category) -> Iterator[tuple]:
        seen: set[str] = set()
        for page in range(1, self.pages + 1):
            try:
                with open(os.path.join(self.folder, partition.name, f"{page}.json"), encoding="utf-8") as f:
                    items = json.load(f)
            except (OSError, ValueError):
                return
            new = [x for x in items if json.dumps(x, sort_keys=True) not in seen]
            if not new:
                return
            for i, x in enumerate(new):
                seen.add(json.dumps(x, sort_keys=True))
                yield (partition.name, page, i, json.dumps(x, ensure_ascii=False))


class PagedSource(DataSource):
    """After ``register(spark)``: ``spark.read.format("paged").load(folder)``."""

    @classmethod
    def name(cls) -> str:
        return "paged"

    def schema(self) -> str:
        return "category string, page int, pos int, item string"

    def reader(self, schema) -> DataSourceReader:
        return _Reader(self.options)


def register(spark: SparkSession) -> None:
    """Makes the source known, with filters pushed down to it."""
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(PagedSource)
