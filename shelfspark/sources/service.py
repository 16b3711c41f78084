"""A retailer's service as a data source: a partition a range of pages, filters and fields pushed into the requests.

``spark.dataSource.register(service("shop", fetch, queries))``, then ``spark.read.format("shop").load()``. ``fetch`` is
the caller's, runs on driver (one probe a query) and executors, and opens whatever connection it likes:
``fetch(query, offset, limit, filters, fields)`` gives ``{"items": [...], "count": n}``.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Iterable, Iterator, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql.datasource import DataSource, DataSourceReader, EqualTo, Filter, In, InputPartition
from pyspark.sql.types import StructType

_OWN = "category string, query string, page int, pos int, item string, error string"
_OWN_NAMES = [c.split()[0] for c in _OWN.split(", ")]


@dataclass
class Pages(InputPartition):
    """Pages ``first`` to ``last`` of one query."""

    category: str
    query: str
    first: int
    last: int


def service(name_: str, fetch: Callable[..., dict], queries: Mapping[str, Sequence[str]], size: int = 100, pages: int = 50, per_task: int = 10) -> type[DataSource]:
    """A data source class over ``fetch``.

    ``queries`` gives each category's candidate queries; the first with hits is read, up to ``pages`` pages of ``size``
    items, ``per_task`` pages a task. Rows are ``category, query, page, pos, item`` (JSON). A schema given to the reader may name fields
    of the items besides: they become columns, the request is told to bring no others, and an equality or list
    on one travels with the request (Spark tests it again). A filter on the category leaves other categories unasked. A page that can't be
    read gives one row with its ``error`` and ends its task's range, what came before stays.
    """

    class Reader(DataSourceReader):
        def __init__(self, schema: StructType):
            self.names, self.fields = schema.names, [n for n in schema.names if n not in _OWN_NAMES]
            self.categories, self.filters = list(queries), {}

        def pushFilters(self, filters: list[Filter]) -> Iterable[Filter]:
            for f in filters:
                values = [f.value] if isinstance(f, EqualTo) else list(f.value) if isinstance(f, In) else None
                column = f.attribute[0] if values is not None and len(f.attribute) == 1 else None
                if column == "category":
                    self.categories = [c for c in self.categories if c in values]
                    continue
                if column in self.fields:
                    kept = self.filters.get(column, values)
                    self.filters[column] = [v for v in kept if v in values]
                yield f

        def _fetch(self, query: str, offset: int, limit: int) -> dict:
            return fetch(query, offset, limit, self.filters, self.fields or None)

        def partitions(self) -> list[InputPartition]:
            out: list[InputPartition] = []
            for category in self.categories:
                for query in queries[category]:
                    count = int(self._fetch(query, 0, 1).get("count") or 0)
                    if count:
                        n = min(pages, -(-count // size))
                        out += [Pages(category, query, a, min(n, a + per_task)) for a in range(0, n, per_task)]
                        break
            return out or [Pages("", "", 0, 0)]

        def read(self, partition: Pages) -> Iterator[tuple]:
            for page in range(partition.first, partition.last):
                own = {"category": partition.category, "query": partition.query, "page": page + 1}
                try:
                    items = self._fetch(partition.query, page * size, size).get("items") or []
                except Exception as e:  # noqa: BLE001 - whatever the fetcher raises is told in the row
                    yield self._row(own | {"error": f"{type(e).__name__}: {e}"})
                    return
                for i, item in enumerate(items):
                    fields = {k: item.get(k) for k in self.fields}
                    yield self._row(fields | own | {"pos": i, "item": json.dumps(item, ensure_ascii=False)})
                if not items:
                    return

        def _row(self, values: dict) -> tuple:
            return tuple(values.get(n) for n in self.names)

    class Service(DataSource):
        @classmethod
        def name(cls) -> str:
            return name_

        def schema(self) -> str:
            return _OWN

        def reader(self, schema: StructType) -> DataSourceReader:
            return Reader(schema)

    return Service
