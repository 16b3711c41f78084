"""Scans of retailers' services through a fetcher that the caller gives, one task a category.

A fetcher is a picklable callable that runs on executors, so that clients, headers, pauses and retries are
its own affair and tests give pages from memory. Nothing here opens a connection.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Iterable, Iterator, Sequence

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfspark.sources.files import objects_in

_ROWS = "category string, query string, page int, pos int, item string"


def _categories(spark: SparkSession, queries: Iterable[tuple[str, Sequence[str]]]) -> DataFrame:
    """``category, queries`` with a partition for each category."""
    rows = [(name, list(facets)) for name, facets in queries]
    return spark.createDataFrame(rows, "category string, queries array<string>").repartition(max(1, len(rows)), "category")


def first_with_hits(candidates: Sequence[str], count: Callable[[str], int]) -> str | None:
    """The first facet for which ``count`` finds rows."""
    return next((c for c in candidates if count(c) > 0), None)


def scan_pages(
    spark: SparkSession, queries: Iterable[tuple[str, Sequence[str]]], fetch: Callable[[str, int, int], dict], pages: int = 50, size: int = 100
) -> DataFrame:
    """``category, query, page, pos, item`` (JSON) of limit and offset pages.

    ``queries`` gives each category's candidate queries; the first with any hit is read, so a search index can be probed
    for the facet it knows. ``fetch(query, offset, limit)`` gives ``{"items": [...], "count": n}``. A category ends at an
    empty page, at ``count`` or after ``pages`` pages; an error ends it and keeps what came before.
    """

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for category, candidates in zip(frame["category"], frame["queries"], strict=True):
                rows = list(_one(category, list(candidates), fetch, pages, size))
                yield pd.DataFrame(rows, columns=["category", "query", "page", "pos", "item"])

    return _categories(spark, queries).mapInPandas(run, _ROWS)


def _one(category: str, candidates: list[str], fetch, pages: int, size: int) -> Iterator[tuple]:
    try:
        query = candidates[0] if len(candidates) == 1 else first_with_hits(candidates, lambda c: int(fetch(c, 0, 1).get("count") or 0))
        for page in range(pages if query is not None else 0):
            found = fetch(query, page * size, size)
            items = found.get("items") or []
            for i, item in enumerate(items):
                yield (category, query, page + 1, i, json.dumps(item, ensure_ascii=False))
            if not items or (page + 1) * size >= int(found.get("count") or 0):
                return
    except Exception:  # noqa: BLE001 - whatever the fetcher raises ends the category
        return


def scan_html(spark: SparkSession, queries: Iterable[tuple[str, Sequence[str]]], fetch: Callable[[str, int], str], pages: int = 100, key: str = "id") -> DataFrame:
    """``category, query, page, product`` (JSON) of products in the script data of numbered html pages.

    All of a category's queries are read. One ends at a page without products, at a page whose products have all
    been seen, or after ``pages`` pages; an error of ``fetch(query, page)`` fails the scan.
    """
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for category, sources in zip(frame["category"], frame["queries"], strict=True):
                rows = []
                for query in sources:
                    seen: set = set()
                    for page in range(1, pages + 1):
                        products = list(objects_in(fetch(query, page)))
                        ids = [json.loads(p).get(key) for p in products]
                        if not products or seen.issuperset(ids):
                            break
                        seen.update(ids)
                        rows += [(category, query, page, p) for p in products]
                yield pd.DataFrame(rows, columns=["category", "query", "page", "product"])

    return _categories(spark, queries).mapInPandas(run, "category string, query string, page int, product string")


def require_products(df: DataFrame, categories: Sequence[str] | None = None) -> DataFrame:
    """``df``, unless it (or one of ``categories``) holds no product: then an error, so that nothing replaces yesterday's file."""
    counts = {r["category"]: r["n"] for r in df.groupBy("category").agg(F.count("*").alias("n")).collect()}
    empty = [c for c in categories or [] if not counts.get(c)]
    if not counts or empty:
        raise ValueError(f"no products found{': ' + ', '.join(empty) if empty else ''}")
    return df


__all__ = ["first_with_hits", "require_products", "scan_html", "scan_pages"]
