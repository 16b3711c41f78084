"""The whole batch: silver, matchers, enrichment, warehouse. Each stage reads Parquet layers and may run alone.

Layers live below one folder: ``bronze/<store>/<category>_raw.json``, ``silver/<store>/<category>``,
``gold/<name>`` with a copy for each ``run_date`` in ``gold_archive/<name>``.
"""

from __future__ import annotations

import datetime as dt
import time
from collections.abc import Callable

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from shelfspark.plans import beverages, benchmark, dairy, produce, silver, warehouse
from shelfspark.plans.dag import only_run, run_tasks
from shelfspark.plans.matching import union_stores
from shelfspark.schemas import BRONZE_BINDAWOOD, BRONZE_PANDA, BRONZE_TAMIMI, REFERENCE_PRICES, STORES
from shelfspark.sources.files import _exists, branch_files, json_array, replace_folder, write_export

CATEGORIES = ("beverages", "dairy_and_eggs", "fruits_and_vegetables")
_CLEAN = {"bindawood": (silver.bindawood, BRONZE_BINDAWOOD), "panda": (silver.panda, BRONZE_PANDA), "tamimi": (silver.tamimi, BRONZE_TAMIMI)}

#: Stores whose raw file always holds products: none in it is a failed fetch.
_NEVER_EMPTY = ("panda",)

#: Stage -> stages it needs: all silver before the matchers, produce before enrichment, all gold before the load.
DEPENDS = {
    "silver": (), "beverages": ("silver",), "dairy": ("silver",), "produce": ("silver",), "enrich": ("produce",),
    "load": ("beverages", "dairy", "enrich"),
}


class Run:
    """One run over a folder of layers on a given date (the one date of all stages)."""

    def __init__(self, spark: SparkSession, folder: str, run_date: dt.date, database: str = "warehouse_db"):
        self.spark, self.folder, self.date, self.database = spark, folder.rstrip("/"), run_date, database
        #: What was seen while each silver table was written, by store and category.
        self.counted: dict[tuple[str, str], dict[str, int]] = {}

    def _path(self, *parts: str) -> str:
        return "/".join((self.folder, *parts))

    def silver(self) -> None:
        for store in _CLEAN:
            self.silver_of(store)

    def silver_of(self, store: str) -> None:
        """One store's silver tables. A raw file without products ends the run where a store never has none; the table stays then."""
        clean, schema = _CLEAN[store]
        for category in CATEGORIES:
            raw, place = self._path("bronze", store, f"{category}_raw.json"), self._path("silver", store, category)
            fetched, staged = _exists(self.spark, raw), self._path("silver", store, f"_{category}")
            seen = Observation()
            rows = clean(json_array(self.spark, raw, schema), F.lit(category)).observe(seen, *silver.measures())
            rows.write.mode("overwrite").parquet(staged)
            counted = seen.get
            if fetched and not counted["n"] and store in _NEVER_EMPTY:
                raise ValueError(f"no products found: {store}, {category}")
            replace_folder(self.spark, staged, place)
            self.counted[store, category] = counted

    def coverage(self) -> DataFrame:
        """Totals of every silver table and how many rows have barcodes, a discount, a size.

        Tables that this run has written were counted on the way; others are read.
        """
        names = ("n", "with_barcodes", "with_discount", "with_size")
        ddl = f"store string, {', '.join(f'{n} long' for n in names)}, category string"
        known = [(store, *[seen[n] for n in names], category) for (store, category), seen in self.counted.items()]
        out = self.spark.createDataFrame([r for r in known if r[1]], ddl)
        for store in _CLEAN:
            for category in CATEGORIES:
                if (store, category) not in self.counted:
                    own = silver.counts(self.spark.read.parquet(self._path("silver", store, category)))
                    out = out.unionByName(own.withColumn("category", F.lit(category)))
        return out

    def _products(self, category: str) -> DataFrame:
        return union_stores(*[self.spark.read.parquet(self._path("silver", s, category)) for s in STORES])

    def _previous(self, name: str) -> DataFrame | None:
        path = self._path("gold", name)
        if not _exists(self.spark, path):
            return None
        from shelfspark.storage import materialize

        return materialize(self.spark.read.parquet(path))  # the table itself is about to be replaced

    def _write(self, name: str, gold: DataFrame) -> DataFrame:
        from shelfspark.storage import materialize

        staged = materialize(gold)
        staged.write.mode("overwrite").parquet(self._path("gold", name))
        day = staged.withColumn("run_date", F.lit(self.date))
        day.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("run_date").parquet(self._path("gold_archive", name))
        return staged

    def beverages(self) -> None:
        self._write("beverages", beverages.match(self._products("beverages")))

    def dairy(self, dry_run: bool = False) -> DataFrame | None:
        """Writes dairy gold if the quality gate holds; a dry run returns the difference instead."""
        products, before = self._products("dairy_and_eggs"), self._previous("dairy")
        gold = dairy.match(products, self.date.isoformat(), before)
        if dry_run:
            return dairy.diff_report(before if before is not None else gold.limit(0), gold)
        from shelfspark.storage import materialize

        self._write("dairy", dairy.require_clean(products, materialize(gold)))
        return None

    def audit(self) -> DataFrame:
        return dairy.audit(self._products("dairy_and_eggs"), self.spark.read.parquet(self._path("gold", "dairy")))

    def _records(self) -> DataFrame:
        return json_array(self.spark, self._path("open_data", "reference_prices.json"), REFERENCE_PRICES, required=True)

    def produce(self) -> None:
        gold = produce.match(self._products("fruits_and_vegetables"), self._records(), self.date.isoformat(), self._previous("produce"))
        self._write("produce", gold)

    def enrich(self) -> None:
        self._write("reference", benchmark.enrich(self._records(), self.spark.read.parquet(self._path("gold", "produce"))))

    def load(self) -> None:
        """Branches first, where their files are there, then dimension, references and the day's facts."""
        warehouse.create_tables(self.spark, self.database)
        if _exists(self.spark, self._path("reference")):
            self.branches()
        read = lambda n: self.spark.read.parquet(self._path("gold", n))
        gold = warehouse.union_gold(read("dairy"), read("beverages"), read("produce"))
        warehouse.load(self.spark, self.database, gold, warehouse.reference_rows(read("reference")), self.date)

    def branches(self) -> int:
        """Coordinates of all branches from ``reference/*_branches.json`` into the warehouse."""
        warehouse.create_tables(self.spark, self.database)
        return warehouse.sync_branches(self.spark, self.database, branch_files(self.spark, self._path("reference", "*_branches.json")))

    def export(self, name: str) -> str:
        """A gold table as one JSON array."""
        path = self._path("export", name)
        write_export(self.spark.read.parquet(self._path("gold", name)), path)
        return path

    def side_by_side(self, retries: int = 1, pause: float = 120.0, log: Callable[[str], None] = print) -> dict[str, float]:
        """All stages as a graph: stores and matchers run side by side, a failed task is tried again, one run at a time."""
        stores = {f"silver_{s}": (lambda s=s: self.silver_of(s)) for s in _CLEAN}
        tasks = stores | {name: getattr(self, name) for name in DEPENDS if name != "silver"}
        depends = {name: tuple(stores) if needs == ("silver",) else needs for name, needs in DEPENDS.items()}
        with only_run(self.spark, self.folder):
            return run_tasks(tasks, depends, retries, pause, log=log)

    def all(self, log: Callable[[str], None] = print) -> dict[str, float]:
        """All stages in an order that ``DEPENDS`` allows; the first failure ends the run."""
        took: dict[str, float] = {}
        for name in DEPENDS:
            start = time.perf_counter()
            getattr(self, name)()
            took[name] = time.perf_counter() - start
            log(f"{name}: {took[name]:.1f} s")
        return took
