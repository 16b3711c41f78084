"""JSON array files, envelopes, and JSON inside html pages."""

from __future__ import annotations

import json
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StructType

from shelfspark.functions.text import decode_page, decoded_page
from shelfspark.schemas import BRANCHES
from shelfspark.sources.arrays import array_records
from shelfspark.storage import BATCH_BYTES, bounded_batches, materialize


#: Rows that an export keeps in one file.
EXPORT_ROWS = 100_000


def _exists(spark: SparkSession, path: str) -> bool:
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop.getFileSystem(spark._jsc.hadoopConfiguration()).exists(hadoop)


def replace_folder(spark: SparkSession, staged: str, place: str) -> None:
    """The folder ``staged`` takes the place of ``place``."""
    path = spark._jvm.org.apache.hadoop.fs.Path
    files = path(place).getFileSystem(spark._jsc.hadoopConfiguration())
    files.delete(path(place), True)
    if not files.rename(path(staged), path(place)):
        raise OSError(f"{staged} could not become {place}")


def json_array(spark: SparkSession, path: str, schema: str, required: bool = False) -> DataFrame:
    """Rows of a file that holds one JSON array, or an object with ``records`` or ``products``, with their place ``pos``.

    The array is read by as many tasks as Spark splits the file into; a file whose array comes after other keys, or holds no
    objects at all, is read as one value. A missing file gives no rows unless it is required.
    """
    if not _exists(spark, path) and not required:
        return spark.createDataFrame([], f"{schema}, pos int")
    kind = StructType.fromDDL(schema)
    found = array_records(spark, path)
    if found is not None:
        return found.select(F.from_json(F.to_json(F.parse_json("text")), kind).alias("row"), "pos").select("row.*", "pos")
    whole = spark.read.text(path, wholetext=True).select(unwrap(F.parse_json("value")).alias("rows"))
    items = whole.select(F.from_json(F.to_json("rows"), ArrayType(kind)).alias("rows"))
    return items.select(F.posexplode("rows").alias("pos", "row")).select("row.*", "pos")


def unwrap(v):
    """The array itself or that in an object's ``records`` or ``products``; anything else is an error."""
    found = F.coalesce(F.try_variant_get(v, "$.records", "variant"), F.try_variant_get(v, "$.products", "variant"), v)
    return F.when(F.schema_of_variant(found).startswith("ARRAY"), found).otherwise(F.raise_error(F.lit("no array of records")).cast("variant"))


def write_export(df: DataFrame, path: str, order: list[str] | None = None) -> None:
    """One JSON array beside the Parquet layers, for readers outside: a folder of text files that make it up in the order of their names.

    A row is a line, in the given order; tasks hold ranges of rows, and up to ``EXPORT_ROWS`` rows make one file. Only the
    least place comes to the driver, since a comma stands before every row but the first.
    """
    spark = df.sparkSession
    line = F.to_json(F.struct(*df.columns), {"ignoreNullFields": "false"})
    sorted_ = df.repartitionByRange(*order).sortWithinPartitions(*order) if order else df
    rows = materialize(sorted_.select(line.alias("value"), F.monotonically_increasing_id().alias("at")))
    first, n = rows.agg(F.min("at"), F.count("*")).first()
    value = F.when(F.col("at") == first, F.col("value")).otherwise(F.concat(F.lit(","), "value")).alias("value")
    whole = rows.select(value, "at").unionByName(spark.createDataFrame([("[", -1), ("]", (1 << 63) - 1)], "value string, at long"))
    whole.repartitionByRange(1 + n // EXPORT_ROWS, "at").sortWithinPartitions("at").select("value").write.mode("overwrite").text(path)


def branch_files(spark: SparkSession, paths: list[str] | str) -> DataFrame:
    """Branches of files that hold one JSON array each."""
    return spark.read.schema(BRANCHES).option("multiLine", True).json(paths)


def embedded_products(pages: DataFrame, html: str = "html", back: int = 20_000) -> DataFrame:
    """Products found in pages' script data: one row each, ``product`` as JSON text, besides the pages' other columns.

    At each ``"varieties":`` mark the smallest enclosing object with an id, a name and varieties is taken, its
    opening brace at most ``back`` characters before the mark. A product repeats only if the page repeats it.
    Pages are wide, so a batch is bounded by its bytes and its products leave in frames of about as many.
    """
    bounded_batches(pages.sparkSession)
    others = [c for c in pages.columns if c != html]
    schema = f"{', '.join(f'`{f.name}` {f.dataType.simpleString()}' for f in pages.schema if f.name != html)}, product string"

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            rows, size = [], 0
            for r in frame[[*others, "_decoded"]].itertuples(index=False):
                for p in _objects(r[-1], back):
                    rows.append((*r[:-1], p))
                    size += len(p)
                    if size > BATCH_BYTES:
                        yield pd.DataFrame(rows, columns=[*others, "product"])
                        rows, size = [], 0
            yield pd.DataFrame(rows, columns=[*others, "product"])

    marked = pages.withColumn("_decoded", decode_page(F.col(html))).where(F.col("_decoded").contains('"varieties":'))
    return marked.select(*others, "_decoded").mapInPandas(run, schema)


def objects_in(html: str | None, back: int = 20_000) -> Iterator[str]:
    """The products of one page, as ``embedded_products`` finds them."""
    return _objects(decoded_page(html or ""), back)


def _objects(text: str, back: int) -> Iterator[str]:
    mark, at = '"varieties":', text.find('"varieties":')
    seen = set()
    decoder = json.JSONDecoder()
    while at >= 0:
        start = at
        while (start := text.rfind("{", max(0, at - back), start)) >= 0:
            try:
                found, end = decoder.raw_decode(text, start)
            except ValueError:
                continue
            if end > at and isinstance(found, dict) and found.get("id") not in (None, "") and found.get("name") and isinstance(found.get("varieties"), list) and found["varieties"]:
                if start not in seen:
                    seen.add(start)
                    yield json.dumps(found, ensure_ascii=False)
                break
        at = text.find(mark, at + 1)
