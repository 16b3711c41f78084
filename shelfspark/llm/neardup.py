"""Near-duplicate classes: fast similarity sketching, banding, exact verification.

Sketch. Round ``i`` of the first ``t`` rounds throws every shingle into a random one of ``t`` bins with
a value in [i, i + 1); rounds ``t`` to ``2t - 1`` throw all shingles into bin ``i - t``. A bin keeps its
least value; rounds stop once every bin is filled, so large sets need about one round and every set is
filled after ``2t``. Bins agree for two sets with the chance of their similarity, concentrated as for
sampling without replacement.

Candidates. Sets that agree in all rows of a band meet in a bucket. Equal sets are one class from the
start. In each bucket every member is checked against one centre (the member with most company).
Where that leaves several components, members outside the bucket's largest component meet all others by
sketch, block by block; those with a likely partner in another component are then compared by full
sets. A bucket of any size loses no link and never expands into all its pairs, and texts travel only
for members with a likely partner. With 32 bands of 4 rows a pair at similarity 0.75 is missed with a chance of 5e-6.

Links are confirmed on the full shingle sets; classes are connected components.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfspark.llm import hashing
from shelfspark.llm.util import chunks, materialize, mapped, small
from shelfspark.operators.components import connected_components

#: Members of a bucket that meet in one comparison block with their texts, and by their sketches alone.
BLOCK, SKETCH_BLOCK = 256, 2048

#: Members that share a centre and are verified in one task.
PER_CENTRE = 256

_SEED = np.uint64(0xA0761D6478BD642F)
_BITS = np.uint64(56)
_UNFILLED = np.uint64(0xFFFFFFFFFFFFFFFF)


def sketch(values: np.ndarray, offsets: np.ndarray, t: int = 128) -> np.ndarray:
    """Sketches (sets x ``t``, uint64) of sets given as hashes in a row and n + 1 offsets; t is a power of 2 up to 128."""
    n = len(offsets) - 1
    out = np.full(n * t, _UNFILLED)
    owner = np.repeat(np.arange(n), np.diff(offsets))
    shift = np.uint64(64 - t.bit_length() + 1)
    low = np.uint64((1 << 56) - 1)
    live = np.ones(len(values), bool)
    for i in range(2 * t):
        h = hashing.mix(values ^ hashing.mix(np.array([i + 1], np.uint64) * _SEED))
        at = owner * t + (h >> shift).astype(np.int64) if i < t else owner * t + (i - t)
        value = (hashing.mix(h) & low) | (np.uint64(min(i, 255)) << _BITS)
        np.minimum.at(out, at, value)
        open_ = (out.reshape(n, t) == _UNFILLED).any(axis=1)
        live = open_[owner]
        if not live.any():
            break
        if i < 2 * t - 1 and not live.all():
            values, owner = values[live], owner[live]
    return out.reshape(n, t)


def _distinct(values: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    parts = [np.unique(values[a:b]) for a, b in zip(offsets[:-1], offsets[1:], strict=True)]
    sizes = np.array([len(p) for p in parts], np.int64)
    return np.concatenate(parts) if parts else values, np.concatenate([[0], np.cumsum(sizes)])


def shingle_sets(texts: pa.Array, n: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct shingle hashes of each text, and their offsets."""
    raw, offsets = hashing.text_bytes(texts)
    starts, ends, words = hashing.words(raw, offsets)
    return _distinct(*hashing.shingles(hashing.word_hashes(raw, starts, ends), words, n))


def sketches(docs: DataFrame, shingle: int = 5, bands: int = 32, rows: int = 4) -> DataFrame:
    """``doc_id, n_shingles, d1, d2, sketch, bands`` for each row: set size, set digest, sketch, band hashes."""
    t = bands * rows

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks(batches, 1):
            values, offsets = shingle_sets(batch.column(1), shingle)
            sizes = np.diff(offsets)
            total = np.zeros(len(values) + 1, np.uint64)
            np.cumsum(hashing.mix(values), out=total[1:])
            d1 = total[offsets[1:]] - total[offsets[:-1]]
            np.cumsum(hashing.mix(values ^ _SEED), out=total[1:])
            d2 = total[offsets[1:]] - total[offsets[:-1]]
            s = sketch(values, offsets, t)
            h = np.tile(np.arange(1, bands + 1, dtype=np.uint64), (len(sizes), 1))
            for k in range(rows):
                h = hashing.mix(h ^ s[:, k::rows])
            even = lambda m: pa.FixedSizeListArray.from_arrays(pa.array(m.ravel()), m.shape[1]).cast(
                pa.list_(pa.from_numpy_dtype(m.dtype))
            )
            brief = (hashing.mix(s) >> np.uint64(48)).astype(np.uint16).view(np.int16)
            packed = pa.array([r.tobytes() for r in brief], pa.binary())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(sizes), pa.array(d1.view(np.int64)), pa.array(d2.view(np.int64)), packed, even(h.view(np.int64))],
                ["doc_id", "n_shingles", "d1", "d2", "sketch", "bands"],
            )

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).transform(
        mapped(run, "doc_id long, n_shingles long, d1 long, d2 long, sketch binary, bands array<long>")
    )


def _verified(pairs: DataFrame, docs: DataFrame, shingle: int, percent: int) -> DataFrame:
    """Those of ``pairs`` (a, b) whose full sets have 100 * common >= percent * union.

    Each text travels once as a member for each of its pairs and once for each block of
    ``PER_CENTRE`` members of a centre ``b``; a block is read in order, its centre first.
    """
    texts = materialize(_first_texts(docs, materialize(pairs.select(F.col("a").alias("doc_id")).union(pairs.select("b")).distinct())))
    sizes = small(materialize(pairs.groupBy("b").agg(F.count("*").alias("n"))))
    salts = sizes.select("b", F.explode(F.sequence(F.lit(0), F.floor((F.col("n") - 1) / PER_CENTRE).cast("int"))).alias("salt"), "n")
    members = pairs.join(sizes, "b").select(
        "a", "b", F.pmod(F.xxhash64("a"), F.floor((F.col("n") - 1) / PER_CENTRE).cast("int") + 1).cast("int").alias("salt")
    )
    rows = (
        texts.join(salts, texts.doc_id == salts.b)
        .select("b", "salt", F.lit(None).cast("long").alias("a"), "text")
        .union(texts.join(members, texts.doc_id == members.a).select("b", "salt", "a", "text"))
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        centre, block = np.zeros(0, np.uint64), None
        for batch in chunks(batches, 3):
            values, offsets = shingle_sets(batch.column(3), shingle)
            bs, salts, as_ = (batch.column(i).to_pylist() for i in range(3))
            found: list[tuple[int, int]] = []
            for i, (b, s, a) in enumerate(zip(bs, salts, as_, strict=True)):
                own = values[offsets[i] : offsets[i + 1]]
                if a is None:
                    centre, block = own.copy(), (b, s)
                    continue
                assert block == (b, s)
                if _similar(own, centre, percent):
                    found.append((a, b))
            yield pa.RecordBatch.from_arrays(
                [pa.array([x[0] for x in found], pa.int64()), pa.array([x[1] for x in found], pa.int64())], ["a", "b"]
            )

    return (
        rows.repartition("b", "salt")
        .sortWithinPartitions("b", "salt", F.col("a").asc_nulls_first())
        .select("b", "salt", "a", "text")
        .transform(mapped(run, "a long, b long"))
    )


def _first_texts(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """``doc_id, text`` of some ids; rows of one id count as one document, its text the first in order."""
    own = docs.select(F.col("doc_id").cast("long"), "text").join(small(ids), "doc_id")
    return own.groupBy("doc_id").agg(F.min("text").alias("text"))


def _similar(x: np.ndarray, y: np.ndarray, percent: int) -> bool:
    """Whether two sorted sets have 100 * common >= percent * union; empty sets have not."""
    few, many = (x, y) if len(x) <= len(y) else (y, x)
    if not len(few) or 100 * len(few) < percent * len(many):
        return False
    common = int((many[np.minimum(np.searchsorted(many, few), len(many) - 1)] == few).sum())
    return 100 * common >= percent * (len(x) + len(y) - common)


def _least_agreement(t: int, percent: int) -> float:
    """Equal places of ``t`` that a similar pair has at least, five standard deviations below the mean."""
    p = percent / 100
    return t * (p - 5 * (p * (1 - p) / t) ** 0.5)


def _likely_partners(x: int, rows: dict[str, np.ndarray], candidates: np.ndarray, band: int, least: float, percent: int) -> tuple[np.ndarray, np.ndarray]:
    """Those of ``candidates`` of other components that member ``x`` may be similar to, with their equal places.

    A pair is looked at in the first band that it shares.
    """
    size = rows["n_shingles"]
    y = candidates[rows["component"][candidates] != rows["component"][x]]
    y = y[100 * np.minimum(size[y], size[x]) >= percent * np.maximum(size[y], size[x])]
    same = (rows["sketch"][y] == rows["sketch"][x]).sum(axis=1)
    y, same = y[same >= least], same[same >= least]
    new = ~(rows["bands"][y, :band] == rows["bands"][x, :band]).any(axis=1)
    return y[new], same[new]


def _grouped(batches: Iterator[pa.RecordBatch], keys: int) -> Iterator[pa.RecordBatch]:
    """The groups of rows, sorted by their first ``keys`` columns (long or int), as one batch each."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        columns = np.stack([batch.column(i).to_numpy() for i in range(keys)])
        if held and any(held[0].column(i)[0].as_py() != columns[i, 0] for i in range(keys)):
            yield pa.concat_batches(held)
            held = []
        cuts = [0, *(np.flatnonzero((columns[:, 1:] != columns[:, :-1]).any(axis=0)) + 1).tolist(), batch.num_rows]
        for start, end in zip(cuts[:-2], cuts[1:-1], strict=True):
            yield pa.concat_batches([*held, batch.slice(start, end - start)]) if held else batch.slice(start, end - start)
            held = []
        held.append(batch.slice(cuts[-2]))
    if held:
        yield pa.concat_batches(held)


def _unpacked(group: pa.RecordBatch, t: int) -> dict[str, np.ndarray]:
    rows = {c: group.column(c).to_numpy() for c in ("own", "rep", "component", "n_shingles")}
    rows["sketch"] = np.frombuffer(b"".join(group.column("sketch").to_pylist()), np.int16).reshape(-1, t)
    rows["bands"] = group.column("bands").flatten().to_numpy().reshape(group.num_rows, -1)
    return rows


_GROUP = ["key", "band", "i", "j"]


def _likely(members: DataFrame, t: int, percent: int) -> DataFrame:
    """``key, rep`` of members that by their sketches may be similar to a member of another component.

    A bucket's largest component is ``main``. The others are dealt to outer blocks, each of which meets every
    block of the bucket once: members of ``main`` never meet each other, so a bucket with few outsiders
    sends each member once.
    """
    least, per = _least_agreement(t, percent), SKETCH_BLOCK
    of_component = members.groupBy("key", "component").agg(F.count("*").alias("m"))
    shape = of_component.groupBy("key").agg(
        F.max(F.struct("m", "component")).alias("main"), F.sum("m").alias("n")
    ).select("key", F.col("main.component").alias("main"), F.col("main.m").alias("inside"), (F.col("n") - F.col("main.m")).alias("outside"))
    count = lambda c: F.ceil(F.col(c) / per).cast("int")
    dealt = members.join(small(materialize(shape)), "key").withColumn("outer", F.col("component") != F.col("main"))
    place = lambda c, first: first + F.pmod(F.xxhash64("rep", F.lit(7)), count(c)).cast("int")
    dealt = dealt.withColumn("own", F.when(F.col("outer"), place("outside", F.lit(0))).otherwise(place("inside", count("outside"))))
    last = F.when(F.col("outer"), count("outside") + count("inside") - 1).otherwise(count("outside") - 1)
    met = dealt.select("*", F.explode(F.sequence(F.lit(0), last)).alias("other")).select(
        "key", "band", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), "own", "rep", "component", "n_shingles",
        "sketch", "bands",
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in _grouped(batches, len(_GROUP)):
            key, band, i, j = (group.column(c)[0].as_py() for c in range(len(_GROUP)))
            rows = _unpacked(group, t)
            marked = np.zeros(group.num_rows, bool)
            there = np.flatnonzero(rows["own"] == j)
            for x in np.flatnonzero(rows["own"] == i):
                y, _ = _likely_partners(x, rows, there[there > x] if i == j else there, band, least, percent)
                marked[y] = True
                marked[x] |= len(y) > 0
            if marked.any():
                yield pa.RecordBatch.from_arrays([pa.array(np.full(marked.sum(), key)), pa.array(rows["rep"][marked])], ["key", "rep"])

    return met.repartition(*_GROUP).sortWithinPartitions(*_GROUP).transform(mapped(run, "key long, rep long")).distinct()


def _within_blocks(members: DataFrame, t: int, shingle: int, percent: int) -> DataFrame:
    """Links (a, b) that join different components within buckets, confirmed on full sets.

    ``members`` have a likely partner each. They are dealt to blocks and each task holds two of them. No link found
    so far in the task may join a pair's components: the rest of a class needs no further links, and a task
    gives fewer links than rows.
    """
    least = _least_agreement(t, percent)
    n = members.groupBy("key").agg(F.count("*").alias("n"))
    blocks = F.floor((F.col("n") - 1) / BLOCK).cast("int") + 1
    dealt = members.join(n, "key").withColumn("blocks", blocks).withColumn("own", F.pmod(F.xxhash64("rep", F.lit(7)), "blocks").cast("int"))
    replicas = dealt.select("*", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other")).select(
        "key", "band", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), "own", "rep", "component", "n_shingles",
        "sketch", "bands", "text",
    )

    def links(group: pa.RecordBatch) -> list[tuple[int, int]]:
        _, band, i, j = (group.column(c)[0].as_py() for c in range(len(_GROUP)))
        rows = _unpacked(group, t)
        there, likely = np.flatnonzero(rows["own"] == j), []
        for x in np.flatnonzero(rows["own"] == i):
            y, same = _likely_partners(x, rows, there[there > x] if i == j else there, band, least, percent)
            likely += zip((-same).tolist(), [int(x)] * len(y), y.tolist(), strict=True)
        needed = sorted({z for _, *pair in likely for z in pair})
        values, offsets = shingle_sets(group.column("text").take(pa.array(needed, pa.int64())), shingle)
        sets = {z: values[a:b] for z, a, b in zip(needed, offsets[:-1], offsets[1:], strict=True)}
        rep, comp = rows["rep"].tolist(), rows["component"].tolist()
        parent = {c: c for c in comp}

        def root(c: int) -> int:
            while parent[c] != c:
                parent[c] = c = parent[parent[c]]
            return c

        found = []
        for _, x, y in sorted(likely):
            cx, cy = root(comp[x]), root(comp[y])
            if cx != cy and _similar(sets[x], sets[y], percent):
                parent[cx] = cy
                found.append((max(rep[x], rep[y]), min(rep[x], rep[y])))
        return found

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in _grouped(batches, len(_GROUP)):
            if found := links(group):
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*found, strict=True)], ["a", "b"])

    return replicas.repartition(*_GROUP).sortWithinPartitions(*_GROUP, "own", "rep").transform(mapped(run, "a long, b long")).distinct()


def near_duplicates(docs: DataFrame, shingle: int = 5, percent: int = 75, bands: int = 32, rows: int = 4) -> DataFrame:
    """``doc_id, n_shingles, component_id, kept``: classes of documents linked at ``percent`` similarity.

    Null and blank texts have empty sets, linked with nothing. A null id takes part in no link and is
    its own class (component_id null, kept). Rows of one id count as one document with the first of their
    texts (n_shingles is each row's own). An empty table gives no rows; other columns are ignored.
    """
    source = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    all_ = materialize(sketches(source, shingle, bands, rows))
    # An id in several rows is one document: that of the first of its texts.
    again = materialize(all_.where("doc_id IS NOT NULL").groupBy("doc_id").count().where("count > 1").select("doc_id"))
    own = all_.where("doc_id IS NOT NULL")
    if not again.isEmpty():
        own = own.join(small(again), "doc_id", "left_anti").unionByName(materialize(sketches(_first_texts(source, again), shingle, bands, rows)))
    sets = own.where("n_shingles > 0")
    digest = ["d1", "d2", "n_shingles"]
    classes = materialize(sets.groupBy(digest).agg(F.min("doc_id").alias("rep"), F.count("*").alias("copies")))
    reps = materialize(classes.select("rep").join(sets.withColumnRenamed("doc_id", "rep"), "rep"))
    buckets = reps.select("rep", F.posexplode("bands").alias("band", "value")).select(
        "rep", "band", F.xxhash64("band", "value").alias("key")
    )
    shared = materialize(buckets.groupBy("key").agg(F.count("*").alias("n")).where("n > 1"))
    member = materialize(buckets.join(small(shared), "key"))
    company = member.groupBy("rep").agg(F.sum("n").alias("company"))
    with_company = member.join(company, "rep")
    centres = with_company.groupBy("key").agg(F.max(F.struct("company", (-F.col("rep")).alias("minus"))).alias("m"))
    sizes = reps.select("rep", "n_shingles")
    star = (
        member.join(centres.select("key", (-F.col("m.minus")).alias("centre")), "key")
        .where("rep <> centre")
        .select(F.col("rep").alias("a"), F.col("centre").alias("b"))
        .distinct()
    )
    fits = lambda pairs: (
        pairs.join(sizes.select(F.col("rep").alias("a"), F.col("n_shingles").alias("na")), "a")
        .join(sizes.select(F.col("rep").alias("b"), F.col("n_shingles").alias("nb")), "b")
        .where(100 * F.least("na", "nb") >= percent * F.greatest("na", "nb"))
        .select("a", "b")
    )
    links = materialize(_verified(materialize(fits(star)), source, shingle, percent))

    labels = materialize(connected_components(links, "a", "b"))
    placed = (
        member.join(labels.withColumnRenamed("node", "rep"), "rep", "left")
        .select("key", "band", "n", "rep", F.coalesce("component", "rep").alias("component"))
    )
    apart = placed.groupBy("key").agg(F.min("component").alias("x"), F.max("component").alias("y")).where("x <> y")
    rest = materialize(placed.join(small(materialize(apart.select("key"))), "key", "left_semi").drop("n"))
    more = rest.select(F.col("rep").alias("a"), F.col("rep").alias("b")).limit(0)
    if not rest.isEmpty():
        sketched = reps.select("rep", "n_shingles", "sketch", "bands")
        likely = materialize(_likely(rest.join(sketched, "rep"), bands * rows, percent))
        texts = _first_texts(source, materialize(likely.select(F.col("rep").alias("doc_id")).distinct())).withColumnRenamed("doc_id", "rep")
        full = rest.join(likely, ["key", "rep"]).join(sketched.join(texts, "rep"), "rep")
        more = materialize(_within_blocks(full, bands * rows, shingle, percent))
    if not more.isEmpty():
        labels = materialize(connected_components(links.union(more), "a", "b"))

    of_class = classes.join(labels.withColumnRenamed("node", "rep"), "rep", "left").select(
        *digest, F.coalesce("component", "rep").alias("component_id")
    )
    plain = all_.select("doc_id", "n_shingles", *(F.col(c).alias(f"own_{c}") for c in digest))
    if not again.isEmpty():
        firsts = own.join(small(again), "doc_id", "left_semi").select("doc_id", *(F.col(c).alias(f"first_{c}") for c in digest))
        plain = plain.join(small(materialize(firsts)), "doc_id", "left").select(
            "doc_id", "n_shingles", *(F.coalesce(f"first_{c}", f"own_{c}").alias(f"own_{c}") for c in digest)
        )
    return (
        plain.join(of_class.withColumnsRenamed({c: f"own_{c}" for c in digest}), [f"own_{c}" for c in digest], "left")
        .withColumn("component_id", F.when(F.col("doc_id").isNotNull(), F.coalesce("component_id", "doc_id")))
        .select("doc_id", "n_shingles", "component_id", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)).alias("kept"))
    )


def keep_representatives(docs: DataFrame, **options) -> DataFrame:
    """``docs`` with one document of each class; rows with a null id stay."""
    gone = materialize(near_duplicates(docs, **options).where(~F.col("kept")).select("doc_id").distinct())
    return docs.join(small(gone), "doc_id", "left_anti").select(*docs.columns)
