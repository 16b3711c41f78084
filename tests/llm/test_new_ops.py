"""Source divergence, media columns and whitening against plain computations, with nulls, blanks, ties and repeated rows."""

import hashlib
import random
import re
import struct
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from shelfspark.llm import divergence, media, mjpeg, whitening

# ---------------------------------------------------------------- 11


def plain_divergence(rows, min_docs, top):
    """Term by term, with Python's whole numbers."""
    rows = [tuple(x or "" for x in r) for r in rows]
    counts, docs = defaultdict(Counter), defaultdict(Counter)
    for lang, source, text in rows:
        terms = [m.translate({c: c + 32 for c in range(65, 91)}) for m in re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", text)]
        counts[lang, source].update(terms)
        docs[lang].update(set(terms))
    out = []
    for lang in {r[0] for r in rows}:
        kept = [t for t, n in docs[lang].items() if n >= min_docs]
        sources = {r[1] for r in rows if r[0] == lang}
        whole = Counter()
        for s in sources:
            whole.update({t: counts[lang, s][t] for t in kept})
        shares = lambda c: {t: 1 + 10**9 * (c[t] + 1) // (sum(c[u] for u in kept) + len(kept)) for t in kept}
        p, q = {s: shares(counts[lang, s]) for s in sources}, shares(whole)
        for s in sources:
            pair = [(o, sum((p[s][t] - p[o][t]) ** 2 // p[o][t] for t in kept)) for o in sources - {s}]
            term = [(t, (p[s][t] - q[t]) ** 2 // q[t]) for t in kept if counts[lang, s][t] and p[s][t] > q[t]]
            for part, found in (("pair", pair), ("term", term)):
                found.sort(key=lambda x: (-x[1], x[0].encode()))
                out += [(lang, s, part, i, v, k) for k, (i, v) in enumerate(found, 1) if part == "pair" or k <= top]
    return sorted(out)


def test_divergence(spark):
    rng = random.Random(5)
    word = lambda: rng.choice(["a", "B", "b", "é", "É", "straße", "日本", "zz", *[f"w{chr(97 + i)}" for i in range(20)]])
    rows = [(rng.choice(["en", "de", None]), rng.choice(["s1", "s2", "s3", "é", None, ""]), " ".join(word() for _ in range(rng.randrange(12))) + "\0x1y") for _ in range(120)]
    rows += [("en", "hot", "the " * 5000 + "b")] * 40 + [("fr", "one", None), ("fr", "two", ""), ("fr", "two", "seul")]
    df = spark.createDataFrame(rows, "lang string, source string, text string").withColumns({"term": F.lit("x"), "m": F.lit(1), "rank": F.lit(0)})
    for top in (3, 200):
        got = sorted(tuple(r) for r in divergence.source_divergence(df.repartition(5), top=top).collect())
        assert got == plain_divergence(rows, 3, top)
    assert divergence.source_divergence(df.limit(0)).count() == 0


def test_histograms_count_every_term_once(spark):
    rows = [("l", s, t) for s in ("a", "b", "c") for t in ("x y", "x", "x z", "z z")] + [("l", "d", "nothing")]
    kept = divergence.term_counts(spark.createDataFrame(rows, "lang string, source string, text string"))
    groups = spark.createDataFrame([("l", s, 0, t, 3) for s, t in (("a", 3), ("b", 3), ("c", 3), ("d", 0))], "lang string, source string, n long, terms long, v long")
    cells = divergence.joint_histograms(kept, groups).collect()
    by = defaultdict(list)
    for r in cells:
        by[r.a, r.b].append((r.x, r.y, r.m))
    assert len(by) == 6 and all(sum(m for *_, m in c) == 3 for c in by.values())
    assert sorted(by["a", "b"]) == [(1, 1, 1), (3, 3, 2)] and sorted(by["a", "d"]) == [(1, 0, 1), (3, 0, 2)]


def test_pairs_of_wide_rows_come_in_blocks(monkeypatch):
    monkeypatch.setattr(divergence, "PAIR_BLOCK", 40)
    source, count = np.arange(30).reshape(2, 15), np.arange(100, 130).reshape(2, 15)
    got = sorted(p for block in divergence._pairs(15, source, count) for p in zip(*(c.tolist() for c in block), strict=True))
    assert got == sorted((a, b, a + 100, b + 100) for row in source.tolist() for i, a in enumerate(row) for b in row[i + 1 :])


def test_terms_of_sliced_batches():
    texts = pa.array(["aB c", None, "", "É1é", "ab"])
    terms, doc = divergence.term_array(texts.slice(1))
    assert (terms.to_pylist(), doc.tolist()) == (["É", "é", "ab"], [2, 2, 3])


# ---------------------------------------------------------------- 12


def test_frames_read_back():
    rng = np.random.default_rng(1)
    c = rng.integers(-1023, 1024, (30, 12, 64))
    c[rng.random(c.shape) < 0.9] = 0
    c[3], c[4, :, 63], c[:, :, 0] = 0, 5, rng.integers(-500, 500, (30, 12))
    head = mjpeg.frame_header(16, 16)
    frames = [head + d + b"\xff\xd9" for d in mjpeg.encode_frames(c)]
    for size in (1, 7, 30):
        for i in range(0, 30, size):
            assert all((f == c[i + k]).all() for k, (_, f) in enumerate(mjpeg.decode_frames(frames[i : i + size])))


def test_restarts_sampling_and_own_tables():
    rng = np.random.default_rng(2)
    c = rng.integers(-100, 100, (5, 3, 64))  # five units, each an interval of its own
    parts = mjpeg.encode_frames(c)
    data = b"".join(p + b"\xff" + bytes([0xD0 + i]) for i, p in enumerate(parts[:-1])) + parts[-1]
    head = mjpeg.frame_header(40, 8)
    head = head[:-14] + b"\xff\xdd\x00\x04\x00\x01" + head[-14:]
    ((layout, got),) = mjpeg.decode_frames([head + data + b"\xff\xd9"])
    assert (layout.restart, layout.units) == (1, 5) and (got == c.reshape(15, 64)).all()
    # One component, with a table that gives every used symbol six bits.
    symbols = bytes(range(12))
    dc = b"\xff\xc4" + struct.pack(">HB16B", 19 + 12, 0, *[0] * 5, 12, *[0] * 10) + symbols
    ac = b"\xff\xc4" + struct.pack(">HB16B", 19 + 2, 16, 0, 2, *[0] * 14) + bytes([0, 1])
    head = b"\xff\xd8" + dc + ac + b"\xff\xdb\x00\x43\x00" + b"\x02" * 64 + b"\xff\xc0" + struct.pack(">HBHHB", 11, 8, 8, 8, 1) + b"\1\x11\0"
    head += b"\xff\xda" + struct.pack(">HB", 8, 1) + b"\1\0\0\x3f\0"
    bits = "000011" + "101" + "01" + "0" + "00"  # first coefficient 5, next -1, end
    data = int(bits.ljust(16, "1"), 2).to_bytes(2, "big")
    ((layout, got),) = mjpeg.decode_frames([head + data + b"\xff\xd9"])
    assert got[0, :3].tolist() == [5, -1, 0] and layout.quantisers == ((2,) * 64,)


def test_inverse_transform():
    rng = np.random.default_rng(3)
    c = rng.integers(-60, 60, (20, 64))
    flat = np.zeros((20, 64))
    flat[:, mjpeg.zigzag()] = c
    x = np.arange(8)
    basis = np.array([np.cos((2 * x + 1) * k * np.pi / 16) * (np.sqrt(1 / 8) if k == 0 else 0.5) for k in range(8)])
    plain = np.clip(np.einsum("nkl,kx,ly->nxy", flat.reshape(20, 8, 8), basis, basis).reshape(20, 64) + 128, 0, 255)
    assert np.abs(mjpeg.samples(c) - plain).max() < 0.6
    assert (mjpeg.samples(c)[:3] == mjpeg.samples(c[:3])).all()
    assert mjpeg.zigzag()[:10].tolist() == [0, 1, 8, 16, 9, 2, 3, 10, 17, 24]


def test_media_columns(spark, monkeypatch):
    long_text = "Große Wörter 日本 " * 20000
    rows = [(1, "short"), (2, None), (3, ""), (None, "x" * 192), (1, "short"), (5, long_text), (6, "a\0\x80b"), (7, long_text)]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("media", F.lit("clash"))
    got = sorted((tuple(r) for r in media.digests(media.store(df)).collect()), key=str)
    expected = []
    for i, text in rows:
        raw = (text or "").encode()
        stored = raw + b" " * (-len(raw) % 192 if raw else 192)
        (file,) = media.movies([raw])
        expected.append((i, len(raw), len(stored), hashlib.sha256(stored).hexdigest(), zlib.crc32(stored[-16:]), len(file), hashlib.sha256(file).hexdigest()))
    assert [g[:7] for g in got] == sorted(expected, key=str)
    assert len({g[7] for g in got if g[1] == len(long_text.encode())}) == 1
    assert media.digests(media.store(df.limit(0))).count() == 0 == media.clips(media.store(df).limit(0)).count()
    with pytest.raises(mjpeg.FormatError):
        media.Films([b"RIFF\0\0\0\0WAVE"], False)


def test_clips_part_where_pictures_change(spark):
    rng = np.random.default_rng(4)
    dark, light = (np.zeros((12, 64), int) for _ in range(2))
    dark[:, 0], light[:, 0] = -600, 600
    shots = [dark] * 10 + [light] * 7 + [dark] * 3
    frames = np.stack([s + np.where(np.arange(64) == 9, rng.integers(-3, 4), 0) for s in shots])
    head = mjpeg.frame_header(16, 16)
    file = mjpeg.write_avi([head + d + b"\xff\xd9" for d in mjpeg.encode_frames(frames)], 16, 16, 40_000, b"")
    unindexed = file[: file.rfind(b"idx1")]
    assert mjpeg.read_avi(file).places == mjpeg.read_avi(unindexed).places
    df = spark.createDataFrame([(1, bytearray(file)), (2, None), (3, bytearray(unindexed))], "doc_id long, media binary")
    got = [tuple(r)[:6] for r in media.clips(df).orderBy("doc_id", "clip").collect()]
    assert got == [(i, *c) for i in (1, 3) for c in ((0, 0, 9, 0, 400), (1, 10, 16, 400, 680), (2, 17, 19, 680, 800))]


# ---------------------------------------------------------------- 13


def test_whitening(spark):
    rng = np.random.default_rng(6)
    base = rng.normal(size=(300, 24)) @ rng.normal(size=(24, 24)) + 3
    rows = [(i, v.tolist()) for i, v in enumerate(base)] + [(1000 + i, base[7].tolist()) for i in range(200)] + [(3, base[3].tolist())]
    bad = [(9001, None), (9002, [None] * 24), (9003, [float("nan")] * 24), (9004, [float("inf")] * 24), (9005, [])]
    short = [(7000 + i, rng.normal(size=3).tolist()) for i in range(50)] + [(None, [1.0])]
    df = spark.createDataFrame(rows + bad + short, "vec_id long, embedding array<double>").withColumns({"n": F.lit("x"), "dims": F.lit(1)}).repartition(7)
    got = whitening.whiten(df).collect()
    assert len(got) == 501 * 16 + 50 * 3
    assert len({r.identity_error for r in got}) == 1 and got[0].identity_error < 1e-9
    for own in (rows, short[:50]):
        x = np.floor(64 * np.array([v for _, v in own])).astype(np.int64) + 1_000_000
        fit = np.unique(x, axis=0)
        n, s = len(fit), fit.sum(axis=0)
        e, u = np.linalg.eigh((fit - s / n).T @ (fit - s / n) / n)
        by = defaultdict(list)
        ids = {i for i, _ in own}
        for r in got:
            if r.vec_id in ids:
                by[r.component].append(r)
        for c in range(1, min(16, x.shape[1]) + 1):
            plain = sorted((i, d, w) for (i, _), d, w in zip(own, ((n * x - s) ** 2).sum(axis=1).tolist(), ((x - s / n) @ u[:, -c] / np.sqrt(e[-c])).tolist(), strict=True))
            mine = sorted((r.vec_id, r.deviation, r.whitened) for r in by[c])
            assert [m[:2] for m in mine] == [p[:2] for p in plain] and {r.n for r in by[c]} == {n}
            a, b = np.array([m[2] for m in mine]), np.array([p[2] for p in plain])
            assert min(np.abs(a - b).max(), np.abs(a + b).max()) < 1e-6
            assert abs(by[c][0].explained / (e[-c] / e.sum()) - 1) < 1e-9
    assert whitening.whiten(df.limit(0)).count() == 0


def test_merging_summaries_loses_nothing():
    rng = np.random.default_rng(7)
    x = rng.integers(-50, 50, (400, 6)) + 1_000_000_000_000
    x[:, 5] = x[:, 4]  # a dimension without variance of its own
    parts = [whitening.Summary.of(p) for p in np.array_split(x, 150)]  # fewer rows than dimensions each
    while len(parts) > 1:
        parts = [parts[i].merged(parts[i + 1]) if i + 1 < len(parts) else parts[i] for i in range(0, len(parts), 2)]
    whole = whitening.Summary.unpack(**parts[0].pack())
    assert (whole.n, whole.sums) == (400, [int(c) for c in x.astype(object).sum(axis=0)])
    centred = (x - x[0]).astype(float)
    centred -= centred.mean(axis=0)
    assert np.allclose(whole.vectors.T * whole.values**2 @ whole.vectors, centred.T @ centred, rtol=1e-9, atol=1e-6)
    assert len(whitening.Whitener.of(whole, 16).roots) == 5


def test_deviation_beyond_a_long_is_null():
    w = whitening.Whitener(1 << 40, [0, 0], np.eye(2), np.ones(2), np.ones(2))
    assert w.deviation(np.array([[1, 0], [0, 2], [1 << 20, 0]])) == [None, None, None]
    w = whitening.Whitener(1 << 30, [1, -1], np.eye(2), np.ones(2), np.ones(2))
    assert w.deviation(np.array([[1, 0], [2, 1], [50, 0]])) == [((1 << 30) - 1) ** 2 + 1, ((1 << 31) - 1) ** 2 + ((1 << 30) + 1) ** 2, None]
