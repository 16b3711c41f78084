"""The ten operators against brute force on small tables, with nulls, blanks, ties and repeated rows."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from shelfspark.llm import bpe, chat, decontaminate, licences, lm, neardup, suffixdedup, suffixes, topk, toxicity, warc

LOWER = {c: c + 32 for c in range(65, 91)}


def docs(spark, rows):
    """Documents with an extra column whose name operators use inside."""
    return spark.createDataFrame(rows, "doc_id long, text string").withColumns({"rep": F.lit(1), "n": F.lit("x"), "score": F.lit(0.0)})


def sha(b: bytes) -> str:
    return hashlib.sha256(b).hexdigest()


# ---------------------------------------------------------------- 1


def test_chat_reads_back_exactly(spark):
    rng = random.Random(3)
    piece = lambda: "".join(rng.choice(["</s>", "<s>", "[INST]", "\\l", "\\", "<+>", "]", "é", "a", "\n", ""]) for _ in range(5))
    rows = [(c, i, rng.choice(["user", "assistant", None, "a]b<"]), rng.choice([piece(), None])) for c in range(6) for i in range(300 if c == 0 else 7)]
    done = chat.format_chat(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string"))
    f, s = F.col("formatted"), F.col("loss_spans")
    got = {r[0]: r for r in done.select("conv_id", chat.parse_chat(f).alias("t"), chat.loss_text(f, s).alias("l"), f).collect()}
    for c in range(6):
        turns = [(r or "", t or "") for k, _, r, t in rows if k == c]
        assert [tuple(x) for x in got[c].t] == turns
        assert got[c].l == "".join(t for r, t in turns if r == "assistant")
        assert got[c].formatted.count("</s>") == sum(1 for i, x in enumerate(turns) if i == 0 or turns[i - 1][0] != x[0])


def test_chat_of_nothing(spark):
    assert chat.format_chat(spark.createDataFrame([], "conv_id long, turn long, role string, text string")).count() == 0


# ---------------------------------------------------------------- 2


def test_licences(spark):
    rows = [(1, "x UNDER the MIT license, Apache License: version 2 cc-by-NC under the mit license"), (2, None), (3, ""), (3, ""), (4, licences.TEMPLATES["bsd"][0]), (5, "under the mit " * 4000)]
    got = [r.asDict() for r in licences.scan_licences(docs(spark, rows)).orderBy("doc_id").collect()]
    assert (got[0]["n_base"], got[0]["first_word"], got[0]["last_word"], got[0]["base_labels"]) == (4, 1, 12, "apache-2,cc-by-nc,mit")
    assert [(g["n_words"], g["n_base"], g["first_word"], g["labels"], g["score"]) for g in got[1:4]] == [(0, 0, None, "", 0.0)] * 3
    assert got[4]["labels"] == "bsd" and got[4]["score"] == 1.0 and got[4]["base_labels"] == ""
    assert (got[5]["n_words"], got[5]["n_base"]) == (12000, 0)
    assert licences.scan_licences(docs(spark, rows).limit(0)).count() == 0


def test_matching_statistics_are_the_longest_matches():
    rng = random.Random(1)
    for _ in range(60):
        templates = [[rng.randint(1, 3) for _ in range(rng.randint(1, 8))] for _ in range(3)]
        query = [rng.randint(1, 4) for _ in range(20)]
        inside = {tuple(t[i:j]) for t in templates for i in range(len(t)) for j in range(i, len(t) + 1)}
        for i, (_, n) in enumerate(licences.SuffixAutomaton(templates).stream(query)):
            assert n == max(k for k in range(i + 2) if tuple(query[i + 1 - k : i + 1]) in inside)


# ---------------------------------------------------------------- 3


def test_toxicity_learns_from_its_fold_and_keeps_clean_documents(spark):
    rng = random.Random(5)
    words = [a + b for a in ("ba", "ke", "lo", "mi", "nu") for b in ("ra", "se", "ti", "po", "zu")]
    rows, labels = [], []
    for i in range(600):
        bad = i % 6 == 0
        rows.append((i, " ".join(rng.choices(words, k=30) + ([f"grobnak{rng.choice(words)}" for _ in range(3)] if bad else []))))
        labels.append((i, int(bad)))
    rows += [(1000, None), (1001, ""), (None, "grobnakra"), (5, rows[5][1])]
    table = spark.createDataFrame([*labels, (None, 1), (1, None)], "doc_id long, toxic int")
    got = toxicity.toxicity_scores(docs(spark, rows), table).collect()
    assert len(got) == len(rows) and all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) for r in got)
    held = [r for r in got if r.held_out and r.doc_id < 600]
    assert held and all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in got if r.doc_id is not None)
    assert all(r.predicted == int(r.doc_id % 6 == 0) for r in held)
    kept = {r.doc_id for r in toxicity.drop_toxic(docs(spark, rows), table).collect()}
    assert {1000, 1001, None} <= kept and not any(i is not None and i < 600 and i % 6 == 0 for i in kept)


def test_toxicity_without_labels(spark):
    got = toxicity.toxicity_scores(docs(spark, [(1, "you idiot"), (2, "fine")]), spark.createDataFrame([], "doc_id long, toxic int")).orderBy("doc_id").collect()
    assert got[0].score > got[1].score


# ---------------------------------------------------------------- 4


def test_warc_round_trip(spark):
    big = "WARC/1.1\r\nContent-Length: 3\r\n\r\n" + "é" * 900
    rows = [(1, "http://b.example.com/x", big), (2, "http://a.example.com/", big), (3, None, None), (4, "http://www.a.example.com:80/q?x#f", "a\r\n\r\nb\n"), (4, "u", "small"), (5, "u", "small")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("payload", F.lit(1))
    got = warc.capture_index(pages).orderBy("part", "part_pos").collect()
    by = {(r.page_id, r.payload_bytes): r for r in got}
    assert len(got) == len(rows)
    for i, _, html in rows:
        raw = (html or "").encode()
        r = by[i, len(raw)]
        assert r.payload_digest == hashlib.sha1(raw).hexdigest()
        assert (r.record_type, r.refers_to) == (("revisit", 2) if i == 1 else ("response", None))
    keys = [(r.url_key, r.captured, r.page_id) for r in got]
    assert keys == sorted(keys)
    assert warc.capture_index(pages.limit(0)).count() == 0


def test_loser_tree_merges(spark):
    rng = random.Random(8)
    for k in range(0, 9):
        runs = [sorted((rng.randint(0, 9), r) for _ in range(rng.randint(0, 6))) for r in range(k)]
        got = list(warc.LoserTree([[(x, (r, i)) for i, (x, _) in enumerate(run)] for r, run in enumerate(runs)]))
        assert [g[0] for g in got] == sorted(x for run in runs for x, _ in run)
        assert len({g[1] for g in got}) == len(got)


# ---------------------------------------------------------------- 5


@pytest.fixture(scope="module")
def tokenizer():
    import public_tokenizers
    from tokenizers import Tokenizer

    path = public_tokenizers.path("word_bpe_49k.json")
    return path, Tokenizer.from_file(path)


def test_bpe_equals_the_library(spark, tokenizer):
    path, library = tokenizer
    rng = random.Random(2)
    texts = ["", None, "Hello, WORLD's 'tis 12³ naïve café", "<|endoftext|> x<|startoftext|>", "Σας ΟΔΟΣ", "日本語 😀👨‍👩‍👧", "a\x1cb\x85c\x00 \x7f", "x" * 3000, "é ﬁ İ"]
    texts += ["".join(rng.choice("abeinthrs'.,! é") for _ in range(120)) for _ in range(60)]
    texts += ["".join(chr(c) for c in range(a, a + 48) if not 0xD800 <= c < 0xE000) for a in range(0, 0x3100, 48)]
    got = {r.doc_id: r for r in bpe.encode(docs(spark, list(enumerate(texts))), path).collect()}
    digests = {r.doc_id: r for r in bpe.digests(bpe.encode(docs(spark, list(enumerate(texts))), path)).collect()}
    for i, t in enumerate(texts):
        ids = library.encode(t or "", add_special_tokens=False).ids
        text = library.decode(ids, skip_special_tokens=False)
        assert list(got[i].ids) == ids and got[i].decoded == text
        assert (digests[i].n_tokens, digests[i].ids_sha256, digests[i].decoded_sha256) == (len(ids), sha(" ".join(map(str, ids)).encode()), sha(text.encode()))


# ---------------------------------------------------------------- 6


def _removed(rows, length=100):
    seen, out = set(), {}
    for i, t in sorted(rows):
        raw = (t or "").encode()
        gone = bytearray(len(raw))
        for p in range(len(raw) - length + 1):
            if raw[p : p + length] in seen:
                gone[p : p + length] = b"\1" * length
            seen.add(raw[p : p + length])
        runs = sum(1 for k, g in enumerate(gone) if g and (k == 0 or not gone[k - 1]))
        out[i] = (len(raw), sum(gone), runs, sha(bytes(x for x, g in zip(raw, gone, strict=True) if not g)))
    return out


def test_suffix_dedup_is_exact(spark):
    rng = random.Random(5)
    base = "".join(rng.choice("abcdé ") for _ in range(700))
    rows = [(i, "".join(base[a : a + rng.randint(0, 300)] + rng.choice(["", "x", "é"]) for a in rng.choices(range(600), k=rng.randint(0, 6)))) for i in range(60)]
    rows += [(100, "a" * 1000), (101, "ab" * 300 + "a" * 400), (102, "mit " * 500), (103, None), (104, "a" * 99), (105, rows[7][1])]
    got = {r[0]: tuple(r)[1:] for r in suffixdedup.digests(suffixdedup.remove_repeats(spark.createDataFrame(rows, "doc_id long, text string"))).collect()}
    assert got == _removed(rows)


def test_suffix_array_is_sorted():
    rng = random.Random(3)
    for _ in range(80):
        s = [rng.randint(1, rng.choice([2, 3, 9])) for _ in range(rng.randint(1, 90))] + [0]
        assert suffixes.suffix_array(np.array(s, np.uint16), 10, memory=rng.choice([40, 1 << 20])).tolist() == sorted(range(len(s)), key=lambda i: s[i:])  # noqa: B023


def test_dropping_repeats_keeps_columns(spark):
    table = docs(spark, [(1, "é" * 200), (2, "ü" + "é" * 200), (3, None), (None, "é" * 200)]).withColumn("n_chars", F.lit(1).cast("long"))
    got = {r.doc_id: r for r in suffixdedup.drop_repeats(table).collect()}
    assert suffixdedup.drop_repeats(table).columns == table.columns and len(got) == 4
    assert got[2].text == "ü" and got[3].text is None and len(got[None].text) == 200


# ---------------------------------------------------------------- 7


def _classes(rows):
    sets = {}
    for i, t in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", (t or "").translate(LOWER))
        sets[i] = {tuple(w[k : k + 5]) for k in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set()
    parent = {i: i for i in sets}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in sets:
        for b in sets:
            if a < b and sets[a] and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b]):
                x, y = root(a), root(b)
                parent[max(x, y)] = min(x, y)
    return {i: (len(sets[i]), root(i), root(i) == i) for i in sets}


def test_near_duplicates_equal_brute_force(spark, monkeypatch):
    monkeypatch.setattr(neardup, "BLOCK", 16)
    monkeypatch.setattr(neardup, "PER_CENTRE", 8)
    rng = random.Random(11)
    base = [rng.choice("abcdefgh") * rng.randint(1, 4) + str(rng.randint(0, 50)) for _ in range(120)]
    rows = []
    for i in range(150):  # a chain of drifting copies: many links, few with any one centre
        w = list(base)
        for _ in range(rng.randint(0, 9)):
            w[rng.randrange(len(w))] = f"z{rng.randint(0, 9)}"
        rows.append((i, " ".join(w)))
    rows += [(200, None), (201, " \n"), (202, "one two"), (203, "ONE\ttwo"), (204, "one"), (205, rows[3][1]), (206, "")]
    got = {r.doc_id: tuple(r)[1:] for r in neardup.near_duplicates(docs(spark, rows)).collect()}
    assert got == _classes(rows)
    kept = sorted(r.doc_id for r in neardup.keep_representatives(docs(spark, rows)).collect())
    assert kept == sorted(i for i, v in _classes(rows).items() if v[2])


def test_sketches_fill_and_concentrate():
    rng = np.random.default_rng(1)
    for n in (1, 2, 5, 50, 3000):
        a = rng.integers(0, 1 << 63, n).astype(np.uint64)
        b = np.concatenate([a[: max(1, n * 3 // 4)], rng.integers(0, 1 << 63, n - max(1, n * 3 // 4)).astype(np.uint64)])
        s = neardup.sketch(np.concatenate([a, b]), np.array([0, n, 2 * n]))
        assert (s != neardup._UNFILLED).all()
        true = len(set(a) & set(b)) / len(set(a) | set(b))
        assert abs((s[0] == s[1]).mean() - true) < 0.25


# ---------------------------------------------------------------- 8


def test_language_model_base_and_gain(spark):
    rng = random.Random(7)
    words = {"x": ["the", "of", "and", "to"], "y": ["der", "die", "und", "zu"]}
    rows = [(i, " ".join(rng.choice(words["x" if i % 2 else "y"]) if rng.random() < 0.8 else f"w{rng.randint(0, 40)}" for _ in range(60))) for i in range(300)]
    rows += [(400, None), (401, ""), (402, "never seen words"), (7, rows[7][1])]
    got = lm.score_texts(docs(spark, rows), trainers=2).collect()
    assert len(got) == len(rows)
    tokens = lambda t: re.findall(r"[^\x20\x09-\x0D]+", (t or "").translate(LOWER)) + [None]
    count = Counter(w for i, t in rows if zlib.crc32(str(i).encode()) % 5 != 1 for w in tokens(t))
    n, v = sum(count.values()), len(count)
    by = dict(rows)
    for r in got:
        own = tokens(by[r.doc_id])
        base = sum(math.log10((count[w] + 0.5) / (n + 0.5 * (v + 1))) for w in own)
        assert (r.n_tokens, r.n_known, r.train_tokens) == (len(own), sum(count[w] > 0 for w in own), n)
        assert r.base_score == pytest.approx(base, rel=1e-9) and r.score < 0
    held = [r for r in got if r.held_out and r.doc_id < 400]
    assert held and sum(r.score for r in held) > sum(r.base_score for r in held)


# ---------------------------------------------------------------- 9


def test_top_k_is_exact(spark):
    rng = np.random.default_rng(4)
    rows = [(int(i), [float(x) for x in rng.normal(size=12)]) for i in range(700)]
    rows += [(1000 + i, [0.5] * 12) for i in range(40)] + [(2000, None), (2001, [1.0] * 11 + [float("nan")]), (2002, [None] * 12), (2100, [float("inf")] * 12), (None, [1.0] * 12), (300, [9.0] * 12)]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumn("x", F.lit(1))
    got = sorted(tuple(r) for r in topk.exact_top_k(table).collect())
    clean = {}
    for i, e in rows:
        if i is not None and e is not None and all(x is not None and math.isfinite(x) for x in e):
            z = [math.floor(1024 * x) for x in e]
            clean[i] = min(z, clean.get(i, z))
    expected = []
    for q in [i for i in clean if i % 100 == 0]:
        best = sorted((-sum(a * b for a, b in zip(clean[q], c, strict=True)), i) for i, c in clean.items() if i != q)[:10]
        expected += [(q, k + 1, i, -s) for k, (s, i) in enumerate(best)]
    assert got == sorted(expected)


def test_top_k_of_few(spark):
    table = spark.createDataFrame([(0, [1.0, 2.0]), (1, [0.0, 1.0])], "vec_id long, embedding array<double>")
    assert [tuple(r) for r in topk.exact_top_k(table).collect()] == [(0, 1, 1, 2048 * 1024)]
    assert topk.exact_top_k(table.limit(0)).count() == 0


# ---------------------------------------------------------------- 10


def test_decontamination(spark):
    item = "If Alice has 12 apples and gives Bob 3 kg then Alice has how many apples left today?"
    rows = [
        (1, "Intro words. " + item + " Outro."),
        (2, "zz " + item.replace("Alice", "Carla").replace("Bob", "Dan").replace("12", "15").replace("3 kg", "7 lb")),
        (3, "zz " + item.replace("Alice", "Carla", 1)),
        (4, None), (5, ""), (6, "If Alice has 12 apples then nothing else here follows at all"), (1, "repeated id, clean text"), (None, item),
    ]
    bench = spark.createDataFrame([(7, item), (8, None), (9, ""), (10, "short one"), (None, item)], "item_id long, text string")
    got = {(r.doc_id, r.item_id): r for r in decontaminate.contamination(docs(spark, rows), bench).collect()}
    assert set(got) == {(1, 7), (2, 7)}
    assert (got[1, 7].kind, got[1, 7].containment, got[2, 7].kind) == ("verbatim", 1.0, "reparameterised")
    kept = decontaminate.drop_contaminated(docs(spark, rows), bench)
    assert kept.columns == docs(spark, rows).columns and sorted(str(r.doc_id) for r in kept.collect()) == ["3", "4", "5", "6", "None"]
    assert decontaminate.contamination(docs(spark, rows).limit(0), bench).count() == 0
    assert decontaminate.contamination(docs(spark, rows), bench.limit(0)).count() == 0


def test_decontamination_whatever_the_letter_case(spark):
    item = "If Alice has 12 apples and gives Bob 3 kg then Alice has how many apples left today?"
    rows = [
        (1, "INTRO WORDS. " + item.upper()), (2, item.lower()), (3, item.title()), (4, item), (5, "zz " + item.replace("Alice", "Carla", 1)),
        (6, item.upper().replace("12", "15")), (7, item.upper()[:30]),
    ]
    bench = spark.createDataFrame([(7, item)], "item_id long, text string")
    got = {r.doc_id: (r.containment, r.kind) for r in decontaminate.contamination(docs(spark, rows), bench).collect()}
    assert got == dict.fromkeys((1, 2, 3, 4), (1.0, "verbatim")) | {6: (1.0, "reparameterised")}


def test_decontamination_finds_a_copy_beside_an_inconsistent_one(spark):
    item = "If Alice has 12 apples and gives Bob 3 kg then Alice has how many apples left today?"
    other = item.replace("Alice", "Carla", 1)
    rows = [(1, f"{other} {item}"), (2, f"{item} {other}"), (3, f"{other} {other}"), (4, f"{other} {item[:-12]}")]
    bench = spark.createDataFrame([(7, item)], "item_id long, text string")
    got = {r.doc_id: r.kind for r in decontaminate.contamination(docs(spark, rows), bench).collect()}
    assert got == dict.fromkeys((1, 2, 4), "verbatim")


def test_decontamination_finds_short_items_inside_documents(spark):
    rows = [(1, "He asked: what is 2+2? Nobody knew the answer."), (2, "What is 2+2?"), (3, "what is this, 2 and 2"), (4, "so, what is 3+3 then, and what is 3+4")]
    bench = spark.createDataFrame([(7, "What is 2+2?"), (8, "short one")], "item_id long, text string")
    got = {r.doc_id: (r.item_id, r.kind) for r in decontaminate.contamination(docs(spark, rows), bench).collect()}
    assert got == {1: (7, "verbatim"), 2: (7, "verbatim"), 4: (7, "reparameterised")}


def test_suffix_dedup_takes_one_text_of_a_repeated_id(spark):
    a, b = ("".join(random.Random(k).choices("abcdefgh ", k=300)) for k in (1, 2))
    rows = [(1, a), (1, a), (2, min(a, b)), (2, max(a, b)), (3, b), (4, None), (4, b), (None, a)]
    got = suffixdedup.remove_repeats(docs(spark, rows)).collect()
    first = {1: a, 2: min(a, b), 3: b, 4: b}
    seen, spans = [], {}
    for i, t in first.items():
        spans[i] = t in seen
        seen.append(t)
    expected = [(i, "" if spans.get(i) and t == first[i] else t or "") for i, t in rows]
    assert sorted((str(r.doc_id), r.kept.decode()) for r in got) == sorted((str(i), t) for i, t in expected)


def test_near_duplicates_of_repeated_ids(spark):
    a, b, c = (" ".join(random.Random(k).choices("abcdefghijk", k=60)) for k in (1, 2, 3))
    rows = [(1, min(a, b)), (2, min(a, b)), (2, max(a, b)), (3, max(a, b)), (4, c), (4, c), (5, None), (5, c), (None, c), (6, None), (6, "")]
    got = sorted((str(r.doc_id), r.component_id, r.kept) for r in neardup.near_duplicates(docs(spark, rows)).collect())
    classes = {1: 1, 2: 1, 3: 3, 4: 4, 5: 4, 6: 6, None: None}
    assert got == sorted((str(i), classes[i], classes[i] == i) for i, _ in rows)
    assert neardup.near_duplicates(docs(spark, rows).limit(0)).count() == 0
    kept = neardup.keep_representatives(docs(spark, rows))
    assert kept.columns == docs(spark, rows).columns and len(kept.collect()) == 1 + 1 + 2 + 1 + 2


def test_near_duplicates_recall_is_measured(spark):
    """Planted pairs just above the threshold: banding finds them, pairs just below stay apart."""
    rng = random.Random(9)
    rows, above = [], set()
    for k in range(300):
        words = [f"w{rng.randint(0, 10**6)}" for _ in range(200)]
        # A changed word takes five shingles of 196: five changes leave 171 of 221 (0.774), seven leave 161 of 231 (0.697).
        changes = 5 if k % 2 else 7
        other = list(words)
        for at in range(10, 10 + 25 * changes, 25):
            other[at] = "changed"
        rows += [(2 * k, " ".join(words)), (2 * k + 1, " ".join(other))]
        if k % 2:
            above.add(2 * k + 1)
    got = {r.doc_id for r in neardup.near_duplicates(docs(spark, rows)).where("NOT kept").collect()}
    assert got == above


def test_top_k_skips_postings_of_skewed_vectors():
    rng = np.random.default_rng(3)
    x = np.floor(rng.standard_t(1.2, size=(5000, 32)) * 100).astype(np.int64)
    index = topk.ImpactIndex(np.arange(5000), x)
    queries = x[::100]
    found = index.search(queries, np.arange(0, 5000, 100), 10)
    assert index.touched < 0.25 * len(queries) * x.size
    for q, (ids, scores) in zip(range(0, 5000, 100), found, strict=True):
        every = x @ x[q]
        expected = sorted((-int(s), i) for i, s in enumerate(every) if i != q)[:10]
        assert [(-int(s), int(i)) for i, s in zip(ids, scores, strict=True)] == expected


def test_top_k_with_unlike_lengths(spark):
    rows = [(0, [1.0]), (100, []), (1, [2.0]), (2, []), (3, [1.0, 2.0]), (200, [1.0, 1.0])]
    got = sorted(tuple(r) for r in topk.exact_top_k(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect())
    assert got == [(0, 1, 1, 2 << 20), (100, 1, 2, 0), (200, 1, 3, 3 << 20)]


def test_warc_keeps_large_and_null_ids(spark):
    big, first = "x" * 1500, 9007199254740993
    rows = [(first, "u/a", big), (first + 2, "u/a", big), (None, "u/b", big), (7, None, ""), (7, None, ""), (8, "http://h/" + "p" * 5000, "é" * 300_000)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").withColumns({"run": F.lit(1), "part": F.lit("x")}).coalesce(1)
    index = warc.capture_index(pages)
    got = sorted((str(r.page_id), r.payload_bytes, r.record_type, r.refers_to) for r in index.collect())
    expected = [(first, 1500, "revisit", first + 2), (first + 2, 1500, "response", None), (None, 1500, "revisit", first + 2), (7, 0, "response", None), (7, 0, "response", None), (8, 600_000, "response", None)]
    assert got == sorted((str(i), *rest) for i, *rest in expected)


def test_warc_merges_runs_over_ranges(spark, monkeypatch):
    monkeypatch.setattr(warc, "RANGE_CAPTURES", 150)
    rng = random.Random(4)
    rows = [(i if rng.random() < 0.9 else None, f"http://{rng.choice('aab')}.example.com/{rng.randint(0, 9)}", "x" * rng.randint(0, 3)) for i in range(1500)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(5)
    index = warc.capture_index(pages)
    got = index.orderBy("part", "part_pos").collect()
    keys = [(r.url_key, r.captured, r.page_id is not None, r.page_id or 0) for r in got]
    assert len(got) == 1500 and keys == sorted(keys)
    parts = Counter(r.part for r in got)
    assert len(parts) > 5 and max(parts.values()) < 400 and all(r.part_pos < parts[r.part] for r in got)


def test_licence_phrases_equal_a_plain_search(spark):
    rng = random.Random(12)
    words = "under the mit license apache version 2 cc by nc x".split()
    rows = [(i, "".join(rng.choice(words).upper() if rng.random() < 0.2 else rng.choice(words) for _ in range(1)) + "".join(
        rng.choice([" ", ", ", "-", " é "]) + rng.choice(words + list(licences.PHRASES)) for _ in range(rng.randint(0, 60)))) for i in range(200)]
    rows += [(1000, "cc by nc " * 30_000)]
    got = {r.doc_id: r for r in licences.scan_licences(docs(spark, rows)).collect()}
    for i, text in rows:
        own = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", text.translate(LOWER))
        found = [(k, label) for phrase, label in licences.PHRASES.items() for p in [phrase.split()] for k in range(len(own) - len(p) + 1) if own[k : k + len(p)] == p]
        r = got[i]
        places = [k for k, _ in found]
        assert (r.n_words, r.n_base, r.first_word, r.last_word) == (len(own), len(places), min(places, default=None), max(places, default=None))
        assert r.base_labels == ",".join(sorted({label for _, label in found})) and set(r.base_labels.split(",")) <= set(r.labels.split(",") if r.labels else [""])


def test_licence_chains_pass_stray_runs():
    scan = licences.LicenceScanner()
    text = licences.TEMPLATES["mit"][0]
    whole = licences.split_words(text)
    stray = [*whole[:30], *whole[60:65], *whole[30:]]
    spans = scan.scan(stray)["spans"]
    assert max(c for k, _, _, c in spans if scan.labels[k] == "mit") == 1.0
    assert scan.scan(whole[: len(whole) // 2])["spans"][0][3] == pytest.approx(0.5, abs=0.02)


def test_external_sort_carries_common_prefixes(monkeypatch):
    """Queues, texts and names go to scratch files, strings of names are sorted by recursion, blocks are short."""
    rng = random.Random(6)
    for _ in range(120):
        monkeypatch.setattr(suffixes, "BLOCK", rng.choice([3, 17, 1 << 16]))
        monkeypatch.setattr(suffixes.Text, "PIECE", rng.choice([5, 1 << 18]))
        s = [rng.randint(1, rng.choice([2, 3, 9])) for _ in range(rng.randint(1, 90))] + [0]
        scratch, cap = suffixes.Scratch(), rng.choice([3, 50])
        blocks = list(suffixes.suffixes(suffixes.Text(np.array(s, np.uint16)), 10, cap, scratch, rng.choice([40, 1 << 20]), rng.choice([2, 1 << 20])))
        scratch.close()
        order, common = (np.concatenate([b[i] for b in blocks]).tolist() for i in range(2))
        assert order == sorted(range(len(s)), key=lambda i: s[i:])  # noqa: B023
        for k in range(1, len(s)):
            a, b = s[order[k - 1] :], s[order[k] :]
            assert common[k] == min(cap, next((n for n, (x, y) in enumerate(zip(a, b)) if x != y), min(len(a), len(b))))


def test_repeats_of_shards_beyond_memory(monkeypatch):
    rng = random.Random(7)
    for _ in range(60):
        monkeypatch.setattr(suffixes, "BLOCK", rng.choice([17, 1 << 16]))
        base = bytes(rng.choice(b"ab") for _ in range(200))
        texts = [base[(i := rng.randint(0, 190)) : i + rng.randint(0, 60)] + bytes(rng.choice(b"abc") for _ in range(rng.randint(0, 5))) for _ in range(rng.randint(1, 12))]
        length, seen = rng.choice([8, 20]), set()
        got = suffixes.repeats(texts, length, rng.choice([200, 1 << 20]), rng.choice([4, 1 << 20]), rng.choice([30, 1 << 24]))
        for t, found in zip(texts, got, strict=True):
            expected = []
            for p in range(len(t) - length + 1):
                if t[p : p + length] in seen:
                    expected.append(p)
                seen.add(t[p : p + length])
            assert found.tolist() == expected


def test_suffix_dedup_with_clashing_names_nulls_and_nothing(spark, monkeypatch):
    monkeypatch.setattr(suffixdedup, "LOCAL_CONTEXTS", 50)
    a = "".join(random.Random(1).choices("abcdefgh ", k=400))
    rows = [(1, a), (2, "x" + a), (2, "x" + a), (None, a), (3, None), (4, "")]
    table = docs(spark, rows).withColumns({"kept": F.lit("k"), "spans": F.lit(2), "first": F.lit(3), "n_chars": F.lit(0).cast("long")})
    got = suffixdedup.drop_repeats(table)
    assert got.columns == table.columns
    assert sorted((str(r.doc_id), r.text, r.kept, r.spans, r.first) for r in got.collect()) == sorted(
        (str(i), t, "k", 2, 3) for i, t in [(1, a), (2, "x"), (2, "x"), (None, a), (3, None), (4, "")]
    )
    assert suffixdedup.remove_repeats(table).count() == 6
    assert suffixdedup.drop_repeats(table.limit(0)).count() == 0 and suffixdedup.remove_repeats(table.limit(0)).count() == 0


def test_decontamination_equals_plain_windows_on_plain_words(spark):
    """Without names, numbers or units the windows are those of the words."""
    rng = random.Random(21)
    words = [f"{a}{b}" for a in ("ba", "ke", "lo", "mi") for b in ("ra", "se", "ti")]
    items = [(i, " ".join(rng.choices(words, k=rng.randint(5, 14)))) for i in range(12)]
    rows = []
    for d in range(120):
        w = rng.choices(words, k=rng.randint(0, 25))
        if d % 3:
            own = rng.choice(items)[1].split()
            cut = own[rng.randint(0, 2) :]
            if rng.random() < 0.4:
                cut[rng.randrange(len(cut))] = "changed"
            w[rng.randint(0, len(w)) :] = cut
        rows.append((d, " ".join(w)))
    windows = lambda t: {tuple(w[k : k + 5]) for w in [t.split()] for k in range(len(w) - 4)}
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = {(r.doc_id, r.item_id): (r.n_windows, r.n_hit) for r in decontaminate.contamination(docs(spark, rows), bench).collect()}
    expected = {}
    for d, t in rows:
        for i, item in items:
            own, hit = windows(item), len(windows(item) & windows(t))
            if own and hit >= 0.75 * len(own):
                expected[d, i] = (len(own), hit)
    assert got == expected and expected


def test_decontamination_slots_both_ways_and_brief_items(spark):
    item = "If Alice has 12 apples and gives Bob 3 kg then Alice has how many apples left today with Bob?"
    both = lambda a, b: item.replace("Alice", a).replace("Bob", b)
    rows = [(1, both("Carla", "Carla")), (2, both("Carla", "Dan")), (3, item.replace("12", "3")), (4, "Short one!"), (5, "a short one here"), (6, "yes"), (7, None), (8, "short ONE")]
    bench = spark.createDataFrame([(7, item), (8, "short one"), (9, ""), (10, "Yes.")], "item_id long, text string")
    got = {(r.doc_id, r.item_id): r.kind for r in decontaminate.contamination(docs(spark, rows), bench).collect()}
    assert got == {(2, 7): "reparameterised", (3, 7): "reparameterised", (4, 8): "verbatim", (8, 8): "verbatim", (6, 10): "verbatim"}


def test_language_model_is_a_distribution():
    """Given a history, classes sum to 1, and so do the words of every class."""
    rng = np.random.default_rng(2)
    w, bias = rng.normal(size=(64, lm.CLASSES)).astype(np.float32), rng.normal(size=lm.CLASSES).astype(np.float32)
    assert np.exp(lm.log_softmax(w, bias, rng.integers(0, 64, (50, 4)))).sum(axis=1) == pytest.approx(np.ones(50), rel=1e-4)
    counts = np.sort(rng.integers(1, 1000, 500))[::-1]
    head = lm.Head.of(rng.integers(0, 1 << 62, 500).astype(np.uint64), counts)
    classes = lm._classes(head, rng.integers(0, 50, (500, lm.ANCHORS)))
    in_class = np.bincount(classes, weights=head.counts, minlength=lm.CLASSES)
    total = np.bincount(classes, weights=10 ** lm.word_logs(head, classes, in_class), minlength=lm.CLASSES)
    assert total[np.unique(classes)] == pytest.approx(np.ones(len(np.unique(classes))))
    tail = np.array([5, 1, 1, 2, 0])  # the last stands for words never seen
    assert sum((c + 0.5) / (9 + 0.5 * (4 + 1)) for c in tail) == pytest.approx(1.0)


def test_feature_rows_grow_with_the_tokens():
    rows = [lm.feature_rows(10**k) for k in range(0, 13)]
    assert rows == sorted(rows) and rows[0] == 1024 and rows[7] < rows[9] < rows[12]


def test_long_conversations_take_near_linear_time(spark):
    import time

    def took(n):
        rows = spark.range(n).selectExpr("1L AS conv_id", "id AS turn", "IF(id % 2 = 0, 'user', 'assistant') AS role", "concat('turn <', id, '> of a long talk') AS text")
        done = chat.format_chat(rows)
        start = time.perf_counter()
        got = done.select(F.length("formatted").alias("n"), F.length(chat.loss_text(F.col("formatted"), F.col("loss_spans"))).alias("l")).first()
        assert got.l == sum(len(f"turn <{i}> of a long talk") for i in range(1, n, 2))
        return time.perf_counter() - start

    took(2000)
    assert took(40_000) < 8 * took(10_000) + 2
