"""Further cases of the earlier operators: number windows, large components, ranges of queries."""

import random

import numpy as np
from pyspark.sql import functions as F

from shelfspark.llm import decontaminate, topk


def test_rows_of_numbers_are_leaks_only_with_their_values(spark):
    numbers = "2 4 8 16 32 64 128 256 512 1024"
    table = "\n".join(" ".join(str((i * 37 + j * 11) % 97) for j in range(8)) for i in range(30))
    rows = [
        (1, "Scores were 90 71 15 22 6 in that order."), (2, "The powers " + numbers + " are well known."), (3, table), (4, "1 2 3 4 5 6 7 8 9 10 11 12"), (5, numbers.replace("64", "65")),
        (6, "7 7 7 " + numbers + " 2048 4096"), (7, "On 3 May 12 13 14 15 16"), (8, "Alice Bob Carla Dan Erin Frank Gina"), (9, "x " + numbers.replace(" ", ", ")),
    ]
    bench = spark.createDataFrame([(7, numbers), (8, "Sum 13 4 25 6 17 8 9"), (9, "Anna Ben Cleo Doris Emil Fritz")], "item_id long, text string")
    got = {(r.doc_id, r.item_id): (r.kind, r.containment) for r in decontaminate.contamination(spark.createDataFrame(rows, "doc_id long, text string"), bench).collect()}
    assert got == dict.fromkeys(((2, 7), (6, 7), (9, 7)), ("verbatim", 1.0))


def test_templates_with_numbers_are_still_found(spark):
    item = "A train leaves the station at 9 and travels 80 km each hour for 3 hours before it stops."
    rows = [(1, item), (2, item.replace("80", "95").replace("3 hours", "4 hours")), (3, item.replace("80", "95") + " " + "1 2 3 4 5 6 " * 3000), (4, "9 80 km 3 hours")]
    bench = spark.createDataFrame([(1, item)], "item_id long, text string")
    got = {r.doc_id: r.kind for r in decontaminate.contamination(spark.createDataFrame(rows, "doc_id long, text string"), bench).collect()}
    assert got == {1: "verbatim", 2: "reparameterised", 3: "reparameterised"}


def test_top_k_over_ranges_of_queries_and_large_components(spark, monkeypatch):
    monkeypatch.setattr(topk, "QUERY_BLOCK", 3)
    monkeypatch.setattr(topk, "BLOCKS", 1)
    monkeypatch.setattr(topk, "SHARD", 40)
    rng = random.Random(2)
    rows = [(i, [rng.choice([0.0, rng.gauss(0, 1), rng.gauss(0, 1000)]) for _ in range(5)]) for i in range(150)]
    large = [(1000, [1e17] * 5), (1001, [3e6] * 5), (1002, [1e5] * 5)]
    df = spark.createDataFrame(rows + large, "vec_id long, embedding array<double>").withColumn("range", F.lit("clash"))
    got = sorted(tuple(r) for r in topk.exact_top_k(df, every=10).collect())
    kept = {i: np.floor(1024 * np.array(v)).astype(object) for i, v in rows + large[2:]}
    assert {r[0] for r in got} == {i for i in kept if i % 10 == 0}
    expected = []
    for q in kept:
        if q % 10 == 0:
            best = sorted((-int((kept[q] * x).sum()), i) for i, x in kept.items() if i != q)[:10]
            expected += [(q, k, i, -s) for k, (s, i) in enumerate(best, 1)]
    assert got == sorted(expected)


def test_empty_tables_give_no_rows(spark):
    import public_tokenizers

    from shelfspark.llm import bpe, lm, toxicity

    none = spark.createDataFrame([], "doc_id long, text string")
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert toxicity.toxicity_scores(none, labels).count() == 0
    assert bpe.digests(bpe.encode(none, public_tokenizers.path("word_bpe_49k.json"))).count() == 0
    assert lm.score_texts(none).count() == 0


def test_encoding_looks_up_tails_and_leaves_the_collector_alone(monkeypatch):
    """Tails beyond the memory are looked up anew, the library object holds no second vocabulary, and no search for cycles runs amid a batch."""
    import gc

    import public_tokenizers
    from tokenizers import Tokenizer

    from shelfspark.llm import bpe

    path = public_tokenizers.path("word_bpe_49k.json")
    enc, library = bpe.TrieEncoder(path), Tokenizer.from_file(path)
    assert enc.library.get_vocab_size() == 0
    monkeypatch.setattr(bpe, "CACHE_ENDS", 3)
    texts = ["Straße naïve thecatinthehat, onoredtion!", "ab abc abcd abcde abcdef", "Ünïcödé ǅungla ﬁn — 日本語 \x01 <|endoftext|> x", None, "a" * 300]
    seen, learn = [], enc.learn
    monkeypatch.setattr(enc, "learn", lambda words: (seen.append(gc.isenabled()), learn(words)))
    assert gc.isenabled()
    for (ids, decoded), text in zip(enc.encode_batch(texts), texts, strict=True):
        expected = library.encode(text or "", add_special_tokens=False).ids
        assert ids == expected and decoded == library.decode(expected, skip_special_tokens=False)
    assert seen == [False] and gc.isenabled()


def test_ends_share_what_is_told_of_their_rest():
    import public_tokenizers

    from shelfspark.llm import bpe

    enc = bpe.TrieEncoder(public_tokenizers.path("word_bpe_49k.json"))
    table, ends = enc.inner, enc.inner_ends
    for tail in ("zqxj", "atio", "s"):
        _, own = enc._ends(tail, table, enc.inner_sizes, ends)
        assert own == tuple((n, table[tail[-n:]]) for n in range(len(tail), 0, -1) if tail[-n:] in table)
    assert "zqxj" not in table and ends["zqxj"][1] is ends["qxj"][1]


def test_windows_of_texts_without_names_are_told_once(spark):
    texts = ["", "one", "one two three", "one two three four five six seven", "he paid 5 kg of rice to Bob Stone for 12 days in May",
             "1 2 3 4 5 6 7 8", "it has 3 4 5 6 7 8 units of it", "ask Ann Bob Carl Dora Emil Fritz now", None]
    source = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = decontaminate._searched(source, [5, 4])
    forms = decontaminate._forms(source.select("doc_id", decontaminate.tokens(F.col("text")).alias("raw")), "raw")
    every = F.concat(*[decontaminate._windows(c, k, "raw") for k in (5, 4) for c in ("canonical", "folded")])
    want = forms.select("doc_id", F.explode(F.array_distinct(every)))
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))


def test_head_words_are_found_by_prefix_and_gradients_added_up_by_runs():
    from shelfspark.llm import lm

    rng = np.random.default_rng(4)
    near = np.uint64(7) << np.uint64(60)  # hashes of one prefix
    hashes = np.unique(np.concatenate([rng.integers(0, 1 << 63, 5000).astype(np.uint64) * np.uint64(2), near + np.arange(0, 40, 2, dtype=np.uint64), np.array([0, 2**64 - 1], np.uint64)]))
    head = lm.Head.of(rng.permutation(hashes), np.ones(len(hashes), np.int64))
    assert head.most >= 20
    tokens = np.concatenate([hashes, hashes + np.uint64(1), near + np.arange(60, dtype=np.uint64), rng.integers(0, 1 << 63, 5000).astype(np.uint64)])
    place = {h: i for i, h in enumerate(hashes.tolist())}
    assert head.find(tokens).tolist() == [place.get(t, -1) for t in tokens.tolist()]
    assert lm.Head.of(hashes[:0], np.zeros(0, np.int64)).find(tokens[:3]).tolist() == [-1] * 3

    times = np.array([1, 2, 3, lm._SHORT, lm._SHORT + 1, 700, 1])
    p, of = rng.normal(size=(300, 7)).astype(np.float32), rng.integers(0, 300, times.sum())
    starts = np.cumsum(times) - times
    want = [p[of[a : a + n]].astype(float).sum(axis=0) for a, n in zip(starts, times, strict=True)]
    assert np.allclose(lm._sums(p, of, starts, times), want, atol=1e-4)


def test_a_batch_is_put_together_from_its_distinct_words():
    import public_tokenizers
    import regex
    from tokenizers import Tokenizer

    from shelfspark.llm import bpe

    path = public_tokenizers.path("word_bpe_49k.json")
    enc, library = bpe.TrieEncoder(path), Tokenizer.from_file(path)
    texts = ["", None, "the the théâtre's it'll 12³ ½ª µ^ a]b-c\\d", "<|endoftext|>the<|endoftext|>", "\x1c\x1d \x85\xa0x \x00", "the 日本 théâtre"]
    texts += [chr(c) + "a" + chr(c) + "1" + chr(c) + chr(c) for c in range(0x130)]
    ends, ids, decoded = enc.encode_columns(texts)
    for i, text in enumerate(texts):
        expected = library.encode(text or "", add_special_tokens=False).ids
        assert ids[ends[i] : ends[i + 1]].tolist() == expected
        assert decoded[i].as_py() == library.decode(expected, skip_special_tokens=False)
    # The spelt classes part texts as the properties do.
    every = "".join(chr(c) + "a" + chr(c) + " 1" for c in range(0x130))
    assert enc.plain_word.findall(every) == enc.word.findall(every) and not regex.search(r"\\p", enc.plain_word.pattern)
    none = enc.encode_columns([])
    assert none[0].tolist() == [0] and len(none[1]) == 0 and len(none[2]) == 0


def test_states_are_worked_out_when_asked_for(monkeypatch):
    """A walk works out only the states that its tokens ask for, and long words none too deep."""
    import public_tokenizers
    from tokenizers import Tokenizer

    from shelfspark.llm import bpe

    path = public_tokenizers.path("word_bpe_49k.json")
    enc, library = bpe.TrieEncoder(path), Tokenizer.from_file(path)
    asked, last = [], enc._last
    monkeypatch.setattr(enc, "_last", lambda text, n, *rest: (asked.append(text[:n]), last(text, n, *rest))[1])
    words = ["ononhewhthedontion", "ononhewhthedontions", "enlichheitenkeitgeach"]
    enc.learn(words)
    prefixes = {w[:n] for w in words for n in range(1, len(w) + 1)}
    assert 0 < len(asked) < len(prefixes) * 2 // 3 and len(asked) == len(set(asked))
    base = "onthezqingerationq" * 20
    texts = [base[:n] for n in range(190, 215)] + [base, "onredtion" * 3000, *words]
    for text, (ids, _) in zip(texts, enc.encode_batch(texts), strict=True):
        assert ids == library.encode(text, add_special_tokens=False).ids


def test_words_of_a_batch_are_told_by_runs():
    import public_tokenizers
    from tokenizers import Tokenizer

    from shelfspark.llm import bpe

    path = public_tokenizers.path("word_bpe_49k.json")
    enc, library = bpe.TrieEncoder(path), Tokenizer.from_file(path)
    ends = ["", "'", "'s", "'r", "'re", "'L", "'LL"]
    texts = ["it's we'RE they'll I'd ''s 's's 'see 'red 'l 12'3", "'", "x\x1c\x1d'm\x85\xa0'T", " \n", "", "Ünï½²ª'ß's\xad\x00\x7f×"]
    texts += [a + b + c for a in ends for b in ("", "s", "1", " ", "é", "¿", "'", "\n") for c in ends]
    texts += [chr(c) + "'s" + chr(c) + chr(c) + "1" + chr(c) for c in range(0x130)]
    distinct, at, count = enc._runs(texts)
    assert len(set(distinct)) == len(distinct)
    assert [distinct[i] for i in at] == [w for t in texts for w in enc.words(t)]
    assert count.tolist() == [len(enc.words(t)) for t in texts]
    mixed = ["日本 the", "it's", "<|endoftext|>the 日本", None, "the"]
    for text, (ids, decoded) in zip(texts + mixed, enc.encode_batch(texts + mixed), strict=True):
        expected = library.encode(text or "", add_special_tokens=False).ids
        assert ids == expected and decoded == library.decode(expected, skip_special_tokens=False)
    assert [enc.encode_batch(t) for t in ([], [None], [" "])] == [[], [([], "")], [([], "")]]
    # Another pattern is matched as it stands.
    enc.by_runs = False
    assert enc.encode_batch(texts[:6]) == bpe.TrieEncoder(path).encode_batch(texts[:6])
