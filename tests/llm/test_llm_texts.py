"""Operators on documents against plain versions, on a table with all awkward rows."""

import random
from collections import Counter

import brute
import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import tiktoken
import xxhash
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from bannerloom.llm import byte_bpe, common, line_dedup, lm_score, ngram_join, packing, quality_classifier, quality_rules, sharding

RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
WORDS = public_tokenizers.path("word_bpe_49k.json")


def same(rows, want):
    assert Counter(map(tuple, rows)) == Counter(want)


def test_line_dedup(docs, none, texts):
    got = line_dedup.dedup_lines(docs, least=10, batches=3)
    assert set(docs.columns) < set(got.columns)
    want = brute.drop_lines([t for _, t, _ in texts], 10)
    assert any(d for _, d, _ in want)
    same(got.select("doc_id", "n_lines", "n_dropped", "text").collect(), [(i, *w) for (i, _, _), w in zip(texts, want)])
    assert line_dedup.dedup_lines(none).count() == 0


def test_runs_settle_across_levels(spark):
    runs = line_dedup.Runs(spark, least=5)
    for batch in ([("a", 2), ("b", 1)], [("a", 2), ("b", 1)], [("a", 1), ("c", 9)], [("a", 3), ("b", 1), ("c", 1)], [("b", 2)], [("d", 4)]):
        runs.add(spark.createDataFrame([(k.encode(), n) for k, n in batch], "hash binary, docs long"))
    assert sorted(bytes(r[0]) for r in runs.finish().collect()) == [b"a", b"b", b"c"]


@pytest.mark.parametrize("n, percent", [(3, 90), (5, 80)])
def test_ngram_join(docs, none, texts, n, percent):
    want = brute.near([i for i, _, _ in texts], [t for _, t, _ in texts], n, percent)
    got = ngram_join.join(docs, n, percent)
    # without shingles a row is its own component
    same(got.collect(), [(i, k, c if k else i) for (i, _, _), (k, c) in zip(texts, want)])
    assert len({c for _, c in want}) < len(texts) - 5  # there are groups
    assert ngram_join.join(none, n, percent).count() == 0


def test_keep_one_of_each_group(docs, none, texts):
    kept = ngram_join.keep_one(docs, 3, 90)
    assert kept.columns == docs.columns
    want = brute.near([i for i, _, _ in texts], [t for _, t, _ in texts], 3, 90)
    expected = Counter(i for i in {c for k, c in want if k and c is not None}) + Counter(i for (i, _, _), (k, _) in zip(texts, want) if not k)
    got = Counter(r.doc_id for r in kept.select("doc_id").collect())
    assert got.pop(None) == 1  # "only here"
    assert got == expected
    assert ngram_join.keep_one(none).count() == 0


def test_signatures_are_shared_by_linked_sets():
    rng = np.random.default_rng(3)
    for size in [1, 2, 5, 9, 10, 11, 19, 20, 33, 100, 700, 5000]:
        for percent in (60, 80, 90, 95):
            for _ in range(20):
                a = np.unique(rng.integers(0, 2**64, size, np.uint64))
                # differ in as many shingles as the similarity allows, by removal and addition
                union, cut = len(a), 0
                while 100 * (len(a) - cut - 1) >= percent * union:
                    cut += 1
                removed = int(rng.integers(0, cut + 1))
                b = np.delete(a, rng.choice(len(a), removed, replace=False))
                while 100 * len(b) >= percent * (len(a) + 1) and rng.random() < 0.9:
                    new = np.unique(np.append(b, rng.integers(0, 2**64, 1, np.uint64)))
                    shared = len(np.intersect1d(new, a))
                    if 100 * shared < percent * (len(a) + len(new) - shared):
                        break
                    b = new
                shared = len(np.intersect1d(a, b))
                assert 100 * shared >= percent * (len(a) + len(b) - shared)
                assert np.intersect1d(ngram_join.signatures(a, percent), ngram_join.signatures(b, percent)).size, (size, percent)


@pytest.mark.parametrize("percent", [80, 90])
def test_linked_sets_share_as_many_signatures_as_said(percent):
    r, most = np.random.default_rng(5), 0
    for size in [1, 2, 5, 9, 17, 30, 60, 113, 150, 196, 218, 234, 300, 700]:
        for _ in range(30):
            a = np.unique(r.integers(0, 2**64, size, np.uint64))
            b = a
            for _ in range(size):  # shingles go, come or are replaced as long as the two link
                kept = r.permutation(b)[r.integers(0, 2) :] if len(b) > 1 else b
                new = np.unique(np.concatenate([kept, r.integers(0, 2**64, r.integers(0, 2), np.uint64)]))
                shared = len(np.intersect1d(new, a))
                if 100 * shared < percent * (len(a) + len(new) - shared):
                    break
                b = new
            (of_a, least_a), (of_b, least_b) = (ngram_join.enumerated(x, percent) for x in (a, b))
            assert np.intersect1d(of_a, of_b).size >= max(least_a, least_b) >= 1, (size, percent)
            most = max(most, least_a)
    assert most > 10


def test_frequent_signatures_bring_no_unlinked_sets_together(spark, monkeypatch):
    opened, write = [], ngram_join.stage

    def noted(df, name):
        table = write(df, name)
        if name == "open":
            opened.append(table.count())
        return table

    monkeypatch.setattr(ngram_join, "stage", noted)
    passage = " ".join(f"p{i}" for i in range(40))
    texts = [" ".join(f"w{i}_{j}" for j in range(218)) for i in range(60)]  # nothing in common, sparse parts
    texts += [passage + " " + " ".join(f"v{i}_{j}" for j in range(300)) for i in range(60)]  # a passage in common
    texts += [t + " end" for t in texts[::10]]
    rows = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(4)
    got = {r.doc_id: r.component_id for r in ngram_join.join(rows, 5, 80).collect()}
    assert got == {i: i if i < 120 else (i - 120) * 10 for i in range(132)}
    assert opened == [0]


@pytest.mark.parametrize("tile, cell", [(256, 2_000_000), (3, 60)])
def test_unlinked_sets_of_a_bucket_are_not_paired_by_rows(spark, monkeypatch, tile, cell):
    monkeypatch.setattr(ngram_join, "TILE_SETS", tile)
    monkeypatch.setattr(ngram_join, "CELL_SHINGLES", cell)
    sent, write = [], ngram_join.stage

    def noted(df, name):
        table = write(df, name)
        if name == "wanted":
            sent.append((table.count(), table.columns))
        return table

    monkeypatch.setattr(ngram_join, "stage", noted)
    r = random.Random(3)
    common = [f"c{i}" for i in range(20)]
    texts = [" ".join([*common, *(f"x{i}_{j}" for j in range(r.randint(4, 9)))]) for i in range(30)]  # like each other, but not enough
    texts += [t + " end" for t in texts[:6]]
    rows = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(4)
    sets = rows.select(F.col("doc_id").alias("cid"), F.size(F.array_distinct(F.split("text", " "))).cast("long").alias("n"))
    left = sets.select(F.explode(F.array(F.lit(1), F.lit(2)).cast("array<long>")).alias("sig"), "cid", "n", F.col("cid").alias("root"))
    members = rows.select(F.col("doc_id").alias("cid"), "doc_id", ngram_join.text_key(F.col("text")).alias("key"))
    leads = rows.select(F.col("doc_id").alias("cid"), F.col("doc_id").alias("b"))
    found = {(min(x), max(x)) for x in ngram_join.compared(left, leads, rows, members, 1, 90).collect()}
    words = [set(t.split()) for t in texts]
    want = {(i, j) for i in range(36) for j in range(i) if 100 * len(words[i] & words[j]) >= 90 * len(words[i] | words[j])}
    assert found == {(j, i) for i, j in want} and len(want) == 6
    assert sent == [(36, ["cid", "sigs", "others"])]  # a row for each class, whatever the pairs


def test_sharding(docs, none, texts):
    placed = sharding.place(docs, "doc_id", shards=7)
    assert sorted(placed.columns) == sorted(docs.columns)
    rows = placed.select("doc_id", "text", "shard", "slot").collect()
    same([r[:2] for r in rows], [x[:2] for x in texts])
    sizes = Counter(r.shard for r in rows)
    assert max(sizes.values()) - min(sizes.values()) <= 1 and set(sizes) == set(range(7))
    for s in sizes:
        assert sorted(r.slot for r in rows if r.shard == s) == list(range(sizes[s]))
    assert sharding.place(none, "doc_id").count() == 0


def test_another_shard_moves_few_rows(spark):
    """With some slack most rows stay; without a hash ring nearly all would move."""
    docs = spark.range(20_000).withColumnRenamed("id", "doc_id")
    a, b = (sharding.place(docs, "doc_id", shards=n, slack=0.3).select("doc_id", F.col("shard").alias(f"s{n}")) for n in (8, 9))
    moved = a.join(b, "doc_id").where("s8 <> s9").count()
    assert moved < 20_000 * 0.2
    most = a.groupBy("s8").count().agg(F.max("count")).first()[0]
    assert most <= 2500 * 1.3 + 1


def test_one_key_for_all_rows(spark):
    docs = spark.range(5_000).select(F.lit(None).cast("long").alias("doc_id"))
    counts = sharding.place(docs, "doc_id").groupBy("shard").count().collect()
    assert [r["count"] for r in counts] == [625] * 8


def test_quality_rules(docs, none, texts):
    got = quality_rules.judge(docs, carry=["doc_id"])
    want = []
    for i, t, s in texts:
        m = brute.measures(t)
        failed = m[0] < 50 or 100 * m[4] > 50 * m[0]
        want.append((i, *m, failed))
    same(got.select("doc_id", *quality_rules.MEASURES, "base_failed").collect(), want)
    assert got.where("kept and base_failed").count() == 0
    assert quality_rules.judge(none).count() == 0


def test_bad_hosts_are_rejected_and_small_ones_are_not(spark):
    good, bad = " ".join(f"w{i}" for i in range(60)), "one two"
    rows = [(i, good if i % 10 else bad, "fine") for i in range(200)]
    rows += [(1000 + i, bad if i % 10 else good, "bad") for i in range(200)]
    rows += [(2000, bad, "small"), (2001, good, "small"), (2002, good, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    kept = {r[0] for r in quality_rules.judge(docs).where("kept").select("doc_id").collect()}
    assert kept == {i for i in range(200) if i % 10} | {2001, 2002}
    one = spark.createDataFrame([(1, good, None)], "doc_id long, text string, source string")
    assert quality_rules.judge(one).first().kept


def test_quality_classifier(spark, docs, none):
    good = " ".join(f"the of and thing{i % 7} when" for i in range(60))
    rows = [(i, good[i % 30 :] if i % 3 else "$$$ BUY!! " * (20 + i % 9) + str(i)) for i in range(300)]
    made = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(i % 3 > 0), 0) for i in range(200)] + [(0, 1, 0), (None, 1, 0), (7, None, 0)], "doc_id long, quality int, toxic int")
    model = quality_classifier.fit(made, labels, F.col("doc_id") < 150)
    held = quality_classifier.score(made, model).where("doc_id >= 150").select("doc_id", "score").collect()
    assert all((r.score >= 0.7) == (r.doc_id % 3 > 0) for r in held)
    scores = quality_classifier.score(docs.withColumn("score", F.lit("x")), model)
    assert scores.where("score is null or score < 0 or score > 1").count() == 0 and scores.count() == docs.count()
    same_text = scores.where("doc_id in (902, 903)").select("score").distinct()
    assert same_text.count() == 1
    unfit = quality_classifier.fit(made, labels.limit(0), F.lit(True))
    assert quality_classifier.score(made, unfit).agg(F.min("score")).first()[0] == 0.5
    assert quality_classifier.score(none, model).count() == 0


def test_byte_bpe(docs, none, texts):
    tokens = byte_bpe.read_ranks(RANKS)
    exact = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks={t: i for i, t in enumerate(tokens)}, special_tokens={})
    got = byte_bpe.decode(byte_bpe.encode(docs, RANKS, public_tokenizers.PATTERN), RANKS)
    rows = got.select("doc_id", "text", "ids", "decoded").collect()
    same([r[:2] for r in rows], [x[:2] for x in texts])
    for r in rows:
        assert r.ids == exact.encode_ordinary(r.text or "") and bytes(r.decoded).decode() == (r.text or "")
    empty = byte_bpe.decode(byte_bpe.encode(none, RANKS, public_tokenizers.PATTERN, keep_text=False), RANKS)
    assert empty.count() == 0 and "text" not in empty.columns


def test_perfect_hash_is_perfect_and_minimal():
    tokens = [f"t{i}".encode() for i in range(3000)]
    table = byte_bpe.PerfectHash(tokens)
    assert sorted(table.rank) == list(range(3000))
    assert all(table.find(t) == i for i, t in enumerate(tokens)) and table.find(b"other") == -1
    assert byte_bpe.PerfectHash([]).find(b"x") == -1


def test_packing(docs, none, texts):
    tokenizer = Tokenizer.from_file(WORDS)
    pieces = packing.pack(docs, WORDS, window=256, end=1)
    assert pieces.columns == [c for c in docs.columns if c != "text"] + packing.PIECE
    rows = pieces.select("doc_id", *packing.PIECE).collect()
    ids = Counter((i, tuple(tokenizer.encode(t or "", add_special_tokens=False).ids + [1])) for i, t, _ in texts)
    by_doc, used = {}, {}
    for r in rows:
        by_doc.setdefault((r.doc_id, r.doc_tokens), []).append((r.start, r.length, tuple(np.frombuffer(r.ids, "<u4"))))
        used.setdefault(r.sequence_id, []).append((r.offset, r.length))
    found = Counter()
    for (i, n), parts in by_doc.items():
        copies = [k for (d, x), k in ids.items() if d == i and len(x) == n]
        if sum(copies) == 1:
            parts.sort()
            assert [p[0] for p in parts] == [sum(p[1] for p in parts[:k]) for k in range(len(parts))]
            found[i, tuple(x for p in parts for x in p[2])] += 1
        else:
            assert sum(p[1] for p in parts) == n * sum(copies)
    assert all(ids[k] == n for k, n in found.items()) and len(found) > 50
    short = 0
    for spans in used.values():
        spans.sort()
        assert [o for o, _ in spans] == [sum(n for _, n in spans[:k]) for k in range(len(spans))]
        total = sum(n for _, n in spans)
        assert total <= 256
        short += total < 256
    assert short <= 1
    assert packing.pack(none, WORDS).count() == 0


def test_packing_behind_very_many_sequences(spark, monkeypatch):
    """Leftovers lie behind the plan's sequences, on a line that is longer than 2^31 ids from some 6 GB of texts on."""
    docs = spark.range(1, 90, numPartitions=3).selectExpr("id AS doc_id", "repeat('word ', int(id * 5 % 31)) AS text")
    pieces = lambda: [tuple(r) for r in packing.pack(docs, WORDS, window=16, end=1).orderBy("doc_id", "start").collect()]
    plan, far = packing.plan, 1 << 28

    def behind(counts, window):
        slots, rest, sequences = plan(counts, window)
        assert slots and rest
        return [(*lens, first + far, offset) for *lens, first, offset in slots], rest, sequences + far

    near = pieces()
    monkeypatch.setattr(packing, "plan", behind)
    assert pieces() == [(*row, sequence + far, offset) for *row, sequence, offset in near]


def test_plan_places_each_rest_once():
    rng = np.random.default_rng(1)
    counts = {int(k): int(n) for k, n in zip(rng.choice(np.arange(1, 128), 60, replace=False), rng.integers(1, 500, 60))}
    slots, rest, sequences = packing.plan(counts, 128)
    seen = Counter()
    room = np.zeros(sequences, int)
    for length, lo, hi, first, _ in slots:
        seen.update((length, k) for k in range(lo, hi))
        room[first : first + hi - lo] += length
    assert (room == 128).all()
    for length, lo, _ in rest:
        seen.update((length, k) for k in range(lo, counts[length]))
    assert seen == Counter((length, k) for length, n in counts.items() for k in range(n))
    assert sequences > 0.3 * sum(k * n for k, n in counts.items()) / 128  # a good part is full without a cut


@pytest.mark.parametrize("frequent, most", [(lm_score.FREQUENT, lm_score.MAX_FILTER_BYTES), (20, 400)])
def test_lm_score(docs, none, texts, monkeypatch, frequent, most):
    monkeypatch.setattr(lm_score, "FREQUENT", frequent)
    monkeypatch.setattr(lm_score, "MAX_FILTER_BYTES", most)
    tokens = lambda t: [w.translate(brute.LOWER) for w in brute.words(t)] + [None]
    learn = Counter(x for i, t, _ in texts if i is not None and i % 3 for x in tokens(t))
    n, v = sum(learn.values()), len(learn)
    got = lm_score.score(docs, F.col("doc_id") % 3 != 0)
    assert set(got.columns) - {"n_tokens", "n_known", "train_tokens", "base_score", "score"} == set(docs.columns) - {"text"}
    want = Counter()
    for i, t, _ in texts:
        base = sum(np.log10((learn[x] + 0.1) / (n + 0.1 * (v + 1))) for x in tokens(t))
        want[i, len(tokens(t)), sum(learn[x] > 0 for x in tokens(t)), n, round(base, 4)] += 1
    rows = got.select("doc_id", "n_tokens", "n_known", "train_tokens", "base_score", "score").collect()
    assert Counter((*r[:4], round(r.base_score, 4)) for r in rows) == want
    assert all(r.score < 0 for r in rows)
    if most > 400:  # the filter of 400 bytes holds hardly any count
        assert sum(r.score for r in rows if r.doc_id and r.doc_id % 3) > sum(r.base_score for r in rows if r.doc_id and r.doc_id % 3)
    assert lm_score.score(none, F.lit(True)).count() == 0
    assert lm_score.score(docs, F.lit(False)).where("n_known = 0 and train_tokens = 0").count() == len(texts)


def test_lm_score_does_not_depend_on_the_bound_of_the_broadcast(docs, none, monkeypatch):
    """A filter that stays in its blocks holds all levels too."""
    def scores(most):
        monkeypatch.setattr(lm_score, "MAX_FILTER_BYTES", most)
        rows = lm_score.score(docs, F.col("doc_id") % 3 != 0).select("doc_id", "n_tokens", "n_known", "base_score", "score").collect()
        return sorted((str(r.doc_id), r.n_tokens, r.n_known, round(r.base_score, 6), round(r.score, 6)) for r in rows)

    whole = scores(64 << 20)
    monkeypatch.setattr(lm_score, "SENT", 500, raising=False)  # many parcels
    assert scores(0) == scores(400) == whole
    assert lm_score.score(none, F.lit(True)).count() == 0


def test_lm_score_sends_parcels_to_the_blocks_in_shares(docs, monkeypatch):
    staged, write = [], lm_score.stage

    def noted(df, name):
        table = write(df, name)
        if name == "answers":
            staged.append({r[0] for r in table.select("first").distinct().collect()})
        return table

    monkeypatch.setattr(lm_score, "stage", noted)
    monkeypatch.setattr(lm_score, "MAX_FILTER_BYTES", 100)
    monkeypatch.setattr(lm_score, "SENT", 500)
    scored = lm_score.score(docs, F.lit(True))
    assert scored.where("score is null").count() == 0 and scored.count() == docs.count()
    assert len([x for x in staged if x]) > 1  # no share has all parcels
    assert len(set().union(*staged)) == sum(map(len, staged)) > 4  # and each is sent once


def test_classifier_samples_one_row_of_an_id(spark):
    rows = [(i, f"text of {i}") for i in range(20)] + [(3, f"another text {k}") for k in range(200)]
    labels = spark.createDataFrame([(i, i % 2, 0) for i in range(20)], "doc_id long, quality int, toxic int")
    found = [
        sorted(map(tuple, quality_classifier.sampled(spark.createDataFrame(rows, "doc_id long, text string").repartition(k), labels, F.lit(True)).collect()))
        for k in (1, 7)
    ]
    assert len(found[0]) == 20 and found[0] == found[1]
    assert {t for _, t, _, _ in found[0]} >= {f"text of {i}" for i in range(20) if i != 3}


def test_classifier_learns_from_all_parts_of_a_text(spark):
    """No prefixes: texts of up to 4,096 characters are whole, the pieces of longer ones reach their ends."""
    sizes = [0, 1, 511, 2047, 2667, 3000, 4096, 4097, 5000, 100_000]
    texts_ = spark.createDataFrame([(n, "".join(chr(33 + i * 90 // n) for i in range(n))) for n in sizes], "n long, text string")
    for r in texts_.select("n", "text", quality_classifier.spread(F.col("text")).alias("pieces")).collect():
        whole = "".join(r.pieces)
        if r.n <= 4096:
            assert whole == r.text
        else:
            assert len(whole) == 4096 and r.pieces[-1] == r.text[-512:] and r.pieces[0] == r.text[:512]
            assert [r.text.find(x[:1]) <= k * (r.n - 512) // 7 for k, x in enumerate(r.pieces)] == [True] * 8
            assert len({x[:1] for x in r.pieces}) == 8


def test_classifier_measures_whole_texts(spark):
    """Scores, by the plain formula over all chunks of the text."""
    import zstandard

    good, bad = " ".join(f"the of and thing{i % 7} when" for i in range(300)), " ".join(f"$$ BUY {i % 5} !!" for i in range(300))
    rows = [(i, (good if i % 2 else bad)[: 300 + 37 * i]) for i in range(80)]
    made = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(80)], "doc_id long, quality int")
    model = quality_classifier.fit(made, labels, F.lit(True))
    by = [zstandard.ZstdCompressor(level=3, dict_data=zstandard.ZstdCompressionDict(d) if d else None) for d in (model.good, model.bad, b"")]
    for r in quality_classifier.score(made, model).collect():
        data = r.text.encode()
        g, b, plain = (sum(len(c.compress(data[k : k + 2048])) for k in range(0, len(data), 2048)) for c in by)
        d, s = (b - g) / (b + g), plain / len(data)
        x = (np.array([d, s, d * s, s * s]) - np.array(model.center[:4])) / np.array(model.center[4:])
        assert abs(r.score - 1 / (1 + np.exp(-(x @ np.array(model.weights[:4]) + model.weights[4])))) < 1e-9
        assert (r.score > 0.5) == bool(r.doc_id % 2)


def test_packing_ids_of_special_names(spark):
    tokenizer = Tokenizer.from_file(WORDS)
    texts_ = ["some <|endoftext|> text", "a<|startoftext|>b C", "<|EndOfText|> X", "<| x", "<|endoftext|><|endoftext|>", "E\u0301 É <|endoftext|>", "plain Text", ""]
    rows = packing.pack(spark.createDataFrame(list(enumerate(texts_)), "doc_id long, text string"), WORDS, window=4096, end=1).orderBy("doc_id").collect()
    got = {}
    for r in sorted(rows, key=lambda r: (r.doc_id, r.start)):
        got[r.doc_id] = got.get(r.doc_id, []) + np.frombuffer(r.ids, "<u4").tolist()
    assert got == {i: tokenizer.encode(t, add_special_tokens=False).ids + [1] for i, t in enumerate(texts_)}


def test_most_rests_come_from_the_plan():
    rng = np.random.default_rng(4)
    lengths = np.clip(rng.lognormal(5.5, 1.3, 1000).astype(int), 1, 100_000) % 2048
    counts = {int(k): int(n) for k, n in Counter(lengths.tolist()).items() if k}
    slots, rest, sequences = packing.plan(counts, 2048)
    left = sum(counts[length] - lo for length, lo, _ in rest)
    assert left < 0.1 * sum(counts.values())
    room = np.zeros(sequences, int)
    for length, lo, hi, first, offset in slots:
        assert (room[first : first + hi - lo] == offset).all()
        room[first : first + hi - lo] += length
    assert (room == 2048).all()


def test_freed_tables_are_gone_and_results_stay(spark):
    import os

    with common.scope() as made:
        a = common.stage(spark.range(10), "a")
        b = common.stage(a.where("id > 2"), "b")
        with common.scope() as inner:
            c = common.staged_result(b.where("id > 5"), "c", inner)
        paths = [p for _, p in made]
        result = common.staged_result(c.where("id > 6"), "result", made)
    assert result.count() == 3 and not any(os.path.exists(p) for p in paths) and len(paths) == 3
    common.free(result)
    common.free(result)  # nothing more to do


def test_words_are_hashed_when_met_and_sorted_numbers_are_as_by_unique():
    found = common.words("A word, and a WORD é \x1c")
    assert common.hashed(found).tolist() == [xxhash.xxh64_intdigest(w, 17) for w in found] and not len(common.hashed([]))
    assert common.hashed(found).dtype == np.uint64 and common.hashed(found).dtype.isnative
    rows, tokens, counts = next(lm_score.token_blocks(enumerate(["b a b", None, ""]), 100))
    a, b = (xxhash.xxh64_intdigest(w, 17) for w in (b"a", b"b"))
    assert (rows, tokens.tolist(), counts.tolist()) == ([0, 1, 2], [b, a, b, *[int(lm_score.END)] * 3], [4, 1, 1])
    for n in (0, 1, 5_000):
        numbers = np.random.default_rng(n).integers(0, 1_000, n).astype(np.uint64) << np.uint64(54)
        assert common.distinct(numbers).tolist() == np.unique(numbers).tolist()


def test_stages_start_no_python_workers_for_small_tables_and_one_for_tokens(spark, docs):
    """Each takes some 30 MB to 100 MB of an executor; scans of rows that Python made are scans of an RDD."""
    plan = lambda df: df._jdf.queryExecution().toString()
    assert "ExistingRDD" not in plan(line_dedup.Runs(spark, least=5).frequent())
    small = packing.rows(spark, [(1, 2), (3, 4)], "a b")
    assert small.dtypes == [("a", "bigint"), ("b", "bigint")] and sorted(map(tuple, small.collect())) == [(1, 2), (3, 4)]
    assert packing.rows(spark, [], "a b").collect() == []
    tokens = packing.tokenize(docs.select("doc_id", "text"), WORDS, 64, 1)
    assert {"__rest", "__part", "__idx"} < set(tokens.columns)
    physical = tokens._jdf.queryExecution().executedPlan().toString()
    assert physical.count("MapInArrow") == 1


def test_a_worker_lets_go_of_its_encoder():
    packing.word_encoder(WORDS)
    assert packing.word_encoder.cache_info().currsize == 1
    common.let_go(but=packing.word_encoder)
    assert packing.word_encoder.cache_info().currsize == 1
    common.let_go()
    assert packing.word_encoder.cache_info().currsize == 0


def test_texts_go_to_python_in_small_batches(spark):
    """A batch is held several times over by each task; 2,000 texts of 10 kB were one of 20 MB."""
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(key)
    docs = spark.range(2000, numPartitions=1).selectExpr("id AS doc_id", "repeat('word ', 2000) AS text")

    def sizes(batches):
        for batch in batches:
            yield pa.RecordBatch.from_pydict({"bytes": [batch.nbytes], "rows": [batch.num_rows]})

    try:
        for begin in (lambda: packing.pack(docs, WORDS), lambda: corpus_pipeline.rules(spark, docs.selectExpr("*", "'s' AS source"), "")):
            spark.conf.set(key, before)
            begin()
            got = docs.mapInArrow(sizes, "bytes long, rows long").collect()
            assert sum(r["rows"] for r in got) == 2000 and max(r["bytes"] for r in got) < 2 * common.BATCH_BYTES
        spark.conf.set(key, "1m")  # less stays less
        common.small_batches(spark)
        assert spark.conf.get(key) == "1m"
    finally:
        spark.conf.set(key, before)


def test_a_word_of_one_piece_is_remembered_once():
    packing.word_encoder.cache_clear()
    encode, kind = packing.word_encoder(WORDS)
    inside = lambda f, name: dict(zip(f.__code__.co_freevars, f.__closure__))[name].cell_contents.__self__
    words = inside(encode, "lowered")
    pieces = inside(words.compute, "piece")
    assert np.frombuffer(encode("hello", 1), kind).tolist() == [*Tokenizer.from_file(WORDS).encode("hello", add_special_tokens=False).ids, 1]
    assert b"hello" in words and not pieces
    for text in ("Hello, world!", "don't é, 12 . ..."):
        assert np.frombuffer(encode(text, 1), kind).tolist() == [*Tokenizer.from_file(WORDS).encode(text, add_special_tokens=False).ids, 1]
    assert "world" in pieces
    packing.word_encoder.cache_clear()
