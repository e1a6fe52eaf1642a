"""Operators on urls and vectors, the shared helpers, and the registered queries."""

import random

import brute
import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from bannerloom.llm import embedding_dedup, queries, url_filter
from bannerloom.llm.common import classes, numbered, stage, with_rank
from bannerloom.llm.url_filter import Rule

RULES = [*queries.RULES, Rule("allow", "a.example.com", "/de/x"), Rule("block", "org", ""), Rule("allow", "", "/top"), Rule("block", "org", "")]


def plain(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    cut = min([rest.find(c) for c in "/?#" if c in rest], default=len(rest))
    path = rest[cut:]
    return rest[:cut].translate(brute.LOWER), path[: min([path.find(c) for c in "?#" if c in path], default=len(path))]


@pytest.mark.parametrize("most", [100, 0])
def test_url_filter(spark, most):
    r = random.Random(5)
    hosts = ["x.NET", "net", "www.example.net", "example.net", "example.com", "a.example.com", "b.a.example.com", "badexample.com", "y.org", ".net", "net.", "a..org", "", "É.net"]
    paths = ["", "/", "/en/", "/en", "/en/a/b", "/de/x1", "/de/", "/fr/?q=://z", "/top/1", "?en/", "#/en/", "/en//", "//en/", "/de/x/y#z"]
    urls = [f"{r.choice(['http', 'HTTPS', ''])}://{h}{p}" for h in hosts for p in paths] + [None, "", "no url", "://", "http://x.net/a\nb", "http://x.net/" + "s/" * 5000]
    pages = spark.createDataFrame([(i, u, "x", "y") for i, u in enumerate(urls)] + [(None, urls[0], None, None)], "page_id long, url string, rule string, h string")
    got = url_filter.judge(pages, RULES, max_broadcast=most)
    assert sorted(got.columns) == sorted(["page_id", "url", "h", "host", "path", "rule", "verdict"])
    rows = got.collect()
    assert len(rows) == len(urls) + 1
    for row in rows:
        host, path = plain(row.url)
        fits = [x for x in RULES if (host == x.host or host.endswith("." + x.host)) and path.startswith(x.path)]
        best = max(fits, key=lambda x: (len(x.host), len(x.path)), default=None)
        assert (row.host, row.path, row.rule, row.verdict) == (host, path, best and best.text, best.verdict if best else "allow"), row.url
    assert url_filter.judge(pages.limit(0), RULES, max_broadcast=most).count() == 0


def vectors():
    rng = np.random.default_rng(4)
    rows, centers = [], rng.normal(size=(12, 24))
    for i in range(160):
        v = centers[i % 12] + rng.normal(size=24) * rng.choice([0.1, 0.25, 0.4])
        rows.append((i, [float(x) for x in v.astype(np.float32)], int(i % 3)))
    rows += [(200 + i, rows[0][1], 0) for i in range(30)]
    rows += [(300, None, 0), (301, [0.0] * 24, 0), (302, [float("nan")] * 24, 0), (303, rows[0][1], None), (304, [None] + [1.0] * 23, 0), (305, [float("inf")] + [1.0] * 23, 0),
             (306, rows[0][1][:23], 0), (307, [], 0), (None, rows[3][1], 0), (7, rows[7][1], 1), (308, [2.0 * x for x in rows[1][1]], 1), (309, [1.0], 0), (310, [3.0], 0), (311, [-3.0], 0)]
    return rows


@pytest.mark.parametrize("tile", [1024, 16])
def test_embedding_dedup(spark, monkeypatch, tile):
    monkeypatch.setattr(embedding_dedup, "TILE_ROWS", tile)
    rows = vectors()
    df = spark.createDataFrame([(*r, 1, "x") for r in rows], "vec_id long, embedding array<float>, label int, cid long, part string").repartition(3)
    got = embedding_dedup.dedup(df, 0.93).collect()
    want = brute.cosine_links([r[0] for r in rows], [r[1] for r in rows], [r[2] for r in rows], 0.93)
    key = lambda x: tuple((v is None, v or 0) for v in x)
    expected = [(i, n, c, i == c) for (i, _, _), (n, c) in zip(rows, want)]
    assert sorted(map(tuple, got), key=key) == sorted(expected, key=key)
    assert embedding_dedup.dedup(df.limit(0)).count() == 0


def test_bound_drops_no_link():
    rng = np.random.default_rng(2)
    x = embedding_dedup.unit(rng.normal(size=(300, 50)) * np.linspace(3, 0.1, 50) + 1)
    basis = np.linalg.svd(x.T @ x)[0]
    assert (embedding_dedup.linked(x, x, basis, 0.9) == (np.einsum("ik,jk->ij", x, x) >= 0.9)).all()


def test_classes(spark):
    chain = [(i, i + 1) for i in range(0, 60)]
    star = [(100, 100 + i) for i in range(1, 50)]
    links = spark.createDataFrame([*chain, *star, (300, 299), (299, 300), (7, 7)], "a long, b long")
    got = {r.node: r.root for r in classes(spark, links).collect()}
    assert got == {i: 0 for i in range(61)} | {100 + i: 100 for i in range(50)} | {299: 299, 300: 299}
    assert classes(spark, links.limit(0)).count() == 0


def test_ranks_are_gapless(spark):
    df = spark.range(1000).select((F.col("id") % 3).alias("k"), "id").repartition(7)
    rows = with_rank(stage(numbered(df, "k"), "ranks"), "k").collect()
    for k in range(3):
        assert sorted(r["__rank"] for r in rows if r.k == k) == list(range(len([r for r in rows if r.k == k])))


def test_every_operator_has_a_query():
    assert sorted(int(n[2:].split("_")[0]) for n in queries.QUERIES) == list(range(1, 11))
    assert set(queries.ORACLES) <= set(queries.QUERIES)


def test_pipeline(spark, tmp_path):
    """Each stage of a small corpus against a plain version; clean documents stay."""
    r = random.Random(1)
    vocabulary = ["".join(r.choice("etaoinshr") for _ in range(r.randint(2, 8))) for _ in range(2000)]
    prose = lambda n: " ".join(r.choice(vocabulary) for _ in range(n))
    rows, labels = [], []
    for i in range(240):
        bad = i % 4 == 0
        text = " ".join(w.upper() + "!!$$" for w in prose(90).split()) if bad else prose(80) + "\nAll rights reserved\n" + prose(40)
        rows.append((i, text, "en", f"s{i % 5}", len(text)))
        labels.append((i, int(not bad), 0))
    for i in (1, 2, 3):
        rows.append((500 + i, rows[i][1].replace(rows[i][1].split()[5], "new", 1), "en", "s1", 1))
    rows += [(600, None, None, None, None), (601, "", "en", "s1", 0), (None, prose(70), None, "s2", 7)]
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    spark.createDataFrame(rows, schema).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    kept = {}
    for name, apply in corpus_pipeline.STAGES[:-1]:
        docs = stage(apply(spark, docs, str(tmp_path)), name)
        assert docs.columns == [c.split()[0] for c in schema.split(", ")]
        kept[name] = {x.doc_id: x.text for x in docs.collect()}
    clean = {i for i, *_ in rows if i is not None and i < 240 and i % 4} | {501, 502, 503}
    assert clean <= set(kept["quality_classifier"]) and not {i for i in range(0, 240, 4)} & set(kept["quality_classifier"])
    assert clean <= set(kept["quality_rules"]) and not {600, 601} & set(kept["quality_rules"])
    ids, before = zip(*kept["quality_rules"].items())
    assert kept["line_dedup"] == {i: t for i, (_, _, t) in zip(ids, brute.drop_lines(before, 10))}
    ids, before = zip(*kept["line_dedup"].items())
    assert set(kept["ngram_join"]) == {c for _, c in brute.near(ids, before, 5, 80)}
    pieces = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert {p.doc_id for p in pieces} == set(kept["ngram_join"])
    assert len({p.doc_id: p.doc_tokens for p in pieces}) == len(kept["ngram_join"])
    assert corpus_pipeline.STAGES[-1][1](spark, docs.limit(0), str(tmp_path)).count() == 0
    for name, apply in corpus_pipeline.STAGES[:-1]:
        assert apply(spark, docs.limit(0), str(tmp_path)).count() == 0, name


def test_pipeline_drops_documents_that_fail_any_rule(spark):
    """On a host that is not rejected; symbols and short or long words count like the base rules."""
    plain = " ".join(f"word{i}" for i in range(60))
    texts = [plain, plain + " $$" * 12, " ".join("abcdefghijk" + str(1000 + i) for i in range(60)), " ".join(chr(97 + i % 26) for i in range(60)), "few words"]
    texts += [plain + " $", *[plain + f" more{i}" for i in range(20)]]
    docs = spark.createDataFrame([(i, x, "s") for i, x in enumerate(texts)], "doc_id long, text string, source string")
    kept = corpus_pipeline.rules(spark, docs, "")
    assert kept.columns == docs.columns
    assert {r.doc_id for r in kept.collect()} == {0, *range(5, 26)}
