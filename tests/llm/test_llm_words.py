"""License scans, spelling variants and whitening against plain versions."""

import random
from pathlib import Path

import numpy as np
import pytest

import brute
from bannerloom.llm import embedding_whitening, license_scan, queries, spelling_variants
from bannerloom.llm.license_scan import Template

SF_DIR = "/root/testdata/sf0.001"
needs_data = pytest.mark.skipif(not Path(SF_DIR).exists(), reason="test tables are not here")
PHRASES = [("mit", "mit license"), ("apache", "apache license"), ("gpl", "general public license")]


def labels(text, templates=license_scan.TEMPLATES):
    machine = license_scan.Automaton(templates)
    return [(templates[t].label, at, n) for t, at, n in machine.scan(license_scan.words(text))]


def test_optional_and_free_words():
    t = (Template("x", "may <<optional>>not <<optional>>ever<<end>><<end>> be used by <<any 1-3>> at all"), Template("y", "see <<any 0-2>> file"))
    assert labels("It MAY be used by you, at all", t) == [("x", 1, 7)]
    assert labels("may not be used by you and me at all", t) == [("x", 0, 10)]
    assert labels("may not ever be used by x at all", t) == [("x", 0, 9)]
    assert labels("may ever be used by x at all", t) == []
    assert labels("may be used by at all", t) == []
    assert labels("may be used by a b c d at all", t) == []
    assert labels("may be used by at all at all", t) == [("x", 0, 8)]
    assert [labels(f"see {x} file", t) for x in ("", "a", "a b", "a b c")] == [[("y", 0, 2)], [("y", 0, 3)], [("y", 0, 4)], []]


def test_longest_place_and_new_start_inside():
    t = (Template("x", "a <<any 0-3>> b"),)
    assert labels("a b b", t) == [("x", 0, 3)]
    assert labels("a a b", t) == [("x", 0, 3)]  # the second start lies inside
    assert labels("a b c a b", t) == [("x", 0, 5)]
    assert labels("a b c c c c a b", t) == [("x", 0, 2), ("x", 6, 2)]


def test_states_forgotten_in_between(monkeypatch):
    text = " ".join(random.Random(3).choices(["may", "not", "be", "mit", "license", "released", "under", "the", "ß"], k=4000))
    whole = labels(text)
    monkeypatch.setattr(license_scan, "REMEMBERED", 2)
    assert labels(text) == whole and len(whole) > 10


def test_wrong_markup():
    for bad in ("a <<optional>> b", "a <<end>>", "<<any 1-2>> a", "<<optional>>a<<end>>"):
        with pytest.raises(ValueError):
            license_scan.Automaton((Template("x", bad),))


def test_whole_licenses():
    mit = license_scan.MIT_TEXT.replace("<<optional>>", "").replace("<<end>>", "").replace("<<any 1-12>>", "THE AUTHORS OR COPYRIGHT HOLDERS")
    assert [x[0] for x in labels("Copyright 2020 me\n\n" + mit)] == ["mit-text"]
    assert labels(mit.replace("without restriction", "with restriction")) == []
    assert [x[0] for x in labels("Released under the MIT License.")] == ["mit-notice", "mit"]


def test_license_scan(spark, docs, texts, none):
    rows = [*texts, (1000, "MIT license, mit LICENSE\x7fApache\tlicense of the GNU General Public License; version 3", "s"), (1001, "émit license mit licenses", "s"), (1002, "mit " * 30_000 + "license", "s")]
    more = spark.createDataFrame([(*r, "a", "b") for r in rows], "doc_id long, text string, source string, matches string, label string").repartition(4)
    got = license_scan.scan(more)
    assert got.columns == ["doc_id", "text", "source", "label", "n_words", "matches"]
    found = sorted(((r["doc_id"] is None, r["doc_id"], r["text"] or "", r["n_words"], [(m["label"], m["first_word"]) for m in r["matches"] if m["base"]]) for r in got.collect()), key=str)
    want = sorted(((i is None, i, t or "", *brute.licenses(t, PHRASES)) for i, t, _ in rows), key=str)
    assert found == want
    for r in got.where("doc_id >= 1000").collect():
        for m in r["matches"]:
            assert license_scan.words(r["text"][m["start"] : m["end"]]) == license_scan.words(r["text"])[m["first_word"] : m["first_word"] + m["words"]]
    assert license_scan.scan(none).count() == 0


def word_rows():
    r = random.Random(5)
    stems = ["".join(r.choice("abé") for _ in range(r.randint(6, 10))) for _ in range(60)]
    rows = []
    for i in range(60):
        found = []
        for _ in range(150):
            w = stems[min(int(r.expovariate(0.12)), 59)]
            if r.random() < 0.2:
                at = r.randrange(len(w))
                w = r.choice([w[:at] + w[at + 1 :], w[:at] + "c" + w[at:], w[:at] + "bÀ"[r.randrange(2)] + w[at + 1 :], w.upper()])
            found.append(w)
        rows.append((r.choice([i, 3, None]), r.choice([" ", "1", "\n"]).join(found)))
    return rows + [(70, None), (71, ""), (72, "aaaaaaaa aaaaaaaa aaaaaaa aaaaaaa aaaaaaaaa aaaaaaaaa"), (73, "z" * 700), (73, "z" * 701), (73, "z" * 700), (74, "z" * 701 + " " + "z" * 350 + "y" + "z" * 349 + " ") , (75, "z" * 350 + "y" + "z" * 349)]


@pytest.mark.parametrize("noise", [0, 5])
def test_spelling_variants(spark, noise):
    rows = word_rows()
    docs = spark.createDataFrame([(*x, 1, "b", "c") for x in rows], "doc_id long, text string, n long, word string, form string").repartition(3)
    got = spelling_variants.variants(docs, noise=noise, times=3)
    assert got.columns == ["word", "n", "n_near", "form", "form_n", "root"]
    found = {r["word"]: (r["n"], r["n_near"], r["form"], r["form_n"], r["root"]) for r in got.collect()}
    want = brute.spelling(rows, noise, times=3)
    assert found == want and got.count() == len(want)
    assert sum(f is not None for _, _, f, _, _ in want.values()) > 30
    assert any(form != root and form for _, _, form, _, root in want.values())


def test_spelling_keys_of_one_bucket(spark):
    """A third of all words share all but their last letters: each pair of near words still comes once."""
    words = [f"prefix{a}{b}" for a in "abcdefghijklmnopqr" for b in "abcdefghijklmnopqr"]
    table = spark.createDataFrame([(w, 2) for w in words], "word string, n long").repartition(4)
    got = spelling_variants.near(table)
    assert got.count() == got.distinct().count() == len(words) * 34


def test_spelling_counts_passed_on(spark, monkeypatch):
    rows = word_rows()[:20]
    monkeypatch.setattr(spelling_variants, "COUNTED", 3)
    got = spelling_variants.variants(spark.createDataFrame(rows, "doc_id long, text string"), noise=31)
    assert {r["word"]: r["n"] for r in got.collect()} == {w: x[0] for w, x in brute.spelling(rows, 31).items()}


def test_spelling_empty(spark, none):
    assert spelling_variants.variants(none).count() == 0


def vector_rows(n=300, d=6):
    r = np.random.default_rng(9)
    base = r.normal(size=(n, 3)) @ r.normal(size=(3, d)) + 0.3 * r.normal(size=(n, d)) + 5
    return [(i, [float(np.float32(c)) for c in v]) for i, v in enumerate(base)]


def test_whitening(spark):
    rows = vector_rows()
    rows += [rows[0], (None, rows[5][1]), (None, [0.0] * 6)]
    bad = [(900, None), (901, [1.0, None, 1.0, 1.0, 1.0, 1.0]), (902, [float("nan")] * 6), (903, [float("inf")] + [1.0] * 5), (904, [])]
    table = spark.createDataFrame([(*x, 1, 2.0) for x in rows + bad], "vec_id long, embedding array<float>, n long, whitened double").repartition(3)
    got = embedding_whitening.whiten(table, components=8)
    assert got.columns == ["vec_id", "n", "deviation", "whitened", "explained", "identity_error"]
    n, deviations, explained, white = brute.whitened([v for _, v in rows], 8)
    want = sorted((str(i), n, d, tuple(np.round(w, 7))) for (i, _), d, w in zip(rows, deviations, white))
    found = got.collect()
    assert sorted((str(r["vec_id"]), r["n"], int(r["deviation"]), tuple(np.round(np.abs(r["whitened"]), 7))) for r in found) == want
    assert all(np.allclose(r["explained"], explained, rtol=1e-9) and r["identity_error"] < 1e-9 for r in found)
    signs = {tuple(np.sign(np.array(a["whitened"]) * np.array(b["whitened"]))) for a, b in zip(found, found) if a["vec_id"] == b["vec_id"]}
    assert signs == {(1.0,) * 6}
    x = np.array([r["whitened"] for r in found])
    assert np.abs((x - x.mean(axis=0)).T @ (x - x.mean(axis=0)) / len(x) - np.eye(6)).max() < 1e-9


def test_whitening_large_entries_are_exact(spark):
    rows = [(i, [float(3**i % 7919) * 1e8, float(i), -float(i * i) * 1e8]) for i in range(50)]
    got = embedding_whitening.whiten(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), components=2).collect()
    _, deviations, explained, white = brute.whitened([v for _, v in rows], 2)
    assert {r["vec_id"]: int(r["deviation"]) for r in got} == dict(zip(range(50), deviations))
    assert np.allclose(got[0]["explained"], explained)
    assert len(got[0]["whitened"]) == 2


def test_whitening_lengths_constants_and_sizes(spark):
    rows = [(1, [1.0, 2.0]), (2, [1.0, 4.0]), (3, [1.0, 2.0, 3.0]), (4, [1.0, 2.0, 3.0]), (5, [1e300])]
    got = {r["vec_id"]: r for r in embedding_whitening.whiten(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect()}
    assert [got[i]["n"] for i in (1, 3, 5)] == [2, 2, 1]
    assert got[1]["whitened"][1] is None and abs(abs(got[1]["whitened"][0]) - 1) < 1e-12 and got[1]["explained"] == [1.0, 0.0]
    assert got[3]["whitened"] == [None] * 3 and got[3]["explained"] == [None] * 3 and got[3]["deviation"] == 0
    assert got[5]["deviation"] == 0 and got[1]["identity_error"] < 1e-12


def test_whitening_empty(spark):
    empty = spark.createDataFrame([], "vec_id long, embedding array<float>")
    assert embedding_whitening.whiten(empty).collect() == []
    nothing = spark.createDataFrame([(1, None)], "vec_id long, embedding array<float>")
    assert embedding_whitening.whiten(nothing).collect() == []


@needs_data
def test_query_spelling(spark):
    rows = spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "text").collect()
    got = queries.QUERIES["op12_spelling_variants"](spark, SF_DIR).collect()
    assert {r["word"]: (r["n"], r["n_near"], r["form"], r["form_n"], r["root"]) for r in got} == brute.spelling(rows, 31)


@needs_data
def test_query_whitening(spark):
    rows = spark.read.parquet(f"{SF_DIR}/embeddings.parquet").select("vec_id", "embedding").collect()
    got = queries.QUERIES["op13_embedding_whitening"](spark, SF_DIR).collect()
    n, deviations, explained, white = brute.whitened([r[1] for r in rows], 8)
    assert len(got) == 8 * n
    place = {r[0]: i for i, r in enumerate(rows)}
    for r in got:
        i, k = place[r["vec_id"]], r["component"] - 1
        assert r["n"] == n and r["deviation"] == deviations[i]
        assert abs(abs(r["whitened"]) - white[i, k]) < 1e-7 and abs(r["explained"] / explained[k] - 1) < 1e-9 and r["identity_error"] < 1e-9
