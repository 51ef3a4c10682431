"""WARC, URL filters, neighbours, quality rules, the classifier, the pipeline, and the entry's oracles."""

import hashlib
import math
import os
import re

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from tessera.llm import ann, queries
from tessera.llm.ann import hadamard, nearest, signed_axes
from tessera.llm.quality_classifier import classify, label_model, votes
from tessera.llm.quality_rules import quality_rules
from tessera.llm.url_filter import judge_urls
from tessera.llm.warc import deduplicate, members, page_of, parse, record_id, resolved_pages
from tests.llm.fixtures import blank, documents, empty, rows

FOLDER = "/root/testdata/sf0.001"


def test_warc(spark, tmp_path):
    big = "<p>" + "ü" * 600
    pages = [(1, "http://a/1\r\n", big), (2, None, big), (2, "http://a/2", big), (3, "http://a/3", "small"), (4, "x", "small"), (5, "y", None), (None, "z", big), (-6, "n", "b" * 1000), (7, "", "b" * 1000)]
    df = spark.createDataFrame(pages, "page_id long, url string, html string").repartition(3).withColumn("digest", F.lit(1)).withColumn("file", F.lit("f"))
    folder, headers = deduplicate(df)
    got = [(r.page_id, r.payload_bytes, r.digest, r.kind, r.refers_to) for r in headers.collect()]
    sha = lambda s: hashlib.sha1((s or "").encode()).hexdigest()
    assert sorted((g[:3] for g in got), key=repr) == sorted(((p, len((h or "").encode()), sha(h)) for p, _, h in pages), key=repr)
    kinds = sorted(((p, k, to) for p, _, _, k, to in got), key=repr)
    assert kinds == sorted([(1, "revisit", 2), (2, "revisit", 2), (2, "response", None), (3, "response", None), (4, "response", None), (5, "response", None), (None, "revisit", 2), (-6, "revisit", 7), (7, "response", None)], key=repr)
    seen, ids, refers = 0, [], set()
    for f in spark.read.format("binaryFile").load(folder).collect():
        for _, _, raw in members(bytes(f.content)):
            fields, size, payload = parse(raw)
            seen += 1
            assert (len(payload) == size) == (fields["WARC-Type"] == "response" or size == 0)
            assert ("WARC-Refers-To" in fields) == (fields["WARC-Type"] == "revisit")
            ids.append((fields["WARC-Record-ID"], fields["WARC-Type"]))
            refers |= {fields["WARC-Refers-To"]} if "WARC-Refers-To" in fields else set()
            assert re.fullmatch(r"\d{4}-\d\d-\d\dT\d\d:\d\d:\d\dZ", fields["WARC-Date"])
    assert seen == len(pages) == len(set(ids)) and len({i for i, _ in ids}) == len(pages)
    assert refers <= {i for i, kind in ids if kind == "response"}
    assert resolved_pages(spark.createDataFrame([], "page_id long, url string, html string")).count() == 0


@pytest.mark.parametrize("page", [None, 0, 1, -1, 2**63 - 1, -(2**63)])
def test_record_ids(page):
    assert page_of(record_id(page)) == page


def test_urls(spark):
    urls = [
        (1, "HTTPS://WWW.Example.COM/en/7x?q"), (2, "http://a.b.com/en/8"), (3, "http://com/en/"), (4, "http://xcom/en/1"), (5, "http://c.net/de/8#f"),
        (6, "http://example.net/de/81"), (7, "no scheme"), (8, None), (9, "http://h.org?x=/es/"), (10, "http://h.org/es/a"), (10, "http://h.org/es/a"),
        (11, "://"), (None, "http://É.com/EN/"), (12, "http://x.com/en/1\n2"),
    ]
    df = spark.createDataFrame(urls, "page_id long, url string").withColumns({c: F.lit("c") for c in ("host", "path", "rule", "template", "n", "form")})
    got = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in judge_urls(df).collect()}
    assert got[1] == ("www.example.com", "/en/7x", "example.com/en/7", "allow")
    assert got[2] == ("a.b.com", "/en/8", "com/en/", "block") and got[3][2] == "com/en/" and got[4][2] is None
    assert got[5][2:] == ("net/de/", "block") and got[6][2:] == ("example.net/de/8", "allow")
    assert got[7] == ("", "", None, "allow") and got[8] == ("", "", None, "allow") and got[11] == ("", "", None, "allow")
    assert got[9] == ("h.org", "", None, "allow") and got[10][2:] == ("org/es/", "block")
    assert got[None] == ("É.com", "/EN/", None, "allow") and got[12][1] == "/en/1\n2"
    assert judge_urls(df).count() == len(urls) and judge_urls(df.limit(0)).count() == 0


def test_templates_learn_from_labels(spark):
    bad = [(k, f"http://s.com/spam/{k}/p{k}") for k in range(40)]
    good = [(100 + k, f"http://s.com/news/{k}/p{k}") for k in range(40)]
    rules = (("s.com/spam/1", "block"), ("s.com/spam/2", "block"), ("s.com/spam/3", "block"), ("s.com/news/1", "allow"), ("s.com/news/2", "allow"))
    got = judge_urls(spark.createDataFrame(bad + good, "page_id long, url string"), rules=rules).collect()
    verdict = {r.page_id: r.verdict for r in got}
    assert all(verdict[k] == "block" for k in range(40)) and all(verdict[100 + k] == "allow" for k in range(40))
    assert {r.template for r in got} == {"/spam/*/*", "/news/*/*"}


@pytest.mark.parametrize("pages", [8, 12, 400, 3000])
def test_labels_of_one_segment_judge_only_that_segment(spark, pages):
    """One language of each host is labelled, the others and a rare one have no labels."""
    hosts = {"a.example.com": "en", "b.example.net": "de", "c.example.org": "es"}
    urls = [f"http://{h}/{lang}/{k}{end}" for h in hosts for lang in ("en", "de", "es", "fr") for k, end in [(100 + j, ".html" * (j % 3 == 0)) for j in range(pages)]]
    urls += [f"http://{h}/it/{k}" for h in hosts for k in range(5)]
    got = judge_urls(spark.createDataFrame(list(enumerate(urls)), "page_id long, url string"), rules=(("com/en/", "block"), ("net/de/", "block"), ("org/es/", "block"))).collect()
    assert len(got) == len(urls)
    for r in got:
        assert r.verdict == ("block" if r.path.split("/")[1] == hosts[r.host] else "allow"), r


def test_a_clean_branch_leaves_its_blocked_siblings(spark):
    """Three labelled branches: two blocked ones merge, the clean one doesn't; an unlabelled one takes no verdict."""
    urls = [f"http://s.com/{part}/{k}/" for part in ("spam", "pills", "news", "shop") for k in range(100, 200)]
    rules = (("s.com/spam/11", "block"), ("s.com/spam/12", "block"), ("s.com/pills/1", "block"), ("s.com/news/1", "allow"))
    got = judge_urls(spark.createDataFrame(list(enumerate(urls)), "page_id long, url string"), rules=rules).collect()
    verdicts = {(r.path.split("/")[1], r.verdict) for r in got}
    assert verdicts == {("spam", "block"), ("pills", "block"), ("news", "allow"), ("shop", "allow")}
    slugs = [f"http://s.com/spam/{a}{b}" for a in "abcdefgh" for b in "abcdefgh"] + [f"http://s.com/news/{a}{b}" for a in "abcdefgh" for b in "abcdefgh"]
    rules = (*[(f"s.com/spam/{a}", "block") for a in "abcd"], *[(f"s.com/news/{a}", "allow") for a in "abcd"])
    got = judge_urls(spark.createDataFrame(list(enumerate(slugs)), "page_id long, url string"), rules=rules).collect()
    assert {(r.template, r.verdict) for r in got} == {("/spam/*/$", "block"), ("/news/*/$", "allow")}


def test_hadamard_and_axes():
    x = np.random.default_rng(1).normal(size=(5, 8))
    assert np.allclose(np.linalg.norm(hadamard(x), axis=1), np.linalg.norm(x, axis=1)) and np.allclose(hadamard(hadamard(x)), x)
    assert np.array_equal(signed_axes(x, 3, 4), signed_axes(x * 7, 3, 4)) and signed_axes(x[:, :5], 2, 3).shape == (5, 3, 2)


def brute_nearest(items, asked, k):
    out = {}
    for q, v in asked:
        there = sorted({(math.dist(v, w), i) for i, w in items if i != q and len(w) == len(v)})
        out[q] = [i for _, i in there[:k]]
    return out


def test_neighbours(spark):
    r = np.random.default_rng(2)
    centres = r.normal(size=(8, 16))
    items = [(k, [float(x) for x in centres[k % 8] + 0.3 * r.normal(size=16)]) for k in range(400)]
    items += [(1000 + k, items[5][1]) for k in range(40)] + [(2000, [1.0, 2.0]), (2100, [1.0, 2.5])]
    odd = [(3000, None), (3100, [0.0] * 16), (3200, [float("nan")] * 16), (3300, [None] * 16), (None, items[0][1]), (3400, [])]
    df = spark.createDataFrame([*items, items[7], *odd], "vec_id long, embedding array<double>").withColumns({c: F.lit(1) for c in ("id", "dim", "cells", "rank")})
    got: dict = {}
    for x in nearest(df, df.filter("vec_id % 20 = 0 OR vec_id = 5")).orderBy("query_id", "rank").collect():
        got.setdefault(x.query_id, []).append((x.rank, x.vec_id, x.score))
    vectors = dict(items)
    want = brute_nearest(items, [(i, v) for i, v in items if i % 20 == 0 or i == 5], 10)
    assert got.keys() == want.keys()
    hits = sum(len({i for _, i, _ in got[q]} & set(want[q])) for q in want)
    assert hits >= 0.9 * sum(map(len, want.values()))
    for q, found in got.items():
        assert [k for k, _, _ in found] == list(range(1, len(found) + 1))
        assert all(abs(math.dist(vectors[q], vectors[i]) - s) < 1e-12 for _, i, s in found)
        assert [(s, i) for _, i, s in found] == sorted((s, i) for _, i, s in found)
    assert [i for _, i, _ in got[5]] == [*range(1000, 1010)] and [i for _, i, _ in got[2000]] == [2100]
    assert [i for _, i, _ in got[1020]] == [5, *range(1000, 1009)]
    assert nearest(df.limit(0), df.limit(0)).count() == 0


@pytest.mark.parametrize(("few", "tables", "probes"), [(4096, 16, 8), (0, 1, 1)])
def test_neighbours_are_complete(spark, monkeypatch, few, tables, probes):
    """Small lengths are exact, whatever the norms; elsewhere no query has fewer than k while there are more."""
    monkeypatch.setattr(ann, "FEW_VECTORS", few)
    monkeypatch.setattr(ann, "CELL_VECTORS", 100)
    monkeypatch.setattr(ann, "NORM_SPREAD", float("inf"))
    r = np.random.default_rng(5)
    items = [(1000 * dim + k, [float(x) for x in r.lognormal() * r.normal(size=dim)]) for dim, n in ((7, 5), (8, 8), (9, 11), (10, 15), (16, 400)) for k in range(n)]
    df = spark.createDataFrame(items, "vec_id long, embedding array<double>")
    got: dict = {}
    for x in nearest(df, df, tables=tables, probes=probes).orderBy("query_id", "rank").collect():
        got.setdefault(x.query_id, []).append(x.vec_id)
    want = brute_nearest(items, items, 10)
    assert {q: len(found) for q, found in got.items()} == {q: len(near) for q, near in want.items()}
    assert all(got[q] == want[q] for q in want if few or q < 10000)


def brute_rules(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows: dict = {}
    for k in range(len(words) - 7):
        windows.setdefault(tuple(words[k : k + 8]), []).append(k)
    covered = {k + j for at in windows.values() if len(at) > 1 for k in at for j in range(8)}
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(covered)


def test_quality_rules(spark):
    more = [(50, "a b c d e f g h " * 5, "en", "s", 0), (51, "x\nx\n \n \nx y\nx", "de", "s", 0), (52, " ".join("abcdefghijabcdefghik"), "fr", None, 0)]
    df = documents(spark, extra=False).unionByName(spark.createDataFrame(more, documents(spark, extra=False).schema)).withColumn("words", F.lit(1)).withColumn("lines", F.lit(2))
    got = quality_rules(df).collect()
    texts = [(r[0], r[1]) for r in [*rows(), *more]]
    want = sorted(((i, *brute_rules(t)) for i, t in texts), key=repr)
    assert sorted(((r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) for r in got), key=repr) == want
    for r in got:
        assert r.base_failed == (r.n_words < 20 or 100 * r.n_repeat_words > 30 * r.n_words)
        assert not (r.base_failed and r.kept)
    kept = {r.doc_id: r.kept for r in got}
    assert kept[1] and kept[14] and not kept[18]
    assert quality_rules(empty(spark)).count() == 0


def test_label_model_trusts_agreement():
    patterns = {"111": 400, "000": 300, "110": 20, "001": 15, "222": 5}
    post = label_model(patterns)
    assert post["111"] > 0.9 and post["000"] < 0.1 and label_model({}) == {}


def test_votes_of_short_texts_are_cautious():
    assert "1" not in votes([2] * 10, 3)


def test_classifier_edges(spark):
    got = classify(documents(spark)).collect()
    assert len(got) == len(rows())
    for r in got:
        assert 0 <= r.score <= 1 and (not blank(r.text) or (r.score == 0 and not r.kept))
    assert classify(empty(spark)).count() == 0


@pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no driver tables here")
def test_classifier_accuracy(spark):
    folder = "/root/testdata/sf0.01"
    docs, labels = spark.read.parquet(f"{folder}/documents.parquet"), spark.read.parquet(f"{folder}/labels.parquet")
    found = classify(docs).join(labels, "doc_id").selectExpr("kept = (quality = 1) AS right", "quality = 1 AND NOT kept AS lost")
    row = found.agg(F.avg(F.col("right").cast("int")).alias("right"), F.avg(F.col("lost").cast("int")).alias("lost")).first()
    assert row["right"] >= 0.97 and row["lost"] <= 0.01


@pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no driver tables here")
@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_oracles(spark, name):
    duck = duckdb.connect()
    for t in ("documents", "pages"):
        duck.sql(f"CREATE VIEW {t} AS SELECT * FROM '{FOLDER}/{t}.parquet'")
    got = queries.QUERIES[name](spark, FOLDER)
    want = duck.sql(queries.ORACLES[name])
    columns = sorted(got.columns)
    assert sorted(want.columns) == columns
    at = [list(want.columns).index(c) for c in columns]
    assert sorted((tuple(r[c] for c in columns) for r in got.collect()), key=repr) == sorted((tuple(r[i] for i in at) for r in want.fetchall()), key=repr)


def test_pipeline_stages_on_awkward_documents(spark, tmp_path):
    import corpus_pipeline as p
    from tests.llm.test_dedup import brute_components, brute_removed
    from tests.llm.test_tokens import check_sequences

    folder = f"file://{tmp_path}"
    documents(spark, extra=False).write.parquet(f"{folder}/documents.parquet")
    docs, after = spark.read.parquet(f"{folder}/documents.parquet"), {}
    for name, stage in p.STAGES:
        out = stage(spark, docs, folder)
        path = f"{folder}/{name}"
        out.write.parquet(path)
        if name != p.STAGES[-1][0]:
            assert tuple(out.columns) == p.COLUMNS
        after[name] = before, docs = docs, spark.read.parquet(path)
        assert stage(spark, before.limit(0), folder).count() == 0
    pairs = lambda df: [(r.doc_id, r.text) for r in df.collect()]
    before, kept = map(pairs, after["minhash_near_dedup"])
    roots = brute_components(before, 5, 80)
    assert sorted(kept, key=repr) == sorted((x for x in before if x[0] is None or roots[x[0]] == x[0]), key=repr)
    before, cut = map(pairs, after["suffix_dedup"])
    removed = {(r[0], r[1] - r[2]) for r in brute_removed(before, 100)}
    assert len(cut) == len(before) and all(any(i == j and len(t.encode()) <= n for j, n in removed) for i, t in cut)
    packed = after["best_fit_packing"][1]
    assert check_sequences(packed.collect()) >= 1 and {r.doc_id for r in packed.collect()} == {i for i, _ in cut}
    assert sorted(map(tuple, p.run(spark, folder).select("doc_id", "piece", "ids_crc32").collect()), key=repr) == sorted(map(tuple, packed.select("doc_id", "piece", "ids_crc32").collect()), key=repr)


def test_cells_are_the_best_of_all_tables():
    """Every home cell is of the form that queries visit, and the visited cells are those of the greatest sums."""
    x = np.random.default_rng(3).normal(size=(6, 8))
    home = ann.home_cells(x, 2, 3)
    every = ann.best_cells(x, 2, 3 * 16 * 16, 3)
    assert every.shape == (6, 768) and all(len(set(row)) == 768 for row in every) and all(set(h) <= set(e) for h, e in zip(home, every, strict=True))
    products = np.stack(list(ann.axes_of(x, 6)))  # rotation, vector, axis
    sums = {(v, (t * 16 + a) * 16 + b): products[2 * t, v, a] + products[2 * t + 1, v, b] for v in range(6) for t in range(3) for a in range(16) for b in range(16)}
    for v, row in enumerate(ann.best_cells(x, 2, 50, 3)):
        want = sorted((s for (w, _), s in sums.items() if w == v), reverse=True)[:50]
        assert np.allclose(sorted((sums[v, c] for c in row), reverse=True), want)
        assert all(sums[v, c] >= sums[v, d] - 1e-12 for t, c in enumerate(home[v]) for d in range(t * 256, t * 256 + 256))


@pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no driver tables here")
@pytest.mark.parametrize("folder", ["sf0.01", "sf0.1", "check_s"])
def test_recall_and_work_on_embeddings(spark, folder):
    if not os.path.isdir(f"/root/testdata/{folder}"):
        pytest.skip("no such table")
    df = spark.read.parquet(f"/root/testdata/{folder}/embeddings.parquet")
    asked = df.filter("vec_id % 100 = 0")
    items = df.collect()
    ids, x = np.array([r.vec_id for r in items]), np.array([r.embedding for r in items], float)
    got: dict = {}
    for r in nearest(df, asked).collect():
        got.setdefault(r.query_id, set()).add(r.vec_id)
    hits = total = 0
    for q in np.flatnonzero(ids % 100 == 0):
        away = np.sqrt(((x - x[q]) ** 2).sum(axis=1))
        want = [i for i in ids[np.lexsort((ids, away))].tolist() if i != ids[q]][:10]
        hits, total = hits + len(got[ids[q]] & set(want)), total + 10
    assert hits >= 0.93 * total
    if len(items) > ann.FEW_VECTORS:
        share = ann.compared(df, asked).agg(F.avg(F.col("compared") / F.col("n")).alias("share")).first()["share"]
        assert 0 < share <= 0.1


def test_quality_rules_by_a_reference(spark):
    """Vocabularies are the words of most documents; against trusted texts a corpus of junk isn't its own norm."""
    from tessera.llm.quality_rules import vocabularies

    r = np.random.default_rng(4)
    common, rare = [f"w{k}" for k in range(20)], [f"x{k}" for k in range(400)]
    good = [" ".join(r.choice(common if r.random() < 0.6 else rare) for _ in range(200)) for _ in range(60)]
    junk = [" ".join(r.choice(rare) for _ in range(200)) for _ in range(60)]
    make = lambda texts, lang="en": spark.createDataFrame([(k, t, lang) for k, t in enumerate(texts)], "doc_id long, text string, lang string")
    (row,) = vocabularies(make([*good, "w1 " * 19, "zz " * 5000]), "text", "lang").collect()
    counts = {w: sum(w in set(t.split()) for t in good) for w in [*common, *rare]}
    assert row.vocabulary == sorted(counts, key=lambda w: (-counts[w], w))[:16]
    held = quality_rules(make([*good[:30], *junk]), reference=make(good)).collect()
    assert [x.kept for x in sorted(held, key=lambda x: x.doc_id)] == [True] * 30 + [False] * 60
    assert all(x.kept for x in quality_rules(make(junk)).collect())  # by itself, junk looks like junk
    assert all(x.kept and x.char_js is None for x in quality_rules(make(junk, "xx"), reference=make(good)).collect())


@pytest.mark.parametrize(("norms", "least"), [(0.0, 0.9), (0.03, 0.9), (0.3, 1.0), (1.0, 1.0)])
def test_recall_with_unequal_norms(spark, norms, least):
    r = np.random.default_rng(7)
    x = r.normal(size=(3000, 32))
    x *= (r.lognormal(0, norms, len(x)) / np.linalg.norm(x, axis=1))[:, None]
    df = spark.createDataFrame([(k, [float(v) for v in y]) for k, y in enumerate(x)], "vec_id long, embedding array<double>")
    got: dict = {}
    for row in nearest(df, df.filter("vec_id % 100 = 0")).collect():
        got.setdefault(row.query_id, set()).add(row.vec_id)
    hits = 0
    for q in range(0, 3000, 100):
        away = np.sqrt(((x - x[q]) ** 2).sum(axis=1))
        hits += len(got[q] & set([k for k in np.lexsort((np.arange(3000), away)).tolist() if k != q][:10]))
    assert hits >= least * 300
