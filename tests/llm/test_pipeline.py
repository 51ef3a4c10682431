"""Every stage of the pipeline against plain Python, each on what the one before it left."""

from collections import Counter

import corpus_pipeline as p
from pyspark.sql import functions as F

from tests.llm.fixtures import blank, documents, empty, prose, rows
from tests.llm.test_classifier import judge, plain_examples, plain_fit
from tests.llm.test_dedup import brute_components, brute_lines
from tests.llm.test_tokens import check_sequences


def corpus(spark):
    """The awkward documents, near copies, a line on many sources and a passage of several documents; unknown columns."""
    shared = prose(77, 70)
    more = [(200 + k, "\n".join([prose(200 + k, 60), "Read more on our site.", prose(300 + k, 20)]), "en", f"site{k}", None) for k in range(14)]
    more += [(300 + k, prose(400 + k, 25) + " " + shared + " " + prose(500 + k, 25), "en", f"s{k}", None) for k in range(3)]
    more += [(400 + k, prose(42, 150) + f" end{k}", "en", "s9", None) for k in range(4)]
    more += [(500 + k, "BUY NOW!!! $$$ " * 20, "en", "s8", None) for k in range(3)]
    df = documents(spark, extra=False).unionByName(spark.createDataFrame(more, documents(spark, extra=False).schema))
    return df.filter("doc_id IS NULL OR doc_id <> 14").withColumns({c: F.lit("c") for c in ("kept", "score", "_gone", "text_", "node")})


def kept_text(docs):
    """What suffix dedup leaves of (id, text), in order of ids, nulls last."""
    seen, out = set(), []
    for i, t in sorted(docs, key=lambda d: (d[0] is None, d[0] or 0)):
        b = (t or "").encode()
        gone = bytearray(len(b))
        for k in range(len(b) - 99):
            if b[k : k + 100] in seen:
                gone[k : k + 100] = b"\1" * 100
            else:
                seen.add(b[k : k + 100])
        out.append((i, bytes(x for x, g in zip(b, gone, strict=True) if not g).decode(errors="ignore")))
    return out


def test_stages_equal_plain_python(spark, tmp_path):
    folder = f"file://{tmp_path}"
    corpus(spark).write.parquet(f"{folder}/documents.parquet")
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    after = {}
    for name, stage in p.STAGES:
        out = stage(spark, docs, folder)
        out.write.parquet(f"{folder}/{name}")
        before, docs = docs, spark.read.parquet(f"{folder}/{name}")
        if name != p.STAGES[-1][0]:
            assert tuple(docs.columns) == p.COLUMNS
            assert all(r.n_chars == len(r.text) for r in docs.collect() if name in ("line_dedup", "suffix_dedup") and r.text is not None)
        after[name] = (before, docs)
    order = lambda x: sorted(x, key=repr)
    pairs = lambda df: [(r.doc_id, r.text) for r in df.collect()]

    before, left = (df.select(*p.COLUMNS).collect() for df in after["quality_classifier"])
    texts = [r.text for r in before]
    known, posterior = plain_examples(texts)
    distinct = {(r.doc_id, r.text) for r in before if r.text in known}
    want = judge(known, plain_fit([(known[t][0], posterior[known[t][1]]) for _, t in distinct]))
    assert not any(abs(s - 0.5) < 0.02 for s, _ in want.values())
    assert order(map(tuple, left)) == order(tuple(r) for r in before if r.text in want and want[r.text][1])
    assert {r.doc_id for r in left} & {500, 501, 502} == set()

    before, left = (df.select("doc_id", "text", "source").collect() for df in after["line_dedup"])
    want = brute_lines([tuple(r) for r in before], 10)
    assert order((r.doc_id, r.text) for r in left) == order((i, t) for i, t, _, _ in want)
    assert sum(n for *_, n in want) == 13

    before, left = map(pairs, after["minhash_near_dedup"])
    roots = brute_components(before, 5, 80)
    first = {}
    for i, t in order((i, t) for i, t in before if i is not None and roots[i] == i):
        first.setdefault(i, t)
    assert order(left) == order([x for x in before if x[0] is None or blank(x[1])] + [x for x in first.items() if not blank(x[1])])
    assert Counter(i // 100 for i, _ in left if i and i >= 400) == {4: 1}

    before, left = map(pairs, after["suffix_dedup"])
    assert order(left) == order(kept_text(before)) and order(left) != order(before)
    packed = after["best_fit_packing"][1].collect()
    assert check_sequences(packed) >= 1 and {r.doc_id for r in packed} == {i for i, _ in left}
    again = p.run(spark, folder).select("doc_id", "piece", "ids_crc32").collect()
    assert order(map(tuple, again)) == order((r.doc_id, r.piece, r.ids_crc32) for r in packed)


def test_stages_of_an_empty_table(spark, tmp_path):
    for _, stage in p.STAGES:
        assert stage(spark, empty(spark), f"file://{tmp_path}").count() == 0
    assert len(rows()) > 20
