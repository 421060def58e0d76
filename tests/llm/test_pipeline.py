"""The pipeline against the operators' brute-force versions, a stage on what the last kept."""

import re

import corpus_pipeline as P
from freshcat.llm.common import stage, table
from tests.llm import test_decontaminate, test_packing, test_quality_rules, test_sentence_spans, test_simhash

FOLDER = "/root/testdata/sf0.001"


def texts(df):
    return [(r.doc_id, r.text) for r in df.select("doc_id", "text").collect()]


def test_stages_equal_brute_force(spark):
    docs = table(spark, FOLDER, "documents")
    labels = table(spark, FOLDER, "labels").collect()
    bench = [tuple(r) for r in table(spark, FOLDER, "benchmark").select("item_id", "text").collect()]
    trusted = {r.doc_id for r in labels if r.quality == 1 and r.toxic == 0}
    rows, frames = texts(docs), dict(P.STAGES)

    def run(name):
        out = stage(frames[name](spark, docs, FOLDER), "t")
        assert out.columns == docs.columns
        assert all(r.n_chars == len(r.text) for r in out.collect())
        return out, sorted(texts(out))

    judged = {r[0] for r in test_quality_rules.brute(rows, trusted) if r[8]}
    docs, got = run("quality rules")
    assert got == sorted(x for x in rows if x[0] in judged) and len(got) < len(rows)

    components = test_simhash.slow_components(got)
    first = {int(c) for _, _, c in components}
    docs, kept = run("simhash near-dedup")
    assert kept == [x for x in got if x[0] in first] and len(kept) < len(got)

    left = [(int(i), t) for i, t, _ in test_sentence_spans.brute(kept)]
    before = dict(kept)
    docs, cut = run("substring dedup")
    assert cut == sorted((i, t) for i, t in left if t == before[i] or re.search(r"\S", t))

    leaks = {int(i) for i, _, _ in test_decontaminate.brute(cut, bench)}
    docs, clean = run("benchmark decontamination")
    assert clean == [x for x in cut if x[0] not in leaks]

    packed = frames["packing"](spark, docs, FOLDER).collect()
    test_packing.checked(packed, clean, 4096)
    whole = P.run(spark, FOLDER).collect()
    key = lambda r: (r.doc_id, r.start, r.length, r.ids_crc32, r.doc_tokens)
    assert sorted(map(key, whole)) == sorted(map(key, packed))


def test_empty_documents(spark):
    docs = table(spark, FOLDER, "documents").limit(0)
    for name, function in P.STAGES:
        docs = stage(function(spark, docs, FOLDER), "t")
        assert docs.count() == 0


def test_hard_documents_and_extra_columns(spark):
    text = " ".join(f"word{i}" for i in range(80))
    data = [(None, text, "en", "s", 1, "row"), (1, None, "en", None, None, ""), (2, "", None, "s", 0, ""), (3, text + " end", "en", "s", 5, "x"),
            (3, text + " end", "en", "s", 5, "x"), (4, "a b " * 4000, "en", "s", 9, "")]
    docs = spark.createDataFrame(data, "doc_id long, text string, lang string, source string, n_chars long, kept string")
    for name, function in P.STAGES:
        before = docs
        docs = stage(function(spark, docs, FOLDER), "t")
        if name != "packing":
            assert docs.columns == before.columns
    assert docs.count() >= 1
