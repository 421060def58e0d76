"""Collocations against counting every phrase in plain Python."""

import random
import re
from collections import Counter

import pytest

from freshcat.llm import collocations as co
from tests.conftest import SF_SMALL

LOWER = {c: c + 32 for c in range(65, 91)}


def brute(docs, top=2000, least=10, share=50):
    """``docs``: (lang, text) rows."""
    f, total = {}, Counter()
    for lang, text in docs:
        lang = "und" if lang is None else lang
        for piece in re.split("[.,;:!?\n\x0b\x0c\r]", (text or "").translate(LOWER)):
            w = re.findall("[^ \t]+", piece)
            total[lang] += len(w)
            for size in (1, 2, 3):
                for i in range(len(w) - size + 1):
                    key = (lang, tuple(w[i:i + size]))
                    f[key] = f.get(key, 0) + 1
    longest, rows = {}, []
    for (lang, p), n in f.items():
        if len(p) == 3 and n >= least:
            for part in (p[:2], p[1:]):
                longest[lang, part] = max(longest.get((lang, part), 0), n)
    for (lang, p), a in f.items():
        if len(p) == 1 or a < least or 100 * longest.get((lang, p), -1) >= share * a:
            continue
        score, _, left, right = min((10**6 * a * a // (f[lang, p[:k]] * f[lang, p[k:]]), k, f[lang, p[:k]], f[lang, p[k:]]) for k in range(1, len(p)))
        rows.append((lang, " ".join(p), a, left, right, total[lang], score))
    out = []
    for lang in total:
        own = sorted((r for r in rows if r[0] == lang), key=lambda r: (-r[6], -r[2], r[1].encode()))[:top]
        out += [(lang, k, *r[1:]) for k, r in enumerate(own, 1)]
    return sorted(out)


def found(df):
    return sorted(tuple(r) for r in df.collect())


def prose(seed, texts=150, words=60):
    """Texts with fixed phrases of two and three words among random words."""
    rng = random.Random(seed)
    phrases = ["new york", "new york city", "San José", "more or less", "on the other", "the other", "x y z", "y z", "aa aa", "aa aa aa", "le çà là", "a b"]
    vocabulary = [f"w{k}" for k in range(40)] + ["the", "of", "new", "x"] * 5
    out = []
    for _ in range(texts):
        said = [rng.choice(phrases) if rng.random() < 0.3 else rng.choice(vocabulary) for _ in range(words)]
        out.append("".join(w + rng.choice([" ", " ", " ", "  ", "\t", ". ", ",", "\n", "\r", " \x0b", "; ", "!?", "　", "\x1c"]) for w in said))
    return out


def frame(spark, docs):
    return spark.createDataFrame([(lang, text, 1, 2, "x") for lang, text in docs], "lang string, text string, n int, w1 int, phrase string").repartition(6)


DOCS = [(("en", "de", None, "und", "")[k % 5], t) for k, t in enumerate(prose(1))] + [("en", None), ("en", ""), (None, None), ("xx", " ,. "), ("zz", "only one")]


@pytest.mark.parametrize("top,batch", [(2000, None), (5, 1), (12, 3), (1, 1)])
def test_equals_counting_everything(spark, top, batch):
    assert found(co.collocations(frame(spark, DOCS), top=top, batch=batch)) == brute(DOCS, top)


def test_several_batches_and_ties(spark):
    # most pairs of the first batches go, as a longer phrase holds them: more must be expanded
    rng = random.Random(4)
    docs = []
    for k in range(60):
        docs += [("en", f"p{k} q{k} r{k}")] * 12 + [("en", f"s{k} t{k}. u{k % 7} v{k}")] * 11
    docs += [("en", f"m{rng.randrange(9)} n{rng.randrange(9)}") for _ in range(900)]
    for top, batch in ((70, 4), (125, 1), (200, 2)):
        assert found(co.collocations(frame(spark, docs), top=top, batch=batch)) == brute(docs, top)


def test_other_parameters(spark):
    for least, share in ((2, 50), (30, 90), (3, 10)):
        assert found(co.collocations(frame(spark, DOCS), top=40, least=least, share=share, batch=3)) == brute(DOCS, 40, least, share)


def test_full_filters_and_small_chunks_change_nothing(spark, monkeypatch):
    monkeypatch.setattr(co, "FILTER_BITS", 64)
    monkeypatch.setattr(co, "CHUNK_WORDS", 500)
    assert found(co.collocations(frame(spark, DOCS), top=20, batch=4)) == brute(DOCS, 20)


def test_hot_phrase_and_long_text(spark):
    docs = [("en", "again and " * 60_000)] + [("en", "again and again, and again")] * 3000 + [(None, "z" * 100_000 + " tail")] * 11
    assert found(co.collocations(frame(spark, docs))) == brute(docs)


def test_empty_table(spark):
    assert found(co.collocations(frame(spark, DOCS).limit(0))) == []
    assert found(co.collocations(frame(spark, [(None, None), ("en", "")]))) == []


def test_large_counts_are_exact(spark):
    one = spark.createDataFrame([(3_000_000_000_000, 3_000_000_000_001, 2_999_999_999_999)], "a long, l long, r long")
    a, l, r = 3_000_000_000_000, 3_000_000_000_001, 2_999_999_999_999  # noqa: E741
    assert one.select(co._score("a", "l", "r")).first()[0] == 10**6 * a * a // (l * r)


def test_table(spark):
    docs = [(r.lang, r.text) for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()]
    assert found(co.collocations(spark.read.parquet(f"{SF_SMALL}/documents.parquet"))) == brute(docs)
