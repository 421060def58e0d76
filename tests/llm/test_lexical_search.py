"""Ranked search against a plain-Python restatement of the scoring rule."""

import math
import re
from collections import Counter

import pytest

from freshcat.llm import lexical_search as ls
from freshcat.llm.queries import op12_lexical_search
from tests.conftest import SF_SMALL

TERM = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")
LOWER = {c: c + 32 for c in range(65, 91)}


def terms(text):
    return TERM.findall((text or "").translate(LOWER))


def brute(docs, items, top=10):
    held = [(d, terms(t)) for d, t in docs]
    held = [(d, t) for d, t in held if t]
    total, length = len(held), sum(len(t) for _, t in held)
    df = Counter(x for _, t in held for x in set(t))
    asked = {}
    for i, t in items:
        asked.setdefault(i, []).extend(terms(t))
    out = []
    for item, query in asked.items():
        scores = []
        for d, t in held:
            tf, m = Counter(t), 25 + (75 * len(t) * total) // length
            score = sum(math.floor(1000 * math.log((2 * total + 2) / (2 * df[x] + 1))) * ((10**9 * tf[x]) // (1000 * tf[x] + 8 * m)) for x in query if tf[x])
            if score > 0:
                scores.append((-score, d is not None, d or 0))
        out += [(item, k, d if known else None, -s) for k, (s, known, d) in enumerate(sorted(scores)[:top], 1)]
    return sorted(out, key=str)


def found(df):
    return sorted([tuple(r) for r in df.select("item_id", "rank", "doc_id", "score").collect()], key=str)


DOCS = [
    (1, "Alpha beta, alpha! GAMMA-delta"), (2, None), (3, ""), (4, "... --- !!!"), (5, "ÄPFEL äpfel Äpfel naïve word x　y"), (6, "alpha"),
    (6, "alpha"), (None, "alpha beta"), (None, "alpha beta"), (7, "the " * 40_000 + "needle"), (8, "the end of the line\nthe\tend"), (9, "a1b2 3c 汉字 汉字"),
    (10, "alphabet alphas xalpha"), (11, "\x00beta\x1fgamma\x7fdelta"), (12, "beta gamma"),
]
ITEMS = [
    (1, "alpha Beta"), (2, None), (3, "?!"), (4, "alpha alpha gamma"), (5, "Äpfel"), (6, "äpfel naïve word"), (7, "the needle"), (8, "nowhere"),
    (None, "汉字"), (9, "end end end"), (9, "line"), (10, "the"), (11, "alpha beta gamma delta end line 3c x　y"), (12, "alpha beta"), (12, "alpha beta"),
]
DOC_SCHEMA, ITEM_SCHEMA = "doc_id long, text string, item_id int, n string", "item_id long, text string, doc_id int, score string"


def frames(spark, docs=DOCS, items=ITEMS):
    return (spark.createDataFrame([(*d, 3, "n") for d in docs], DOC_SCHEMA).repartition(4),
            spark.createDataFrame([(*i, 4, "s") for i in items], ITEM_SCHEMA).repartition(3))


@pytest.mark.parametrize("block", [1, 4, 5000])
def test_odd_rows_in_blocks_of_any_size(spark, monkeypatch, block):
    monkeypatch.setattr(ls, "BLOCK_ITEMS", block)
    docs, items = frames(spark)
    assert found(ls.search(docs, items)) == brute(DOCS, ITEMS)
    if block == 4:
        assert found(ls.search(docs, items, top=2)) == brute(DOCS, ITEMS, 2)


def test_many_ties_take_the_least_ids(spark):
    docs = [(k * 7 % 101, "same words here") for k in range(101)] + [(None, "same words here")] * 3 + [(500, "other")] * 400
    items = [(1, "words"), (2, "same here words")]
    a, b = frames(spark, docs, items)
    assert found(ls.search(a, b)) == brute(docs, items)


def test_empty_tables(spark):
    docs, items = frames(spark)
    assert found(ls.search(docs.limit(0), items)) == []
    assert found(ls.search(docs, items.limit(0))) == []
    assert found(ls.search(docs, items.where("item_id in (2, 3, 8)"))) == []


def test_large_sums_are_exact(spark, monkeypatch):
    real = ls.ItemTerms.__init__

    def long(self, texts):
        real(self, texts)
        self.longest = 1 << 40  # as if an item had so many terms: integers are added

    monkeypatch.setattr(ls.ItemTerms, "__init__", long)
    docs, items = frames(spark)
    assert found(ls.search(docs, items)) == brute(DOCS, ITEMS)


def test_query_on_the_tables(spark):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()]
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF_SMALL}/benchmark.parquet").collect()]
    assert found(op12_lexical_search(spark, SF_SMALL)) == brute(docs, items)
