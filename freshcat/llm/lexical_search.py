"""Ranked lexical search by scanning the documents: no document index.

All terms of the query items stand between boundary guards in one Aho-Corasick automaton,
which is broadcast. A document's text is brought to the same form (terms between guards) and
scanned once; every match is an occurrence of a whole term, so the scan counts term
frequencies directly. The automaton's outputs map to the items that ask for the term.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from freshcat.llm.common import ship_package, stage, unstage

#: Items are taken in blocks of at most so many rows and so many bytes of text; a block's
#: terms are what is collected and broadcast at once.
BLOCK_ITEMS, BLOCK_BYTES = 5_000, 8_000_000
GUARD = " "
#: Fixed table of the term rule: every ASCII byte that is not a letter or digit is a guard,
#: A-Z become a-z, bytes above 127 stand for themselves.
FORM = bytes(
    b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b > 127 else 32
    for b in range(256)
)


def guarded(text: str | None) -> str:
    """The terms of a text, a guard before, between and behind them; no terms: empty."""
    terms = b" ".join((text or "").encode().translate(FORM).split())
    return f"{GUARD}{terms.decode()}{GUARD}" if terms else ""


class ItemTerms:
    """The automaton of a block of items, and which items ask for each term how often."""

    def __init__(self, texts: list[str]):
        asked = [Counter(guarded(t).split(GUARD)[1:-1]) for t in texts]
        self.terms = sorted(set().union(*asked)) if asked else []
        number = {t: k for k, t in enumerate(self.terms)}
        pairs = sorted((number[t], item, n) for item, counts in enumerate(asked) for t, n in counts.items())
        self.items = np.array([p[1] for p in pairs], np.int64)
        self.times = np.array([p[2] for p in pairs], np.int64)
        self.first = np.searchsorted(np.array([p[0] for p in pairs], np.int64), np.arange(len(self.terms) + 1))
        self.longest = max((sum(c.values()) for c in asked), default=0)

    def automaton(self):
        import ahocorasick

        a = ahocorasick.Automaton()
        for k, t in enumerate(self.terms):
            a.add_word(f"{GUARD}{t}{GUARD}", k)
        a.make_automaton()
        return a


def _scan(docs: DataFrame, sent, id_col: str, text_col: str) -> DataFrame:
    """(doc_id, n, terms, tf) a document with a term: its length, and what was found in it."""
    schema = "doc_id long, n long, terms array<int>, tf array<int>"

    def scanned(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        terms = sent.value
        find = terms.automaton().iter if terms.terms else lambda text: ()
        for b in batches:
            rows = []
            for doc_id, text in zip(b["doc_id"].astype(object).where(b["doc_id"].notna(), None), b["text"], strict=True):
                form = guarded(text)
                if form:
                    tf = Counter([k for _, k in find(form)])  # neighbours share a guard
                    rows.append((doc_id, form.count(GUARD) - 1, list(tf), list(tf.values())))
            out = pd.DataFrame(rows, columns=["doc_id", "n", "terms", "tf"])
            out["doc_id"] = out["doc_id"].astype("Int64")
            yield out

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    return rows.mapInPandas(scanned, schema)


def _best(scanned: DataFrame, sent, weights, total: int, length: int, top: int) -> DataFrame:
    """(item, doc_id, score): each task's ``top`` documents of every item of the block.

    A document's score of an item is a sum over the item's terms found in it; sums stay under
    2^53, so they are exact in doubles (checked), and larger ones are added as integers.
    """
    schema = "item int, doc_id long, score long"

    def scored(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        terms, w = sent.value, weights.value
        exact = int(w.max(initial=0)) * 1_000_000 * terms.longest < 1 << 53
        held = [np.empty(0, np.int64) for _ in range(4)]  # item, null id or not, id, score

        def keep(came: list[tuple]) -> None:
            """The best of what is held and what came, at most ``top`` an item; null ids first."""
            item, has_id, ident, score = (np.concatenate(column) for column in zip(held, *came, strict=True))
            order = np.lexsort((ident, has_id, -score, item))
            at = item[order]
            chosen = order[np.arange(len(at)) - np.searchsorted(at, at) < top]
            held[:] = item[chosen], has_id[chosen], ident[chosen], score[chosen]

        for b in batches:
            came, waiting = [], 0
            has_ids, idents = b["doc_id"].notna().astype(np.int64), b["doc_id"].astype("Int64").fillna(0).astype(np.int64)
            for has_id, ident, n, ids, tf in zip(has_ids, idents, b["n"], b["terms"], b["tf"], strict=True):
                if not len(ids):
                    continue
                m = 25 + (75 * int(n) * total) // length
                tf = tf.astype(np.int64)
                worth = w[ids] * ((1_000_000_000 * tf) // (1000 * tf + 8 * m))
                first, last = terms.first[ids], terms.first[ids + 1]
                size = last - first
                at = np.repeat(first - np.concatenate([[0], np.cumsum(size)[:-1]]), size) + np.arange(size.sum())
                gain, target = np.repeat(worth, size) * terms.times[at], terms.items[at]
                if exact:
                    sums = np.bincount(target, weights=gain).astype(np.int64)
                else:
                    sums = np.zeros(int(target.max()) + 1, np.int64)
                    np.add.at(sums, target, gain)
                hit = np.flatnonzero(sums)
                came.append((hit, np.full(len(hit), has_id), np.full(len(hit), ident), sums[hit]))
                waiting += len(hit)
                if waiting > 500_000:
                    keep(came)
                    came, waiting = [], 0
            if waiting:
                keep(came)
        item, has_id, ident, score = held
        ids = pd.Series(ident, dtype="Int64").where(has_id == 1)
        yield pd.DataFrame({"item": item, "doc_id": ids, "score": score})

    return scanned.select("doc_id", "n", "terms", "tf").mapInPandas(scored, schema)


def _blocks(items: DataFrame) -> Iterator[list]:
    """The items in blocks of bounded rows and bytes, read one partition at a time."""
    block, size = [], 0
    for row in items.toLocalIterator():
        text = row["text"] or ""
        if block and (len(block) >= BLOCK_ITEMS or size + len(text) > BLOCK_BYTES):
            yield block
            block, size = [], 0
        block.append((row["item_id"], text))
        size += len(text)
    if block:
        yield block


def search(docs: DataFrame, items: DataFrame, top: int = 10, id_col: str = "doc_id", text_col: str = "text",
           item_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """(item_id, rank, doc_id, score): the ``top`` best documents of every item, scores above 0.

    Terms are the maximal runs of ASCII letters and digits and of any character above U+007F
    in the whole text, only A-Z lower-cased; a null text has none. N documents have a term, L
    is the number of all their terms, n that of one document, df the documents with a term, tf
    its occurrences. With w = floor(1000 ln((2 N + 2) / (2 df + 1))) and
    m = 25 + (75 n N) div L a document's score is the sum of
    w * ((10^9 tf) div (1000 tf + 8 m)) over the item's terms, repeats included. Equal scores
    are in order of document id, null ids first.

    Rows of ``docs`` are documents each for itself, also where ids or whole rows repeat. Rows
    of ``items`` with one id are one item with the terms of all. Empty tables, and items
    without a term that occurs, give no rows.

    Items are taken in blocks (``BLOCK_ITEMS``, ``BLOCK_BYTES``), each of which scans the
    documents once, so what is broadcast does not grow with the item table. A task keeps the
    best documents of each item, so a block moves at most tasks x items x ``top`` rows.
    """
    spark = docs.sparkSession
    ship_package(spark)
    numbered = items.select(F.col(item_col).cast("long").alias("item_id"), F.col(item_text_col).cast("string").alias("text"))
    # the texts of one id become one; a row an item from here on
    numbered = numbered.groupBy("item_id").agg(F.array_join(F.sort_array(F.collect_list("text")), "\n").alias("text"))
    result = None
    for block in _blocks(numbered):
        terms = ItemTerms([t for _, t in block])
        if not terms.terms:
            continue
        sent = spark.sparkContext.broadcast(terms)
        scanned = stage(_scan(docs, sent, id_col, text_col), "search-scan")
        total, length = scanned.agg(F.count(F.lit(1)), F.coalesce(F.sum("n"), F.lit(0))).first()
        df = np.zeros(len(terms.terms), np.int64)
        for row in scanned.select(F.explode("terms").alias("term")).groupBy("term").count().collect():  # a row a term of the block
            df[row["term"]] = row["count"]
        w = np.array([math.floor(1000 * math.log((2 * total + 2) / (2 * int(d) + 1))) for d in df], np.int64)
        ids = spark.createDataFrame([(k, i) for k, (i, _) in enumerate(block)], "item int, item_id long")
        best = _best(scanned, sent, spark.sparkContext.broadcast(w), total, length, top)
        order = [F.col("score").desc(), F.col("doc_id").asc_nulls_first()]
        ranked = best.withColumn("rank", F.row_number().over(Window.partitionBy("item").orderBy(*order))).where(F.col("rank") <= top)
        ranked = stage(ranked.join(F.broadcast(ids), "item").select("item_id", "rank", "doc_id", "score"), "search-best")
        unstage(scanned)
        result = ranked if result is None else result.unionByName(ranked)
    return result if result is not None else spark.createDataFrame([], "item_id long, rank int, doc_id long, score long")
