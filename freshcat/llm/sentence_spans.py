"""Substring deduplication by sliding sentence spans.

Every run of several consecutive sentences is hashed, the hashes meet in one global join,
and sentences covered by any repeated run that is not the first of its kind go.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from freshcat.llm.common import id_text, ship_package, stage, unstage, with_text_hash

SPAN = 3
#: A longer sentence counts as pieces of so many words at most, so text without full stops has units.
MAX_SENTENCE_WORDS = 12
#: A longer sentence is cut before the word of least hash of any so many consecutive words.
CUT_WORDS = 8
#: A run goes on until it has so many words: runs of a few short words repeat by chance.
MIN_SPAN_WORDS = 12

_END = re.compile(r"[.!?]+(?=\s)\s*|\n\s*")
#: Scripts written without spaces (Thai, Lao, Burmese, Khmer, kana, Han): a character counts as a word.
_SPACELESS = "\u0e00-\u0eff\u1000-\u109f\u1780-\u17ff\u3040-\u30ff\u3400-\u4dbf\u4e00-\u9fff\uf900-\ufaff\U00020000-\U0003ffff"
_WORD = re.compile(rf"[{_SPACELESS}]|[^\s{_SPACELESS}]+")
#: So does a character of a longer word.
MAX_WORD_CHARS = 200
_SPACELESS_CHARACTER = re.compile(f"[{_SPACELESS}]")
_SPACED_WORD = re.compile(r"\S+")


def placed_words(text: str, start: int, end: int) -> list[tuple[int, str]]:
    """(start, lower-case word) of the words in a part of a text."""
    out = []
    for m in _WORD.finditer(text, start, end):
        if m.end() - m.start() <= MAX_WORD_CHARS:
            out.append((m.start(), m.group().lower()))
        else:
            out += [(i, text[i].lower()) for i in range(m.start(), m.end())]
    return out


def content_cuts(words: list[str], window: int = CUT_WORDS) -> list[int]:
    """Numbers of the words that start a new piece: in each ``window`` consecutive words the
    one of least hash, the last of equals.

    A place depends on the words within ``window`` of it alone, so equal passages are cut
    alike wherever they begin, from the first cut in their first ``window`` words to the last
    one in their last. No piece is longer than ``window``.
    """
    hashes = [zlib.crc32(w.encode("utf-8", "surrogatepass")) for w in words]
    cuts, at = [], -1
    for end in range(window - 1, len(hashes)):
        low = end - window + 1
        if at < low:
            part = hashes[low:end + 1]
            at = end - part[::-1].index(min(part))
        elif hashes[end] <= hashes[at]:
            at = end
        else:
            continue
        if at:
            cuts.append(at)
    return cuts


def sentences(text: str, max_words: int = MAX_SENTENCE_WORDS) -> list[tuple[int, int, list[str]]]:
    """(start, end, lower-case words) of each unit; the units cover the whole text.

    A sentence ends after . ! or ? before white space, and at a line feed; white space
    belongs to the sentence before it (at the start of a text, to the first one). One of more
    than ``max_words`` words is cut at places its words choose (:func:`content_cuts`).
    """
    bounds = [m.end() for m in _END.finditer(text)]
    if not bounds or bounds[-1] < len(text):
        bounds.append(len(text))
    units, start = [], 0
    # most texts: words are what white space parts
    spaced = max(map(len, text.split()), default=0) <= MAX_WORD_CHARS and not _SPACELESS_CHARACTER.search(text)
    for end in bounds:
        placed = [] if spaced else placed_words(text, start, end)
        words = text[start:end].lower().split() if spaced else [w for _, w in placed]
        if not words:
            continue  # blank: goes with the next sentence
        if len(words) <= max_words:
            units.append((start, end, words))
        else:
            places = [m.start() for m in _SPACED_WORD.finditer(text, start, end)] if spaced else [a for a, _ in placed]
            cuts = [0, *content_cuts(words, min(CUT_WORDS, max_words)), len(words)]
            at = [start, *[places[k] for k in cuts[1:-1]], end]
            units += [(at[k], at[k + 1], words[cuts[k]:cuts[k + 1]]) for k in range(len(at) - 1)]
        start = end
    if units and start < len(text):  # blank rest
        units[-1] = (units[-1][0], len(text), units[-1][2])
    return units


def runs(units: list[tuple[int, int, list[str]]], span: int = SPAN, min_words: int = MIN_SPAN_WORDS) -> list[tuple[int, int, int]]:
    """(first unit, units, hash) of every run, by place: the shortest run from each unit, and
    the shortest one to each unit, of at least ``span`` units and ``min_words`` words."""
    import xxhash

    joined = [" ".join(words) for _, _, words in units]
    before = [0]
    for _, _, words in units:
        before.append(before[-1] + len(words))
    n, found, i, j = len(units), set(), 0, span
    for i in range(n - span + 1):  # from unit i
        j = max(j, i + span)
        while j < n and before[j] - before[i] < min_words:
            j += 1
        if before[j] - before[i] < min_words:
            break
        found.add((i, j - i))
    i = 0
    for j in range(span, n + 1):  # to the unit before j
        while i + 1 <= j - span and before[j] - before[i + 1] >= min_words:
            i += 1
        if before[j] - before[i] >= min_words:
            found.add((i, j - i))
    return [(i, k, xxhash.xxh64_intdigest(" ".join(joined[i:i + k]).encode("utf-8", "surrogatepass"), 7) - (1 << 63)) for i, k in sorted(found)]


def repeated_spans(docs: DataFrame, span: int = SPAN, min_words: int = MIN_SPAN_WORDS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, th, later, first_doc_ids): for each document that has any, the numbers (in
    :func:`runs`) of its repeated runs that are not first, and the ids of documents where
    those are first.

    The first occurrence of a run is the one with the least (id, text hash, number), null ids
    last. Runs of one document repeat too.
    """
    ship_package(docs.sparkSession)

    def hashed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            yield pd.DataFrame({"doc_id": b["doc_id"].astype("Int64"), "th": b["th"],
                                "hashes": [[h for _, _, h in runs(sentences(t), span, min_words)] for t in b["text"]]})

    rows = with_text_hash(id_text(docs, id_col, text_col))
    spans = stage(rows.mapInPandas(hashed, "doc_id long, th long, hashes array<long>"), "spans")
    each = spans.select("doc_id", "th", F.posexplode("hashes").alias("run", "h"))
    # written first: with nothing but exchanges below a join, a hot hash is split over tasks
    shared = stage(each.groupBy("h").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("h"), "shared-hashes")
    found = stage(each.join(shared.hint("merge"), "h"), "shared-spans")  # only what repeats goes on
    unstage(spans, shared)
    place = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "th", "run")
    first = stage(found.groupBy("h").agg(F.min(place).alias("first")), "first-spans")  # partial minima: a hot run is a row a task
    others = found.join(first.hint("merge"), "h").where(place != F.col("first"))
    return others.groupBy("doc_id", "th").agg(
        F.collect_set("run").alias("later"), F.array_sort(F.collect_set("first.doc_id")).alias("first_doc_ids"))


def remove_repeated_spans(docs: DataFrame, span: int = SPAN, min_words: int = MIN_SPAN_WORDS,
                          id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, whole, text, n_bytes, n_removed, n_spans, first_doc_ids), a row for each row
    of ``docs``: ``whole`` is the input row, ``text`` what is left of its text, ``n_removed``
    UTF-8 bytes in ``n_spans`` maximal runs are gone.

    Runs are compared by lower-case words (64-bit hash). Rows equal in id and text are one
    document: they keep or lose the same. A null or empty text stays empty; a null id is an
    id, after all others. Runs are judged on the input, not on what is left. An empty table
    gives no rows.
    """
    ship_package(docs.sparkSession)
    keyed = docs.select(
        F.struct("*").alias("whole"), F.col(id_col).cast("long").alias("doc_id"),
        F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"),
    ).withColumn("th", F.xxhash64("text"))
    marks = repeated_spans(docs, span, min_words, id_col, text_col)
    joined = keyed.join(marks.withColumnsRenamed({"doc_id": "m_id", "th": "m_th"}).hint("merge"),
                        F.col("doc_id").eqNullSafe(F.col("m_id")) & (F.col("th") == F.col("m_th")), "left")

    @F.pandas_udf("text string, n_removed long, n_spans long")
    def cut(texts: pd.Series, later: pd.Series) -> pd.DataFrame:
        out = []
        for text, marked in zip(texts, later):
            if marked is None or not len(marked):
                out.append((text, 0, 0))
                continue
            units, gone = sentences(text), set()
            every = runs(units, span, min_words)
            for run in marked:
                gone.update(range(every[run][0], every[run][0] + every[run][1]))
            left = [text[a:b] for k, (a, b, _) in enumerate(units) if k not in gone]
            removed = sum(len(text[units[k][0]:units[k][1]].encode("utf-8", "surrogatepass")) for k in gone)
            out.append(("".join(left), removed, sum(k - 1 not in gone for k in gone)))
        return pd.DataFrame(out, columns=["text", "n_removed", "n_spans"])

    untouched = F.col("later").isNull()
    done = joined.select(
        "doc_id", "whole", F.octet_length("text").cast("long").alias("n_bytes"),
        cut(F.when(untouched, F.lit("")).otherwise(F.col("text")), "later").alias("c"), "text", untouched.alias("same"), "first_doc_ids")
    return done.select(
        "doc_id", "whole", F.when(F.col("same"), F.col("text")).otherwise(F.col("c.text")).alias("text"), "n_bytes",
        "c.n_removed", "c.n_spans", F.coalesce("first_doc_ids", F.array().cast("array<long>")).alias("first_doc_ids"))
