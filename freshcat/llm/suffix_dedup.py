"""Exact repeated byte strings by range-partitioned suffix sorting.

Which suffixes: positions chosen by content, so that any two equal strings of ``length``
bytes have a chosen position (an anchor) at the same place: the least hash of the ``GRAM``-byte
strings in every window. Anchors whose gram occurs once in the corpus end there.

Anchors of one gram differ in what follows and what precedes. Where they do, the contexts
(each once) are range-partitioned by leading bytes with sampled splitters; a task sorts its
suffixes, and the reversed prefixes, by multikey quicksort over 8-byte tokens and compares
neighbours. A window of ``length`` bytes that starts o bytes before its anchor repeats if
another suffix agrees on length - o bytes and its prefix on o bytes. Splitters are whole
grams, so no two suffixes that share a gram are on two sides of a boundary; a gram with too
many contexts for a task is dealt by window instead.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from freshcat.llm.common import ship_package, stage, unstage

LENGTH = 200
GRAM = 32
#: Contexts of one gram that a task sorts; a gram with more goes window by window.
TASK_CONTEXTS = 50_000
#: Bytes of text hashed at once.
BLOCK = 1 << 19

_BASE, _OTHER = 0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F  # odd multipliers
_BYTES = np.random.default_rng(11).integers(0, 2**64, (2, 256), dtype=np.uint64)
_POWERS: dict[str, np.ndarray] = {}


def _mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(31))) * np.uint64(0x7FB5D329728EA185)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x81DADEF4BC2DD44D)
    return h ^ (h >> np.uint64(33))


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the second multiplier and of its inverse modulo 2^64."""
    if len(_POWERS.get("up", ())) < n:
        size = max(n, BLOCK + 4 * LENGTH)
        for name, factor in (("up", _OTHER), ("down", pow(_OTHER, -1, 1 << 64))):
            row = np.full(size, factor, dtype=np.uint64)
            row[0] = 1
            _POWERS[name] = np.multiply.accumulate(row)
    return _POWERS["up"][:n], _POWERS["down"][:n]


def _slide(x: np.ndarray, width: int, op) -> np.ndarray:
    """op over every ``width`` neighbours, by doubling; len(x) - width + 1 values."""
    have = 1
    while 2 * have <= width:
        x = op(x[:-have], x[have:])
        have *= 2
    return op(x[:len(x) - (width - have)], x[width - have:]) if have < width else x


def _block_anchors(data: np.ndarray, start: np.ndarray, end: np.ndarray, length: int, gram: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(position, gram hash, context hash) in a buffer of texts; ``start`` and ``end`` give
    each byte's text. Strings that cross texts do not count."""
    n = len(data)
    if n < length:
        return (np.empty(0, np.int64), *np.empty((2, 0), np.uint64))
    g, have, factor = _BYTES[0][data], 1, _BASE
    while have < gram:  # gram is a power of two
        g = g[:-have] * np.uint64(factor) + g[have:]
        factor, have = factor * factor % (1 << 64), 2 * have
    g = _mix(g) | np.uint64(1)
    width = length - gram + 1
    least = _slide(g, width, np.minimum)
    least[np.arange(len(least)) + length > end[:len(least)]] = 0
    padded = np.concatenate([np.zeros(width - 1, np.uint64), least, np.zeros(width - 1, np.uint64)])
    at = np.flatnonzero(_slide(padded, width, np.maximum)[:len(g)] == g)
    up, down = _powers(n)
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(_BYTES[1][data] * up, dtype=np.uint64)])
    low, high = np.maximum(start[at], at - (length - gram)), np.minimum(end[at], at + length)
    c = (sums[high] - sums[low]) * down[low]
    c = _mix(c + _mix((at - low).astype(np.uint64) * np.uint64(1009) + (high - at).astype(np.uint64)))
    return at, g[at], c


def anchors(texts: list[bytes], length: int = LENGTH, gram: int = GRAM) -> tuple[np.ndarray, ...]:
    """(text, position, gram hash, context hash) arrays of the anchors of some texts, hashes
    as signed longs. Long texts are hashed in overlapping blocks."""
    found = []

    def add(pieces: list[tuple[int, int, bytes, int, int]]) -> None:
        # piece: text number, position of its first byte, bytes, first and last position wanted
        data = np.frombuffer(b"".join(p[2] for p in pieces), dtype=np.uint8)
        sizes = np.array([len(p[2]) for p in pieces])
        ends = np.cumsum(sizes)
        which = np.repeat(np.arange(len(pieces)), sizes)
        at, g, c = _block_anchors(data, (ends - sizes)[which], ends[which], length, gram)
        own = which[at]
        first = np.array([p[1] for p in pieces])
        position = at - (ends - sizes)[own] + first[own]
        wanted = (position >= np.array([p[3] for p in pieces])[own]) & (position < np.array([p[4] for p in pieces])[own])
        found.append((np.array([p[0] for p in pieces])[own][wanted], position[wanted], g[wanted].view(np.int64), c[wanted].view(np.int64)))

    held, size = [], 0
    for k, text in enumerate(texts):
        if len(text) < length:
            continue
        for low in range(0, len(text), BLOCK) if len(text) > BLOCK else (0,):
            high = min(len(text), low + BLOCK) if len(text) > BLOCK else len(text)
            # windows and contexts of the wanted anchors lie within a window's length of them
            first = max(0, low - 2 * length)
            held.append((k, first, text[first:min(len(text), high + 2 * length)], low, high))
            size += len(held[-1][2])
            if size >= BLOCK:
                add(held)
                held, size = [], 0
    if held:
        add(held)
    if not found:
        return tuple(np.empty(0, np.int64) for _ in range(4))
    return tuple(np.concatenate(x) for x in zip(*found))


def multikey_order(group: np.ndarray, strings: np.ndarray) -> np.ndarray:
    """Order of fixed-width byte strings within groups (sorted by group already): multikey
    quicksort, a token of 8 bytes at a time; only strings still equal go on to the next."""
    tokens = np.ascontiguousarray(strings).view(">u8").astype(np.uint64)
    order, run = np.arange(len(strings)), group.astype(np.int64)
    open_at = np.arange(len(strings))
    for depth in range(tokens.shape[1]):
        rows = order[open_at]
        by = np.lexsort((tokens[rows, depth], run[open_at]))
        order[open_at] = rows[by]
        value, own = tokens[order[open_at], depth], run[open_at]
        new = np.ones(len(own), dtype=bool)
        new[1:] = (own[1:] != own[:-1]) | (value[1:] != value[:-1])
        run[open_at] = open_at[np.maximum.accumulate(np.where(new, np.arange(len(new)), 0))]
        alone = new & np.append(new[1:], True)
        open_at = open_at[~alone]
        if not len(open_at):
            break
    return order


def neighbour_lcp(order: np.ndarray, group: np.ndarray, strings: np.ndarray) -> np.ndarray:
    """Bytes that each string in the order shares with the one before; -1 across groups."""
    lcp = np.full(len(order), -1, dtype=np.int64)
    for k in range(1, len(order), 100_000):
        a, b = order[k - 1:k - 1 + 100_000], order[k:k + 100_000]
        a = a[:len(b)]
        differ = strings[a] != strings[b]
        lcp[k:k + len(b)] = np.where(differ.any(axis=1), differ.argmax(axis=1), strings.shape[1])
    same = np.zeros(len(order), dtype=bool)
    same[1:] = group[order[1:]] == group[order[:-1]]
    lcp[~same] = -1
    return lcp


def _table(parts: list[bytes], width: int) -> tuple[np.ndarray, np.ndarray]:
    size = np.array([len(p) for p in parts])
    return np.frombuffer(b"".join(p.ljust(width, b"\0") for p in parts), dtype=np.uint8).reshape(-1, width), size


def repeated_offsets(group: np.ndarray, left: list[bytes], right: list[bytes], copies: np.ndarray, length: int = LENGTH, gram: int = GRAM) -> tuple[np.ndarray, np.ndarray]:
    """(least, most) offset o such that the window from o bytes before the anchor repeats, a
    pair for each context (-1: none). Rows are sorted by group; ``copies`` counts equal ones."""
    after, after_size = _table(right, -(-length // 8) * 8)
    before, before_size = _table([x[::-1] for x in left], -(-(length - gram) // 8) * 8)
    orders = [multikey_order(group, x) for x in (after, before)]
    shared = [neighbour_lcp(o, group, x) for o, x in zip(orders, (after, before))]
    m = len(group)
    least, most = np.full(m, -1), np.full(m, -1)
    ids = [np.empty(m, dtype=np.int64) for _ in orders]
    for o in range(length - gram + 1):
        for own, order, lcp, need in zip(ids, orders, shared, (length - o, o)):
            own[order] = np.cumsum((lcp < need) | (lcp < 0))
        able = np.flatnonzero((after_size >= length - o) & (before_size >= o))
        if not len(able):
            continue
        key = ids[0][able] * (m + 1) + ids[1][able]
        by = np.argsort(key, kind="stable")
        new = np.ones(len(able), dtype=bool)
        new[1:] = key[by][1:] != key[by][:-1]
        of = np.cumsum(new) - 1
        again = able[by][np.bincount(of, weights=copies[able[by]])[of] >= 2]
        most[again] = o
        least[again[least[again] < 0]] = o
    return least, most


def repeated_bytes(docs: DataFrame, length: int = LENGTH, gram: int = GRAM, task_contexts: int = TASK_CONTEXTS,
                   id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept), a row for each row of ``docs``: ``kept``
    (binary) is the text's UTF-8 less each byte covered by a string of ``length`` bytes that
    also starts anywhere else, in this text or another; ``n_spans`` maximal runs are gone.

    All occurrences go, the first too; strings are judged on the input and do not cross
    documents. A null or empty text, or one shorter than ``length``, loses nothing. Repeated
    rows are documents of their own, so long ones lose everything; null and repeated ids are
    allowed. An empty table gives no rows. Grams and contexts are told apart by 64 and 128
    bits of hash; contexts that differ are compared byte by byte.
    """
    ship_package(docs.sparkSession)
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.xxhash64(text).alias("th"), text.cast("binary").alias("data"))
    reach = length - gram

    def find(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            k, _, g, c = anchors(b["data"].tolist(), length, gram)
            each = pd.DataFrame({"k": k, "g": g, "c": c}).groupby(["k", "g", "c"], sort=False).size().reset_index(name="n")
            own = b.iloc[each["k"].to_numpy()]
            yield pd.DataFrame({"doc_id": own["doc_id"].astype("Int64").to_numpy(), "th": own["th"].to_numpy(),
                                "g": each["g"].to_numpy(), "c": each["c"].to_numpy(), "n": each["n"].to_numpy()})

    all_anchors = stage(rows.mapInPandas(find, "doc_id long, th long, g long, c long, n long"), "anchors")
    grams = all_anchors.groupBy("g").agg(F.sum("n").alias("total"), F.min("c").alias("c0"), F.max("c").alias("c1")).where("total > 1")
    # written first: with nothing but exchanges below a join, a hot gram is split over tasks
    grams = stage(grams.select("g", (F.col("c0") == F.col("c1")).alias("single")), "repeated-grams")
    found = stage(all_anchors.join(grams.hint("merge"), "g"), "repeated-anchors")
    unstage(all_anchors, grams)

    # contexts of grams that have several, each fetched from one document that holds it
    holder = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "th"))
    distinct = found.where(~F.col("single")).groupBy("g", "c").agg(F.sum("n").alias("copies"), holder.alias("at"))
    wanted = distinct.groupBy(F.col("at.doc_id").alias("w_id"), F.col("at.th").alias("w_th")).agg(
        F.collect_list(F.struct("g", "c", "copies")).alias("wanted"))

    def fetch(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            texts = b["data"].tolist()
            k, at, g, c = anchors(texts, length, gram)
            want = pd.DataFrame([(i, w["g"], w["c"], w["copies"]) for i, ws in enumerate(b["wanted"]) for w in ws], columns=["k", "g", "c", "copies"])
            have = pd.DataFrame({"k": k, "at": at, "g": g, "c": c}).drop_duplicates(["k", "g", "c"])
            hit = want.merge(have, on=["k", "g", "c"])
            for low in range(0, len(hit), 20_000):
                part = hit.iloc[low:low + 20_000]
                yield pd.DataFrame({
                    "g": part["g"], "c": part["c"], "copies": part["copies"],
                    "before": [texts[i][max(0, p - reach):p] for i, p in zip(part["k"], part["at"])],
                    "after": [texts[i][p:p + length] for i, p in zip(part["k"], part["at"])],
                })

    here = rows.join(wanted.hint("merge"), F.col("doc_id").eqNullSafe(F.col("w_id")) & (F.col("th") == F.col("w_th"))).select("data", "wanted")
    # equal rows fetch the same context more than once: the first of each is taken
    contexts = stage(here.mapInPandas(fetch, "g long, c long, copies long, before binary, after binary"), "contexts")
    many = contexts.groupBy("g").agg(F.count(F.lit(1)).alias("m")).where(F.col("m") > task_contexts)
    hot = stage(many.select("g"), "hot-grams")  # a row for each gram over the bound

    ranged = (
        contexts.join(hot, "g", "left_anti").withColumn("lead", F.substring("after", 1, gram))
        .repartitionByRange("lead", "g").sortWithinPartitions("lead", "g", "c")
    )

    def compare(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in whole_grams(batches, 50_000):
            part = part.drop_duplicates(["g", "c"]).reset_index(drop=True)
            group = (part["g"].ne(part["g"].shift())).cumsum().to_numpy()
            least, most = repeated_offsets(group, part["before"].tolist(), part["after"].tolist(), part["copies"].to_numpy(), length, gram)
            yield pd.DataFrame({"g": part["g"], "c": part["c"], "least": least, "most": most})[most >= 0]

    verdicts = ranged.mapInPandas(compare, "g long, c long, least long, most long")

    # grams with more contexts than a task takes: every window is a row, counted globally
    def windows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import hashlib

        for b in batches:
            for low in range(0, len(b), 500):
                out = []
                for g, c, copies, before, after in b.iloc[low:low + 500][["g", "c", "copies", "before", "after"]].itertuples(index=False):
                    whole, p = before + after, len(before)
                    for o in range(max(0, length - len(after)), min(reach, p) + 1):
                        out.append((g, c, copies, o, hashlib.blake2b(whole[p - o:p - o + length], digest_size=16).digest()))
                yield pd.DataFrame(out, columns=["g", "c", "copies", "o", "w"])

    each = contexts.join(hot, "g", "left_semi").dropDuplicates(["g", "c"]).mapInPandas(windows, "g long, c long, copies long, o long, w binary")
    again = each.groupBy("g", "o", "w").agg(F.sum("copies").alias("t")).where("t > 1").select("g", "o", "w")
    by_window = each.join(again.hint("merge"), ["g", "o", "w"]).groupBy("g", "c").agg(F.min("o").alias("least"), F.max("o").alias("most"))
    verdicts = verdicts.unionByName(by_window) if not hot.isEmpty() else verdicts

    # back to the documents: -1 marks a gram with one context, where every window repeats
    marks = found.where("single").select("doc_id", "th", "g", "c", F.lit(-1).cast("long").alias("least"), F.lit(-1).cast("long").alias("most")).unionByName(
        found.where(~F.col("single")).join(verdicts.hint("merge"), ["g", "c"]).select("doc_id", "th", "g", "c", "least", "most"))
    listed = marks.groupBy(F.col("doc_id").alias("m_id"), F.col("th").alias("m_th")).agg(
        F.collect_set(F.struct("g", "c", "least", "most")).alias("marks"))
    joined = rows.join(listed.hint("merge"), F.col("doc_id").eqNullSafe(F.col("m_id")) & (F.col("th") == F.col("m_th")), "left")

    @F.pandas_udf("kept binary, n_removed long, n_spans long")
    def cut(data: pd.Series, marked: pd.Series) -> pd.DataFrame:
        texts = [bytes(x) for x in data]
        k, at, g, c = anchors(texts, length, gram)
        marks = pd.DataFrame([(i, w["g"], w["c"], w["least"], w["most"]) for i, ws in enumerate(marked) if ws is not None for w in ws], columns=["k", "g", "c", "least", "most"])
        hit = pd.DataFrame({"k": k, "at": at, "g": g, "c": c}).merge(marks.astype("int64"), on=["k", "g", "c"])
        hit["k"] = hit["k"].astype("int64")
        size = np.array([len(t) for t in texts], dtype=np.int64)
        p, end = hit["at"].to_numpy(np.int64), size[hit["k"].to_numpy(np.int64)]
        every = hit["most"].to_numpy(np.int64) < 0
        low = p - np.where(every, np.minimum(reach, p), hit["most"].to_numpy(np.int64))
        high = p + length - np.where(every, np.maximum(0, length - (end - p)), hit["least"].to_numpy(np.int64))
        out, own = [(t, 0, 0) for t in texts], hit["k"].to_numpy(np.int64)
        by = np.argsort(own, kind="stable")
        cuts = np.flatnonzero(np.diff(own[by])) + 1
        for mine in np.split(by, cuts) if len(by) else ():
            i = own[mine[0]]
            edge = np.zeros(size[i] + 1, dtype=np.int64)
            np.add.at(edge, low[mine], 1)
            np.add.at(edge, high[mine], -1)
            gone = np.cumsum(edge[:-1]) > 0
            spans = int(gone[0]) + int(np.count_nonzero(gone[1:] & ~gone[:-1]))
            out[i] = (np.frombuffer(texts[i], np.uint8)[~gone].tobytes(), int(gone.sum()), spans)
        return pd.DataFrame(out, columns=["kept", "n_removed", "n_spans"])

    untouched = F.col("marks").isNull()
    done = joined.select("doc_id", "data", untouched.alias("same"), F.octet_length("data").cast("long").alias("n_bytes"),
                         cut(F.when(untouched, F.lit(b"")).otherwise(F.col("data")), "marks").alias("x"))
    return done.select("doc_id", "n_bytes", "x.n_removed", "x.n_spans", F.when(F.col("same"), F.col("data")).otherwise(F.col("x.kept")).alias("kept"))


def whole_grams(batches: Iterator[pd.DataFrame], rows: int) -> Iterator[pd.DataFrame]:
    """The rows of a partition sorted by gram in parts of about ``rows``, cut between grams."""
    held, size = [], 0
    for b in batches:
        if not len(b):
            continue
        held.append(b)
        size += len(b)
        if size >= rows and held[0]["g"].iloc[0] != b["g"].iloc[-1]:
            part = pd.concat(held, ignore_index=True)
            first = int(np.argmax((part["g"] == part["g"].iloc[-1]).to_numpy()))
            yield part.iloc[:first]
            held, size = [part.iloc[first:]], len(part) - first
    if held:
        yield pd.concat(held, ignore_index=True)
