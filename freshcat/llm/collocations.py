"""Phrase collocations by best-first branch-and-bound growth.

Phrases grow word by word from the left. What is known of a prefix bounds everything that
grows out of it:

* a word that occurs fewer than ``least`` times has no phrase (a <= f(word));
* a phrase that grows out of the two words v w has a <= f(v w), and cut after v its score is
  a^2 / (f(v) f(rest)) <= a / f(v) <= f(v w) / f(v), as the rest holds the phrase.

So two-word prefixes are expanded best bound first, in batches down to a threshold for each
language: after a batch every phrase scoring the threshold or more is known. Whether a known
two-word phrase survives hangs on the three-word phrases around it; those are counted in the
same batch, on both sides. The language is settled when enough survivors reach the
threshold (so all that tie with the last are among them) or nothing is left to expand.

A batch scans the texts for the three-word runs whose prefix or suffix is in it, by two Bloom
filters of fixed size: a false hit is counted (exactly) for nothing, no run is missed.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from freshcat.llm.common import ship_package, stage, unstage

#: Bits of a filter; the driver collects and broadcasts at most this (8 MB each).
FILTER_BITS = 1 << 26
#: Words that are counted together before rows leave a task.
CHUNK_WORDS = 500_000
#: Parts in which each language's best phrases are sought before they meet.
PARTS = 64
#: Fixed table of the text rule: A-Z become a-z, [.,;:!?\x0A-\x0D] part pieces, tab is a space.
FORM = bytes(b + 32 if 65 <= b <= 90 else 10 if b in b".,;:!?\n\x0b\x0c\r" else 32 if b == 9 else b for b in range(256))

# ------------------------------------------------------------------ in a task


def _mix(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """64-bit hash of two 64-bit hashes, in order (multiply and fold)."""
    with np.errstate(over="ignore"):
        x = (a ^ (b >> np.uint64(31)) ^ (b << np.uint64(33))) * np.uint64(0x9E3779B97F4A7C15)
        x = (x ^ (x >> np.uint64(29)) ^ b) * np.uint64(0xBF58476D1CE4E5B9)
        return x ^ (x >> np.uint64(32))


def _hashes(words: list[bytes]) -> np.ndarray:
    return np.array([xxhash.xxh64_intdigest(w) for w in words], np.uint64)


def _places(h: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """The two bits of a filter that a hash sets."""
    mask = np.uint64(bits - 1)
    return h & mask, (h >> np.uint64(32)) & mask


class Filter:
    """A Bloom filter of 64-bit words, two bits a member."""

    def __init__(self, bits: int):
        self.bits, self.words = bits, np.zeros(bits // 64, np.uint64)

    def has(self, h: np.ndarray) -> np.ndarray:
        a, b = _places(h, self.bits)
        at = lambda p: (self.words[p >> np.uint64(6)] >> (p & np.uint64(63))) & np.uint64(1)
        return (at(a) & at(b)).astype(bool)


class Chunk:
    """Words of pieces of one language, as numbers; 0 stands between pieces."""

    def __init__(self):
        self.number: dict[bytes, int] = {b"": 0}
        self.run: list[int] = [0]

    def add(self, text: bytes) -> int:
        """Add a text's pieces; returns its words."""
        number, run, words = self.number, self.run, 0
        for piece in text.translate(FORM).split(b"\n"):
            found = piece.split()
            if found:
                words += len(found)
                run += [number.setdefault(w, len(number)) for w in found]
                run.append(0)
        return words


def _counts(chunk: Chunk, size: int, keep) -> tuple[list[np.ndarray], np.ndarray]:
    """The distinct runs of ``size`` words inside pieces that ``keep`` (of their
    columns) lets through, as columns of word numbers, and their counts."""
    run = np.array(chunk.run, np.int64)
    n = len(run) - size + 1
    columns = [run[k:k + n] for k in range(size)] if n > 0 else [run[:0]] * size
    inside = np.all([c > 0 for c in columns], axis=0)
    columns = [c[inside] for c in columns]
    if keep is not None:
        let = keep(columns)
        columns = [c[let] for c in columns]
    base, key = len(chunk.number), columns[0]
    for c in columns[1:]:
        if len(key) and int(key.max()) >= (1 << 62) // base:
            key = np.unique(key, return_inverse=True)[1]
        key = key * base + c
    _, first, counts = np.unique(key, return_index=True, return_counts=True)
    return [c[first] for c in columns], counts


def _scan(texts: DataFrame, size: int, prefix=None, suffix=None) -> DataFrame:
    """(lang, w1 .. w<size>, n): counts of the runs of ``size`` words, summed over all texts.

    Two words: both in the filter ``prefix`` by themselves. Three: the first two in
    ``prefix`` or the last two in ``suffix``.
    """
    names = [f"w{k + 1}" for k in range(size)]

    def scanned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first = prefix.value if prefix is not None else None
        last = suffix.value if suffix is not None else None
        chunks: dict[str, Chunk] = {}
        held = 0

        def counted() -> Iterator[pa.RecordBatch]:
            for lang, chunk in chunks.items():
                words = list(chunk.number)
                keep = None
                if first is not None:
                    h, own = _hashes(words), _hashes([lang.encode()])
                    if size == 2:
                        live = first.has(_mix(own, h))
                        keep = lambda c: live[c[0]] & live[c[1]]  # noqa: B023, E731
                    else:
                        keep = lambda c: (first.has(_mix(own, _mix(h[c[0]], h[c[1]])))  # noqa: B023, E731
                                          | last.has(_mix(own, _mix(h[c[1]], h[c[2]]))))
                columns, counts = _counts(chunk, size, keep)
                known = pa.array(words, pa.binary()).cast(pa.string())
                for k in range(0, len(counts), 100_000):
                    cut = slice(k, k + 100_000)
                    rows = [pc.take(known, pa.array(c[cut])) for c in columns]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([lang] * len(rows[0]), pa.string()), *rows, pa.array(counts[cut], pa.int64())], names=["lang", *names, "n"])

        for b in batches:
            for lang, text in zip(b.column("lang").to_pylist(), b.column("text"), strict=True):
                held += chunks.setdefault(lang, Chunk()).add(text.as_py().encode())
                if held >= CHUNK_WORDS:
                    yield from counted()
                    chunks, held = {}, 0
        yield from counted()

    schema = "lang string, " + ", ".join(f"{w} string" for w in names) + ", n long"
    return texts.mapInArrow(scanned, schema).groupBy("lang", *names).agg(F.sum("n").alias("n"))


# ------------------------------------------------------------------ steps


def _filter(members: DataFrame, words: list[str]):
    """The broadcast Bloom filter of (lang, words): bits are set in tasks and joined by
    ``bit_or``; the driver collects at most FILTER_BITS / 64 rows."""
    spark, bits = members.sparkSession, FILTER_BITS

    def placed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if not b.num_rows:
                continue
            columns = [_hashes([x.encode() for x in b.column(c).to_pylist()]) for c in ("lang", *words)]
            h = columns[1] if len(words) == 1 else _mix(columns[1], columns[2])
            place = np.concatenate(_places(_mix(columns[0], h), bits))
            yield pa.RecordBatch.from_arrays([pa.array((place >> np.uint64(6)).astype(np.int64)), pa.array((place & np.uint64(63)).astype(np.int32))], names=["at", "bit"])

    set_bits = members.select("lang", *words).mapInArrow(placed, "at long, bit int")
    found = set_bits.groupBy("at").agg(F.bit_or(F.expr("shiftleft(1L, bit)")).alias("word")).toArrow()
    out = Filter(bits)
    out.words[found["at"].to_numpy()] = found["word"].to_numpy().astype(np.int64).view(np.uint64)
    return spark.sparkContext.broadcast(out)


def _score(whole: str, left: str, right: str) -> Column:
    """floor(10^6 a^2 / (l r)), exact for counts under 10^13."""
    a, l, r = (f"cast({c} as decimal(13,0))" for c in (whole, left, right))  # noqa: E741
    return F.expr(f"(cast(1000000 as decimal(7,0)) * ({a} * {a})) div ({l} * {r})")


def _best(df: DataFrame, k: int, order: list[Column]) -> DataFrame:
    """The first ``k`` rows of every language, with their ``rank``. They are sought in PARTS
    hashed parts of a language first, so that no task sorts all of a language's rows; at
    most PARTS x k of them meet."""
    rank = F.row_number().over(Window.partitionBy("lang", "part").orderBy(*order))
    local = df.withColumn("part", F.pmod(F.xxhash64("phrase"), F.lit(PARTS))).withColumn("rank", rank).where(F.col("rank") <= k)
    last = F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("long")
    return local.drop("part").withColumn("rank", last).where(F.col("rank") <= k)


def _pairs(texts: DataFrame, words: DataFrame, least: int) -> DataFrame:
    """(lang, w1, w2, a, l, r, score, bound) of the two-word candidates; ``bound``: no phrase
    that grows out of the pair scores more."""
    live = words.where(F.col("n") >= least)
    found = _scan(texts, 2, _filter(live, ["w1"])).where(F.col("n") >= least).withColumnRenamed("n", "a")
    for word, name in (("w1", "l"), ("w2", "r")):
        side = live.select("lang", F.col("w1").alias(word), F.col("n").alias(name)).hint("merge")
        found = found.join(side, ["lang", word])
    bound = F.expr("(cast(1000000 as decimal(7,0)) * cast(a as decimal(13,0))) div cast(l as decimal(13,0))")
    return found.select("lang", "w1", "w2", "a", "l", "r", _score("a", "l", "r").alias("score"), bound.alias("bound"))


def _triples(counted: DataFrame, pairs: DataFrame) -> DataFrame:
    """(lang, w1, w2, w3, a, l, r, score) of counted three-word candidates, by their lowest cut."""
    head = pairs.select("lang", "w1", "w2", F.col("a").alias("f12"), F.col("l").alias("f1")).hint("merge")
    tail = pairs.select("lang", F.col("w1").alias("w2"), F.col("w2").alias("w3"), F.col("a").alias("f23"), F.col("r").alias("f3")).hint("merge")
    both = counted.withColumnRenamed("n", "a").join(head, ["lang", "w1", "w2"]).join(tail, ["lang", "w2", "w3"])
    cuts = both.withColumn("s1", _score("a", "f1", "f23")).withColumn("s2", _score("a", "f12", "f3"))
    first = F.col("s1") <= F.col("s2")
    pick = lambda x, y, name: F.when(first, F.col(x)).otherwise(F.col(y)).alias(name)
    return cuts.select("lang", "w1", "w2", "w3", "a", pick("f1", "f12", "l"), pick("f23", "f3", "r"), pick("s1", "s2", "score"))


def _survivors(pairs: DataFrame, triples: DataFrame, tau: DataFrame, share: int) -> DataFrame:
    """(lang, phrase, a, l, r, score) of the surviving phrases at or above their language's
    threshold: all of them, as every longer phrase around such a pair has been counted."""
    around = triples.select("lang", "w1", "w2", F.col("a").alias("longer")).unionByName(
        triples.select("lang", F.col("w2").alias("w1"), F.col("w3").alias("w2"), F.col("a").alias("longer")))
    longest = around.groupBy("lang", "w1", "w2").agg(F.max("longer").alias("longer"))
    top = pairs.join(tau, "lang").where(F.col("score") >= F.col("tau"))
    left = top.join(longest.hint("merge"), ["lang", "w1", "w2"], "left").where(
        F.col("longer").isNull() | (100 * F.col("longer") < share * F.col("a")))
    out = ["lang", "phrase", "a", "l", "r", "score"]
    grown = triples.join(tau, "lang").where(F.col("score") >= F.col("tau"))
    return left.withColumn("phrase", F.concat_ws(" ", "w1", "w2")).select(*out).unionByName(
        grown.withColumn("phrase", F.concat_ws(" ", "w1", "w2", "w3")).select(*out))


def collocations(docs: DataFrame, top: int = 2000, least: int = 10, share: int = 50, batch: int | None = None,
                 text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): each language's ``top`` best phrases of two or
    three words.

    Only A-Z are lower-cased; ``[.,;:!?`` and line ends part a text into pieces, space and tab
    a piece into words. All counts are per language (null: ``und``) over all texts, repeated
    rows each for itself: n words, f(phrase) occurrences inside pieces, overlaps included.
    Candidates occur ``least`` times or more: a = f(phrase). Cut after its first words, l =
    f(those), r = f(the rest), the score is floor(10^6 a^2 / (l r)); the lowest-scoring cut
    counts, the first of equal ones. A candidate goes if it lies inside a longer one with
    100 f(longer) >= ``share`` a. Order: score, then a, descending, then the phrase by its UTF-8
    bytes. A null or empty text has no words; an empty table gives no rows.

    ``batch``: how many of the best two-word phrases set the first threshold of a language
    (default 2 x ``top``); each further batch takes four times as many. It changes the work, not
    the result.
    """
    ship_package(docs.sparkSession)
    texts = docs.select(F.coalesce(F.col(lang_col).cast("string"), F.lit("und")).alias("lang"),
                        F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    words = stage(_scan(texts, 1), "words")
    totals = stage(words.groupBy("lang").agg(F.sum("n").alias("n")), "word-totals")  # a row a language
    pairs = stage(_pairs(texts, words, least), "pairs")
    # how many pairs score so much or more: at most 10^6 + 1 rows a language
    ladder = stage(pairs.groupBy("lang", "score").count().select("lang", "score", F.sum("count").over(
        Window.partitionBy("lang").orderBy(F.col("score").desc())).alias("upto")), "score-ladder")

    want = batch or 2 * top
    tau = totals.select("lang", F.lit(None).cast("long").alias("before"), F.lit(True).alias("open"), F.lit(None).cast("long").alias("tau"))
    counted = None
    while True:
        reached = ladder.where(F.col("upto") >= want).groupBy("lang").agg(F.max("score").alias("to"))
        lower = F.coalesce(F.when(F.col("open"), F.col("to")).otherwise(F.col("tau")), F.lit(0))
        tau = stage(tau.join(reached, "lang", "left").select("lang", "open", F.col("tau").alias("before"), lower.alias("tau")), "thresholds")
        new = lambda c: (F.col(c) >= F.col("tau")) & (F.col("before").isNull() | (F.col(c) < F.col("before")))
        frontier = pairs.join(tau, "lang")
        runs = _scan(texts, 3, _filter(frontier.where(new("bound")), ["w1", "w2"]), _filter(frontier.where(new("score")), ["w1", "w2"]))
        batch_runs = stage(runs.where(F.col("n") >= least), "runs")
        # a run may be counted in two batches: the same count, as each scans all texts
        counted = batch_runs if counted is None else stage(counted.unionByName(batch_runs).distinct(), "runs-so-far")
        known = tau.select("lang", "tau")
        found = stage(_survivors(pairs, stage(_triples(counted, pairs), "triples"), known, share), "survivors")
        n = found.groupBy("lang").agg(F.count(F.lit(1)).alias("found"))
        still = F.col("open") & (F.col("tau") > 0) & (F.coalesce(F.col("found"), F.lit(0)) < top)
        tau = stage(tau.join(n, "lang", "left").select("lang", still.alias("open"), "before", "tau"), "settled")
        if tau.where("open").isEmpty():
            break
        want *= 4
    order = [F.col("score").desc(), F.col("a").desc(), F.col("phrase").asc()]
    unstage(words, ladder)
    return _best(found, top, order).join(totals, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
