"""SimHash near-duplicates with pivot distance tables.

Documents with equal fingerprints are one node. Two fingerprints within 3 bits agree wholly
on at least two of five bit blocks, so fingerprints are grouped by every pair of blocks; in
a group, tables of Hamming distances to reference fingerprints (pivots) discard pairs whose
coordinates differ by more than the radius anywhere (triangle inequality), and the survivors
are verified bit by bit.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from freshcat.llm.common import id_text, ship_package, sized, stage, unstage, with_text_hash
from freshcat.llm.components import components

MAX_BITS = 3
SHINGLE = 3
PIVOTS = 32
#: (first bit, bits) of the blocks; radius + 2 of them, so that two stay whole.
BLOCKS = ((0, 13), (13, 13), (26, 13), (39, 13), (52, 12))
#: Fingerprints of one group that a task compares with each other at most.
TILE = 4096


def fingerprint(text: str, shingle: int = SHINGLE) -> int:
    """Majority bits of the shingles' XXH64 (seed 42), repeats included, as a signed long."""
    import xxhash

    words = text.encode().lower().split()  # bytes: A-Z only, and just the ASCII spaces
    if not words:
        return 0
    digest = xxhash.xxh64_intdigest
    if len(words) <= shingle:
        hashes = [digest(b" ".join(words), 42)]
    else:
        hashes = [digest(b" ".join(words[i:i + shingle]), 42) for i in range(len(words) - shingle + 1)]
    return majority(np.array(hashes, dtype=np.uint64))


def majority(hashes: np.ndarray) -> int:
    ones = np.zeros(64, dtype=np.int64)
    for k in range(0, len(hashes), 65_536):
        ones += np.unpackbits(hashes[k:k + 65_536].astype(">u8").view(np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(hashes)).view(">i8")[0])


def fingerprints(docs: DataFrame, shingle: int = SHINGLE, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, th, fp) of every row; ``th`` is the text's hash. No words: fingerprint 0."""
    ship_package(docs.sparkSession)

    def computed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            yield pd.DataFrame({"doc_id": b["doc_id"].astype("Int64"), "th": b["th"], "fp": np.array([fingerprint(t, shingle) for t in b["text"]], dtype=np.int64)})

    return with_text_hash(id_text(docs, id_col, text_col)).mapInPandas(computed, "doc_id long, th long, fp long")


def pivot_table(fps: np.ndarray, pivots: int = PIVOTS) -> np.ndarray:
    """Hamming distances of the fingerprints to the pivots, a row for each pivot. The pivots
    are fixed pseudo-random fingerprints, the same in every task."""
    references = np.random.default_rng(7).integers(0, 2**64, pivots, dtype=np.uint64)
    return np.bitwise_count(references[:, None] ^ fps[None, :]).astype(np.int8)


def spanning_links(group: np.ndarray, fps: np.ndarray, side: np.ndarray, max_bits: int = MAX_BITS) -> tuple[np.ndarray, np.ndarray]:
    """Links (positions) that span the graph of fingerprints within ``max_bits`` bits inside
    each group. Rows are sorted by group; where a group comes in two sides (>= 0), only pairs
    of different sides are compared.

    Pairs are taken by distance in the sort order, all groups at once. Pairs that are known
    to be connected are skipped, so a group of n close fingerprints gives n - 1 links, never
    all pairs.
    """
    label, out_a, out_b = np.arange(len(fps)), [], []
    table = pivot_table(fps)
    at = np.arange(len(fps))
    for step in range(1, len(fps)):
        at = at[at + step < len(fps)]
        at = at[group[at] == group[at + step]]
        if not len(at):
            break
        a, b = at, at + step
        new = (label[a] != label[b]) & ((side[a] < 0) | (side[a] != side[b]))
        a, b = a[new], b[new]
        for distances in table:  # the largest coordinate difference bounds the distance
            if not len(a):
                break
            near = np.abs(distances[a] - distances[b]) <= max_bits
            a, b = a[near], b[near]
        if len(a):
            near = np.bitwise_count(fps[a] ^ fps[b]) <= max_bits
            for x, y in zip(a[near].tolist(), b[near].tolist()):
                lx, ly = _root(label, x), _root(label, y)
                if lx != ly:
                    label[max(lx, ly)] = min(lx, ly)
                    out_a.append(x)
                    out_b.append(y)
            while not np.array_equal(label, flat := label[label]):
                label = flat
    return np.array(out_a, dtype=np.int64), np.array(out_b, dtype=np.int64)


def _root(label: np.ndarray, x: int) -> int:
    while label[x] != x:
        x = label[x]
    return x


def whole_groups(batches: Iterator[pd.DataFrame], keys: list[str]) -> Iterator[pd.DataFrame]:
    """The rows of a partition sorted by ``keys``, cut only between groups."""
    held: list[pd.DataFrame] = []
    for b in batches:
        if not len(b):
            continue
        held.append(b)
        last = b[keys].iloc[-1]
        if (b[keys].iloc[0] == last).all() or sum(map(len, held)) < 50_000:
            if sum(map(len, held)) < 50_000 or (held[0][keys].iloc[0] == last).all():
                continue
        rows = pd.concat(held, ignore_index=True)
        open_group = (rows[keys] == last).all(axis=1).to_numpy()
        first = int(np.argmax(open_group))
        if first:
            yield rows.iloc[:first]
        held = [rows.iloc[first:]]
    if held:
        yield pd.concat(held, ignore_index=True)


def near_links(fps: DataFrame, max_bits: int = MAX_BITS, tile: int = TILE) -> DataFrame:
    """(a, b): links that connect exactly the distinct fingerprints (column ``fp``) that
    chains of steps of at most ``max_bits`` <= 3 bits connect.

    A fingerprint is indexed under ten keys (pairs of blocks, 24 to 26 bits); keys of one
    fingerprint are dropped. A key with more than ``tile`` fingerprints is dealt into chunks
    and every two chunks meet in a task of their own: no pair is lost and no task holds
    more than two chunks.
    """
    if max_bits > len(BLOCKS) - 2:
        raise ValueError("the blocks guarantee at most 3 bits")
    ship_package(fps.sparkSession)

    def block(k: int) -> Column:
        start, bits = BLOCKS[k]
        return F.shiftrightunsigned("fp", start).bitwiseAND(F.lit((1 << bits) - 1))

    keys = [
        F.shiftleft(block(i), 13).bitwiseOR(block(j)).bitwiseOR(F.lit(n << 40))
        for n, (i, j) in enumerate(combinations(range(len(BLOCKS)), 2))
    ]
    index = fps.select(F.explode(F.array(*keys)).alias("key"), "fp")
    # written first: with nothing but exchanges below a join, a hot key is split over tasks
    shared = stage(sized(index.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where("n > 1"), len(keys) * fps.count()), "shared-keys")
    chunks = F.ceil(F.col("n") / F.lit(tile)).cast("int")
    dealt = index.join(shared.hint("merge"), "key").select(
        "key", "fp", chunks.alias("chunks"), F.pmod(F.xxhash64("fp"), chunks).cast("int").alias("chunk"))
    # chunk c meets every chunk: tiles (min, max); inside its own tile all pairs, else across
    tiles = dealt.select(
        "key", "fp", "chunk", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)).alias("other")
    ).select(
        "key", F.least("chunk", "other").alias("low"), F.greatest("chunk", "other").alias("high"), "fp",
        F.when(F.col("chunk") == F.col("other"), F.lit(-1)).otherwise(F.col("chunk")).alias("side"),
    )
    names = ["key", "low", "high"]
    sorted_tiles = tiles.repartition(*names).sortWithinPartitions(*names)

    def linked(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in whole_groups(batches, names):
            group = rows.groupby(names, sort=False).ngroup().to_numpy()
            fp = rows["fp"].to_numpy()
            a, b = spanning_links(group, fp.view(np.uint64), rows["side"].to_numpy(), max_bits)
            yield pd.DataFrame({"a": fp[a], "b": fp[b]})

    return sorted_tiles.mapInPandas(linked, "a long, b long")


def near_duplicates(docs: DataFrame, shingle: int = SHINGLE, max_bits: int = MAX_BITS,
                    id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, th, fp, root, component_id), a row for each row of ``docs``: ``root`` is the
    least fingerprint of the component, ``component_id`` its smallest id.

    Rows link if their fingerprints differ in at most ``max_bits`` bits; a component is what
    links reach. Texts without words (null, empty, blank) have fingerprint 0 and link like
    any other; equal texts link always. Null ids take part but are no component id unless
    the component has no other; repeated rows and ids are rows like others. An empty table
    gives no rows. Only distinct fingerprints are indexed, compared and contracted; groups
    of copies of any size are one row there.
    """
    rows = stage(fingerprints(docs, shingle, id_col, text_col), "fingerprints")
    distinct = stage(rows.groupBy("fp").agg(F.min("doc_id").alias("least")), "distinct")
    n = distinct.count()
    roots = components(near_links(distinct, max_bits))
    placed = distinct.join(roots.hint("merge"), distinct["fp"] == roots["node"], "left").select(
        "fp", "least", F.coalesce("root", "fp").alias("root"))
    placed = stage(sized(placed, n), "roots")
    unstage(distinct)
    ids = stage(sized(placed.groupBy("root").agg(F.min("least").alias("component_id")), n), "component-ids")
    by_fp = placed.join(ids.hint("merge"), "root").select("fp", "root", "component_id")
    return rows.join(by_fp.hint("merge"), "fp").select("doc_id", "th", "fp", "root", "component_id")


def keep_one(docs: DataFrame, shingle: int = SHINGLE, max_bits: int = MAX_BITS) -> DataFrame:
    """The rows of ``docs`` (with all columns) less all but one document of each component:
    the one of the smallest id (ids before null, then by text hash) stays, once."""
    found = near_duplicates(docs, shingle, max_bits)
    order = F.struct(F.col("doc_id").isNull().alias("n"), "doc_id", "th")
    chosen = found.groupBy("root").agg(F.min(order).alias("o")).select("o.doc_id", "o.th")
    keyed = docs.select(F.struct("*").alias("whole"), F.col("doc_id").cast("long").alias("id"),
                        F.xxhash64(F.coalesce(F.col("text").cast("string"), F.lit(""))).alias("hash"))
    kept = keyed.join(chosen.hint("merge"), keyed["id"].eqNullSafe(chosen["doc_id"]) & (keyed["hash"] == chosen["th"]), "left_semi")
    return kept.dropDuplicates(["id", "hash"]).select("whole.*")
