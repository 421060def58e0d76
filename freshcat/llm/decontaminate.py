"""Benchmark decontamination by SimHash of item-sized windows (DataFrame operations only).

A window is a run of as many words as a benchmark item has. Windows and items get SimHash
fingerprints over their word shingles; multi-index Hamming blocks find all fingerprints
within a radius; the exact weighted similarity of the shingles decides.

Windows are only made where the first of the most similar ones can be. A window whose last
shingle is not the item's can move a word to the left and lose nothing, so only windows that
end with a shingle of the item count (and the one at the document's start); and a window can
only pass with enough places of the item's shingles in it, in whatever order.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from freshcat.llm.common import stage

SHINGLE = 5
SIMILARITY = 0.8
#: Bits that two fingerprints may differ in, blocks, and bits of a block that may differ in
#: an index look-up: 10 blocks and 19 bits leave a block with at most 1.
RADIUS, BLOCKS, FLIPS = 19, 10, 1
#: Rows of the item tables up to which they are broadcast; beyond, the same joins shuffle.
BROADCAST_ROWS = 1_000_000
#: Letters, marks and digits make words; case does not count.
SEPARATORS = "[^\\p{L}\\p{M}\\p{N}]+"
LANES = 32


def words_of(text: Column) -> Column:
    """Lower-case words of a text (null: none)."""
    found = F.split(F.lower(F.coalesce(text.cast("string"), F.lit(""))), SEPARATORS)
    inner = F.when(F.get(found, F.lit(0)) == "", F.slice(found, F.lit(2), F.size(found))).otherwise(found)
    return F.when(F.element_at(F.concat(F.array(F.lit("x")), inner), -1) == "", F.slice(inner, F.lit(1), F.size(inner) - 1)).otherwise(inner)


def bounded(df: DataFrame) -> DataFrame:
    """A staged table of benchmark items as a broadcast side, if it is counted to be small."""
    return F.broadcast(df) if df.count() <= BROADCAST_ROWS else df


def fingerprints(windows: DataFrame, keys: list[str], shingles: str) -> DataFrame:
    """``keys`` and ``fp``: bit i is 1 if it is set in over half of the row's shingle hashes.

    Thirty-two sums of two 32-bit lanes each count all 64 bits; no text has 2^31 shingles."""
    each = windows.select(*keys, F.explode(shingles).alias("s")).select(*keys, F.xxhash64("s").alias("h"))
    lanes = F.lit(0x0000000100000001)
    sums = each.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n"),
        *[F.sum(F.shiftrightunsigned("h", k).bitwiseAND(lanes)).alias(f"s{k}") for k in range(LANES)],
    )
    fp = F.lit(0).cast("long")
    for k in range(LANES):
        for lane in range(2):
            count = F.shiftrightunsigned(f"s{k}", LANES * lane).bitwiseAND(F.lit(0xFFFFFFFF))
            fp = fp.bitwiseOR(F.when(count * 2 > F.col("n"), F.shiftleft(F.lit(1).cast("long"), k + LANES * lane)).otherwise(F.lit(0).cast("long")))
    return sums.select(*keys, fp.alias("fp"))


def block_keys(fp: Column, flips: bool) -> Column:
    """Array of (block, value) longs of a fingerprint; with ``flips`` also every value one
    bit away."""
    cuts = [round(64 * b / BLOCKS) for b in range(BLOCKS + 1)]
    keys = []
    for b in range(BLOCKS):
        bits = cuts[b + 1] - cuts[b]
        value = F.shiftrightunsigned(fp, cuts[b]).bitwiseAND(F.lit((1 << bits) - 1))
        for mask in [0, *(1 << i for i in range(bits if flips else 0))]:
            keys.append(value.bitwiseXOR(F.lit(mask)).bitwiseOR(F.lit(b << 32)))
    return F.array(*keys)


def shingles_of(words: Column, k: Column) -> Column:
    """Space-joined runs of ``k`` words."""
    return F.transform(F.sequence(F.lit(1), F.size(words) - k + 1), lambda i: F.array_join(F.slice(words, i, k), " "))


def contaminated(docs: DataFrame, benchmark: DataFrame, similarity: float = SIMILARITY,
                 id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """(doc_id, th, item_id, similarity, start, distance): a row for each document and item
    of which the document holds a copy: the most similar window (the first of equals).

    Similarity is the weighted Jaccard similarity of 5-word shingles, each weighted with how
    often it occurs: sum of minima over sum of maxima. It must reach ``similarity``, and the
    fingerprints must be within 19 bits. An item of fewer than 5 words is one shingle; an
    item without words (null, empty) matches nothing, as does a text without. A document
    shorter than the item is one window. ``th`` is the text's hash; rows equal in id and text
    are one document, null ids are ids. Equal items each get their rows. An empty table on
    either side gives no rows.
    """
    items = benchmark.select(
        F.col(item_col).cast("long").alias("item_id"), F.col(item_text_col).alias("text")
    ).distinct().select("item_id", words_of(F.col("text")).alias("iwords")).where(F.size("iwords") > 0).select(
        F.xxhash64("item_id", F.array_join("iwords", " ")).alias("item"), "item_id", "iwords",
        F.size("iwords").alias("length"), F.least(F.size("iwords"), F.lit(SHINGLE)).alias("k"),
    )
    items = stage(items, "items")
    sizes = sorted(r[0] for r in items.select("k").distinct().collect())  # at most five numbers

    def run_hash(words: Column, at: Column, k: int) -> Column:
        return F.xxhash64(F.lit(k), *[F.get(words, at + j) for j in range(k)])

    # 1. places of the items' shingles in the documents
    at_item = items.select("*", F.posexplode("iwords").alias("q", "w")).where(F.col("q") <= F.col("length") - F.col("k"))
    grams = stage(at_item.select(
        "item", "length", "k",
        F.coalesce(*[F.when(F.col("k") == k, run_hash(F.col("iwords"), F.col("q"), k)) for k in sizes], F.lit(0)).alias("gram"),
    ).distinct(), "item-shingles")
    keyed = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.xxhash64(F.coalesce(F.col(text_col).cast("string"), F.lit(""))).alias("th"), F.col(text_col).alias("text"))
    texts = keyed.select("doc_id", "th", words_of(F.col("text")).alias("words"))
    # outer: for an inner one Spark adds a filter on the array below, and splits texts twice
    places = texts.select("*", F.posexplode_outer("words").alias("p", "w"))
    hashes = [F.when(F.col("p") <= F.size("words") - k, run_hash(F.col("words"), F.col("p"), k)) for k in sizes]
    probed = places.select("doc_id", "th", F.size("words").alias("total"), "p", (F.explode(F.array(*hashes)) if len(hashes) > 1 else (hashes or [F.lit(None).cast("long")])[0]).alias("gram"))
    hits = probed.join(bounded(grams), "gram").groupBy("doc_id", "th", "total", "item", "length", "k").agg(F.array_sort(F.collect_set("p")).alias("places"))
    # a window of w shingles passes if it shares s with the item's i: s / (w + i - s) >= similarity
    of_window = F.least("length", "total") - F.col("k") + 1
    needed = F.ceil(F.lit(similarity) * (of_window + F.col("length") - F.col("k") + 1) / F.lit(1 + similarity) - F.lit(1e-6)).cast("int")
    hits = hits.select("doc_id", "th", "length", "k", "places", of_window.alias("w"), F.greatest(needed, F.lit(1)).alias("needed"))
    ends = F.filter("places", lambda p, i: p - F.get("places", i - F.col("needed") + 1) < F.col("w"))
    starts = hits.select("doc_id", "th", "length", "k", F.explode(ends).alias("p")).select(
        "doc_id", "th", "length", "k", F.greatest(F.col("p") - F.col("length") + F.col("k"), F.lit(0)).alias("start")).distinct()
    starts = stage(starts, "window-starts")
    # a row for each document with windows, and its words again
    few = starts.count() <= BROADCAST_ROWS
    each = starts.groupBy("doc_id", "th").agg(F.collect_list(F.struct("length", "k", "start")).alias("at"))
    each = stage(each.withColumnsRenamed({"doc_id": "s_id", "th": "s_th"}), "window-documents")
    again = keyed.join(F.broadcast(each) if few else each.hint("merge"), F.col("doc_id").eqNullSafe(F.col("s_id")) & (F.col("th") == F.col("s_th")))
    # rows equal in id and text are one document
    again = again.groupBy("doc_id", "th").agg(F.first("text").alias("text"), F.first("at").alias("at"))
    windows = again.select("doc_id", "th", words_of(F.col("text")).alias("words"), "at").select("doc_id", "th", "words", F.inline("at"))
    cut = windows.select("doc_id", "th", "length", "k", "start", F.slice("words", F.col("start") + 1, F.col("length")).alias("wwords"))
    names = ["doc_id", "th", "length", "start"]
    cut = stage(cut.select(*names, shingles_of(F.col("wwords"), F.col("k")).alias("shingles")), "window-shingles")

    # 2. fingerprints and the multi-index look-up among items of the window's size
    item_shingles = stage(items.select("item", "item_id", "length", shingles_of(F.col("iwords"), F.col("k")).alias("shingles")), "item-sets")
    item_fps = stage(fingerprints(item_shingles, ["item", "length"], "shingles"), "item-fps")
    window_fps = fingerprints(cut, names, "shingles")
    index = bounded(stage(item_fps.select("item", F.col("length").alias("ilength"), F.col("fp").alias("ifp"), F.explode(block_keys(F.col("fp"), True)).alias("block")), "item-index"))
    look = window_fps.select(*names, "fp", F.explode(block_keys(F.col("fp"), False)).alias("block"))
    distance = F.bit_count(F.col("fp").bitwiseXOR(F.col("ifp")))
    pairs = (
        look.join(index, (look["block"] == index["block"]) & (look["length"] == index["ilength"]))
        .select(*names, "item", distance.cast("long").alias("distance")).where(F.col("distance") <= RADIUS).distinct()
    )
    pairs = stage(pairs, "pairs")

    # 3. exact similarity: minima of the shingles' counts
    counted = lambda df, keys, n: df.select(*keys, F.explode("shingles").alias("s")).groupBy(*keys, "s").agg(F.count(F.lit(1)).alias(n))
    in_window = counted(cut, names, "wn").withColumnsRenamed({k: f"w_{k}" for k in names})
    in_item = counted(item_shingles, ["item"], "in").withColumnsRenamed({"item": "i_item", "s": "i_s"})
    same = F.lit(True)
    for k in names:
        same = same & F.col(k).eqNullSafe(F.col(f"w_{k}"))
    shared = (
        pairs.join(in_window, same).join(in_item, (F.col("item") == F.col("i_item")) & (F.col("s") == F.col("i_s")))
        .groupBy(*names, "item", "distance").agg(F.sum(F.least("wn", "in")).alias("shared"))
    )
    sized = (
        shared.join(cut.select(*[F.col(k).alias(f"c_{k}") for k in names], F.size("shingles").alias("wsize")),
                    F.col("doc_id").eqNullSafe(F.col("c_doc_id")) & (F.col("th") == F.col("c_th")) & (F.col("length") == F.col("c_length")) & (F.col("start") == F.col("c_start")))
        .join(item_shingles.select(F.col("item").alias("s_item"), "item_id", F.size("shingles").alias("isize")), F.col("item") == F.col("s_item"))
    )
    found = sized.select("doc_id", "th", "item_id", "item", "start", "distance", (F.col("shared") / (F.col("wsize") + F.col("isize") - F.col("shared"))).alias("similarity")).where(F.col("similarity") >= similarity)
    best = found.groupBy("doc_id", "th", "item", "item_id").agg(F.max(F.struct("similarity", (-F.col("start")).alias("m"), "distance")).alias("b"))
    return best.select("doc_id", "th", "item_id", F.round("b.similarity", 6).alias("similarity"), (-F.col("b.m")).cast("long").alias("start"), "b.distance")


def drop_contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of ``docs`` (all columns) that hold no copy of a benchmark item."""
    found = contaminated(docs, benchmark).select(F.col("doc_id").alias("c_id"), F.col("th").alias("c_th")).distinct()
    found = stage(found, "contaminated").hint("merge")
    keyed = docs.select(F.struct("*").alias("whole"), F.col("doc_id").cast("long").alias("id"), F.xxhash64(F.coalesce(F.col("text").cast("string"), F.lit(""))).alias("hash"))
    return keyed.join(found, F.col("id").eqNullSafe(F.col("c_id")) & (F.col("hash") == F.col("c_th")), "left_anti").select("whole.*")
