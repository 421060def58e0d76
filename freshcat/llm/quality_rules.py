"""Quality rules: text counts and a hashed n-gram log-likelihood ratio (DataFrame only).

Words and word pairs are hashed into buckets. Two multinomials over the buckets are counted
over whole corpora: the trusted target and the raw corpus. A document's score is the mean
over its n-grams of log(p_target / p_raw); a fixed threshold decides for every document.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from freshcat.llm.common import as_row, id_text, split_words, stage
from freshcat.operators.reduce import maybe_in

BUCKETS = 65_521
SMOOTHING = 1.0
#: Mean log ratio below which a document is rejected.
THRESHOLD = -0.2
MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
#: Trusted ids up to which they are broadcast; beyond, texts that may be trusted go to their ids.
BROADCAST_IDS = 2_000_000
SYMBOLS = "#*$%&|<>"


def with_codes(texts: DataFrame) -> DataFrame:
    """``texts`` plus ``codes``: the XXH64 (seed 42) of every word, an array of longs that is
    computed once a text; everything below works on it."""
    words = texts.select("*", split_words(F.col("text")).alias("words"))
    return words.select("*", F.inline(as_row(codes=F.transform("words", lambda w: F.xxhash64(w)))))


def bucket_of(code: Column, buckets: int) -> Column:
    """Bucket of a word."""
    return F.pmod(code, F.lit(buckets)).cast("int")


def pair_bucket_of(code: Column, after: Column, buckets: int) -> Column:
    """Bucket of a pair of neighbours, from B to 2 B - 1; null without a second word."""
    return F.when(after.isNotNull(), F.pmod(F.xxhash64(code, after), F.lit(buckets)).cast("int") + F.lit(buckets))


def with_repeat_words(coded: DataFrame) -> DataFrame:
    """Plus n_repeat_words: words in 3-word windows that occur twice or more in the text
    (windows by 64-bit hash). Each step's array is computed once (see ``as_row``)."""
    last = F.size("codes") - 3
    at = F.when(last >= 0, F.sequence(F.lit(0), last)).otherwise(F.array().cast("array<int>"))
    window = lambda i: F.xxhash64(F.get("codes", i), F.get("codes", i + 1), F.get("codes", i + 2))
    hashed = coded.select("*", F.inline(as_row(windows=F.transform(at, window))))
    # most texts have no such window and never sort
    some = F.size(F.array_distinct("windows")) < F.size("windows")
    ordered = hashed.select("*", F.inline(as_row(ordered=F.when(some, F.sort_array("windows")).otherwise(F.array().cast("array<long>")))))
    again = F.filter("ordered", lambda h, i: h == F.get("ordered", i + 1))
    found = ordered.select("*", F.inline(as_row(again=F.array_distinct(again))))
    # a few hashes are looked up one by one; many are found as neighbours in hash order
    few = F.filter(at, lambda i: F.array_contains("again", F.get("windows", i)))
    placed = F.sort_array(F.transform("windows", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    twice = F.zip_with(placed, F.slice(placed, F.lit(2), F.size("windows")), lambda x, y: F.when(x["h"] == y["h"], F.array(x["i"], y["i"])))
    many = F.flatten(F.filter(twice, lambda x: x.isNotNull()))
    starts = F.when(F.size("again") <= 32, few).otherwise(many)
    covered = F.size(F.array_distinct(F.flatten(F.transform(starts, lambda i: F.array(i, i + 1, i + 2)))))
    return found.select(
        *coded.columns, F.when(F.size("again") == 0, F.lit(0)).otherwise(covered).cast("long").alias("n_repeat_words"))


def gram_ratios(docs: DataFrame, target_ids: DataFrame, buckets: int = BUCKETS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(bucket, ratio): log(p_target / p_raw) of every bucket that occurs, smoothed; at most
    2 x ``buckets`` rows at any corpus size. Both corpora are counted whole; without target
    n-grams every ratio is 0."""
    ids = target_ids.select(F.col(target_ids.columns[0]).cast("long").alias("target_id")).distinct()
    ids = stage(ids, "target-ids")
    texts = docs.select(F.col(id_col).cast("long").alias("id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))

    def grams(rows: DataFrame) -> DataFrame:
        """A row for each word and pair. They are made, hashed and summed in one generated loop.
        Outer: for an inner explode Spark adds a filter on the array below it, and computes it twice."""
        each = with_codes(rows).select("trusted", "codes", F.posexplode_outer("codes").alias("at", "code"))
        after = F.get("codes", F.col("at") + 1)
        both = F.array(bucket_of(F.col("code"), buckets), pair_bucket_of(F.col("code"), after, buckets))
        return each.select("trusted", F.explode(both).alias("bucket")).where(F.col("bucket").isNotNull())

    if ids.count() <= BROADCAST_IDS:
        flagged = texts.join(F.broadcast(ids), texts["id"] == ids["target_id"], "left").select(F.col("target_id").isNotNull().cast("int").alias("trusted"), "text")
        counts = grams(flagged).groupBy("bucket").agg(F.count(F.lit(1)).alias("raw"), F.sum("trusted").alias("target"))
    else:
        # all texts are counted where they are; only texts that a filter of fixed size takes for
        # trusted are shuffled to their ids
        near = maybe_in(texts, "id", ids, "target_id")
        trusted = near.join(ids.hint("merge"), near["id"] == ids["target_id"], "left_semi")
        raw, target = (
            grams(rows.select(F.lit(1).alias("trusted"), "text")).groupBy("bucket").agg(F.count(F.lit(1)).alias(name))
            for rows, name in ((texts, "raw"), (trusted, "target")))
        counts = raw.join(target, "bucket", "left").select("bucket", "raw", F.coalesce("target", F.lit(0)).alias("target"))
    counts = stage(counts, "gram-counts")
    raw, target = counts.agg(F.sum("raw"), F.sum("target")).first()
    if not target:
        return counts.select("bucket", F.lit(0.0).alias("ratio"))
    # smoothing in proportion to the corpora: a bucket as rare in both has a ratio near 0
    share = F.col("target") * F.lit(raw / target)
    return counts.select("bucket", F.log((share + SMOOTHING) / (F.col("raw") + SMOOTHING)).alias("ratio"))


def ratio_table(ratios: DataFrame, buckets: int) -> Column:
    """The ratios of all 2 x ``buckets`` buckets as one array (0 where a bucket does not occur),
    a scalar subquery: Spark sends the array to the tasks, no plan holds its numbers."""
    zeros = ratios.sparkSession.range(2 * buckets).select(F.col("id").cast("int").alias("bucket"), F.lit(0.0).alias("ratio"))
    each = ratios.select("bucket", "ratio").unionByName(zeros).groupBy("bucket").agg(F.sum("ratio").alias("ratio"))
    placed = F.array_sort(F.collect_list(F.struct("bucket", "ratio")))
    return each.agg(F.transform(placed, lambda x: x["ratio"]).alias("ratios")).scalar()


def judge(texts: DataFrame, ratios: DataFrame, buckets: int, threshold: float) -> DataFrame:
    """``texts`` (with a column ``text`` that is never null) plus the columns of
    :func:`quality_rules`. Every row is judged by itself: no shuffle, no join."""
    # subqueries may not stand in a lambda; the column is read once, so the optimizer puts it there
    # and no row carries the array
    codes = with_repeat_words(with_codes(texts)).select("*", ratio_table(ratios, buckets).alias("ratios"))
    code, n = (lambda i: F.get("codes", i)), F.size("codes")
    grams = lambda i: F.array(bucket_of(code(i), buckets), pair_bucket_of(code(i), code(i + 1), buckets))
    places = F.flatten(F.transform(F.sequence(F.lit(0), n - 1), grams))
    total = F.aggregate(places, F.lit(0.0), lambda s, b: s + F.coalesce(F.get("ratios", b), F.lit(0.0)))
    lines = F.filter(F.split("text", "\n"), lambda x: x.rlike("[^\\x20\\x09-\\x0D]"))
    counted = codes.select(
        *texts.columns, n.cast("long").alias("n_words"),
        F.length(F.array_join("words", "")).cast("long").alias("word_chars"),
        F.length(F.regexp_replace("text", f"[^{SYMBOLS}]+", "")).cast("long").alias("n_symbols"),
        (F.size(lines) - F.size(F.array_distinct(lines))).cast("long").alias("n_dup_lines"),
        "n_repeat_words",
        F.when(n > 0, F.round(total / (2 * n - 1), 9)).otherwise(F.lit(0.0)).alias("score"),
    )
    failed = (F.col("n_words") < MIN_WORDS) | (F.col("n_repeat_words") * 100 > F.col("n_words") * MAX_REPEAT_PERCENT)
    return counted.select("*", failed.alias("base_failed"), (~failed & (F.col("score") >= threshold)).alias("kept"))


def quality_rules(docs: DataFrame, target_ids: DataFrame, buckets: int = BUCKETS, threshold: float = THRESHOLD,
                  id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
    score, kept), a row for each row of ``docs``; ``target_ids`` names the trusted documents.

    ``base_failed``: fewer than 50 words, or over half of the words in 3-word windows that
    occur twice or more. ``kept``: not base_failed and ``score`` >= ``threshold``. Score 0
    where a text has no word. A null or empty text has no words and fails; repeated rows and
    ids count and are judged each for themselves, also in the corpus counts; null ids are
    never trusted. Without trusted text every score is 0 and the base rules decide alone. An
    empty table gives no rows. Windows are compared by 64-bit hash within a document.
    """
    ratios = gram_ratios(docs, target_ids, buckets, id_col, text_col)
    return judge(id_text(docs, id_col, text_col), ratios, buckets, threshold).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "score", "kept")


def keep_good(docs: DataFrame, target_ids: DataFrame, buckets: int = BUCKETS, threshold: float = THRESHOLD,
              id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that :func:`quality_rules` keeps, with all their columns."""
    ratios = gram_ratios(docs, target_ids, buckets, id_col, text_col)
    whole = docs.select(F.struct("*").alias("whole"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    return judge(whole, ratios, buckets, threshold).where("kept").select("whole.*")


def trusted_ids(labels: DataFrame) -> DataFrame:
    """Ids of documents labelled good and not toxic (a null label is neither)."""
    return labels.where((F.col("quality") == 1) & (F.col("toxic") == 0)).select("doc_id")
