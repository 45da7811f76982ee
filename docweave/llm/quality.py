"""Quality rules: fixed text rules, then a hashed n-gram log-likelihood ratio.

The method compares two multinomials over hashed word unigrams and bigrams:
one of trusted target documents, one of the raw corpus. A document's score is
the mean over its n-grams of log p_target - log p_raw, and documents at or
above a fixed threshold stay. Everything is made of SQL expressions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from docweave.llm.common import NOT_WHITE, WHITE, count_upto, let, table, text_or_empty, words

#: Hash buckets of the multinomials.
BUCKETS = 1 << 17
#: Trusted documents that the target is fitted on, at most: those of the
#: labelled documents of good quality whose ids hash lowest.
TARGET_DOCUMENTS = 4_000
#: Pseudo-counts that draw a bucket's ratio to 1 where there is little evidence.
SMOOTHING = 10.0
#: The least mean log ratio of a document that stays. Ordinary prose that is not in the target lies near 0
#: with thousands of target documents, and above -0.1 with some 150 of them.
THRESHOLD = -0.12
WINDOW = 8


def word_hashes(ws: Column) -> Column:
    return F.transform(ws, lambda w: F.xxhash64(w))


def buckets_of(hashes: Column) -> Column:
    """The buckets of all unigrams and bigrams of a text, as int array; hashes may be a lambda variable."""
    mask = F.lit(BUCKETS - 1).cast("long")
    one = F.transform(hashes, lambda h: h.bitwiseAND(mask).cast("int"))
    two = F.transform(count_upto(F.size(hashes) - 1), lambda i: F.xxhash64(F.get(hashes, i), F.get(hashes, i + 1)).bitwiseAND(mask).cast("int"))
    return F.concat(one, two)


def fit(docs: DataFrame, trusted: DataFrame) -> DataFrame:
    """One row with `weights`: for each bucket, log p_target - log p_raw.

    docs (doc_id, text) are the raw corpus, all of it; trusted (doc_id) are
    at most TARGET_DOCUMENTS ids. Counts are summed on the map side to a row
    per bucket and task before they are shuffled.
    """
    ids = F.broadcast(trusted.select("doc_id", F.lit(1).alias("_t")).distinct())  # TARGET_DOCUMENTS rows at most
    marked = docs.join(ids, "doc_id", "left")
    grams = marked.select("_t", let(word_hashes(words(text_or_empty("text"))), buckets_of).alias("_b")).select("_t", F.explode("_b").alias("bucket"))
    counts = grams.groupBy("bucket").agg(F.count(F.lit(1)).alias("raw"), F.count("_t").alias("target"))
    every = docs.sparkSession.range(BUCKETS).select(F.col("id").cast("int").alias("bucket"))
    full = every.join(counts, "bucket", "left").fillna(0, ["raw", "target"])
    row = full.agg(F.sort_array(F.collect_list(F.struct("bucket", "raw", "target"))).alias("c"), F.sum("raw").alias("n_raw"), F.sum("target").alias("n_target"))

    def weight(c: Column) -> Column:
        # what the bucket would have in the target if target and corpus were alike
        expected = F.col("n_target") * c["raw"] / F.greatest(F.col("n_raw"), F.lit(1))
        return F.log((c["target"] + SMOOTHING) / (expected + SMOOTHING))

    return row.select(F.transform("c", weight).alias("weights"))


def trusted_ids(labels: DataFrame) -> DataFrame:
    """The labelled documents that the target is fitted on: good quality, not toxic, lowest hash first."""
    good = labels.where((F.col("quality") == 1) & (F.coalesce(F.col("toxic"), F.lit(0)) == 0) & F.col("doc_id").isNotNull())
    return good.select("doc_id").distinct().orderBy(F.xxhash64("doc_id", F.lit(3)), "doc_id").limit(TARGET_DOCUMENTS)


def repeated_words(hashes: Column) -> Column:
    """How many words stand in a window of WINDOW words that the text has twice or more."""

    def covered(windows: Column) -> Column:
        # windows by value; those equal to a neighbour occur again
        def marked(by_value: Column) -> Column:
            value = lambda i: F.get(by_value, i)["h"]
            twice = F.filter(count_upto(F.size(by_value)), lambda i: F.coalesce(value(i) == value(i - 1), F.lit(False)) | F.coalesce(value(i) == value(i + 1), F.lit(False)))
            starts = F.sort_array(F.transform(twice, lambda i: F.get(by_value, i)["i"]))
            return let(starts, lambda s: F.aggregate(F.transform(s, lambda x, j: F.least(F.lit(WINDOW), F.get(s, j + 1) - x)), F.lit(0), lambda a, x: a + x))

        return F.when(
            F.size(F.array_distinct(windows)) < F.size(windows),
            let(F.sort_array(F.transform(windows, lambda h, i: F.struct(h.alias("h"), i.alias("i")))), marked),
        ).otherwise(0)

    return let(F.transform(count_upto(F.size(hashes) - (WINDOW - 1)), lambda i: F.xxhash64(*[F.get(hashes, i + k) for k in range(WINDOW)])), covered)


def scored(text: Column, weights: Column) -> Column:
    """n_words, n_repeat_words and score (null without words) of a non-null text, as one struct; weights: what fit() gives."""
    return let(
        word_hashes(words(text)),
        lambda hs: F.struct(
            F.size(hs).cast("long").alias("n_words"),
            repeated_words(hs).cast("long").alias("n_repeat_words"),
            let(buckets_of(hs), lambda bs: F.aggregate(bs, F.lit(0.0), lambda a, b: a + F.get(weights, b)) / F.nullif(F.size(bs), F.lit(0))).alias("score"),
        ),
    )


def base_failed(n_words: Column, n_repeat_words: Column) -> Column:
    """Under 20 words, or over 30 percent of the words in repeated windows."""
    return (n_words < 20) | (n_repeat_words * 100 > n_words * 30)


def measures(docs: DataFrame, weights: Column) -> DataFrame:
    """docs (with text) plus n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, score (null without words)."""
    text = text_or_empty("text")
    lines = F.filter(F.split(text, "\n"), lambda s: F.btrim(s, F.lit(WHITE)) != "")
    return docs.withColumn("_weights", weights).withColumn("_m", scored(text, F.col("_weights"))).select(
        *docs.columns,
        F.col("_m.n_words").alias("n_words"),
        (F.length(text) - F.length(F.regexp_replace(text, NOT_WHITE, ""))).cast("long").alias("word_chars"),
        F.length(F.regexp_replace(text, "[^#*$%&|<>]+", "")).cast("long").alias("n_symbols"),
        let(lines, lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("n_dup_lines"),
        F.col("_m.n_repeat_words").alias("n_repeat_words"),
        F.col("_m.score").alias("score"),
    )


def judge(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """docs plus the measures, base_failed and kept.

    kept: not base_failed and score >= threshold. Null texts have no words and
    fail. Without labelled documents the target is uniform, which tells
    nothing; then the score is 0 for all and only the base rules hold.
    Repeated rows are judged alike, and an empty table gives an empty one.
    Columns of the same names in docs give way.
    """
    own = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "score", "base_failed", "kept", "_m", "_weights")
    docs = docs.drop(*own)
    model = fit(docs.select("doc_id", "text"), trusted_ids(labels))
    judged = measures(docs, model.select("weights").scalar())
    failed = base_failed(F.col("n_words"), F.col("n_repeat_words"))
    return judged.withColumn("base_failed", failed).withColumn("kept", ~F.col("base_failed") & (F.coalesce(F.col("score"), F.lit(0.0)) >= threshold))


def keep(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of docs (doc_id, text, any further columns) that judge() keeps, as they are. Each text is measured once."""
    weights = fit(docs.select("doc_id", "text"), trusted_ids(labels)).select("weights").scalar()
    # further columns travel in a struct, where they clash with nothing
    rows = docs.select(text_or_empty("text").alias("text"), F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_all")).withColumn("_weights", weights)
    good = let(scored(F.col("text"), F.col("_weights")), lambda m: ~base_failed(m["n_words"], m["n_repeat_words"]) & (F.coalesce(m["score"], F.lit(0.0)) >= threshold))
    return rows.where(good).select("_all.*")


def op3_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents with their measures and the verdict."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return judge(docs, table(spark, sf_dir, "labels")).select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "score")
