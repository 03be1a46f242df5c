"""Roll-ups: corpus totals, per source, language shares, lengths, histograms."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loomtext.functions.text import digest, key_strip, known_sources, token_count


def corpus_totals(rows: DataFrame, text: str = "text") -> DataFrame:
    """One row: examples, tokens, chars, UTF-8 bytes, blank texts and averages (0 without rows)."""
    t = F.coalesce(F.col(text), F.lit(""))
    totals = rows.agg(
        F.count(F.lit(1)).alias("examples"), F.coalesce(F.sum(token_count(t)), F.lit(0)).alias("tokens"), F.coalesce(F.sum(F.length(t).cast("long")), F.lit(0)).alias("chars"),
        F.coalesce(F.sum(F.octet_length(t).cast("long")), F.lit(0)).alias("bytes"), F.count_if(key_strip(t) == "").alias("empty_examples"),
    )
    per = lambda c: F.coalesce(F.col(c) / F.nullif(F.col("examples"), F.lit(0)), F.lit(0.0))
    return totals.select("*", per("tokens").alias("avg_tokens"), per("chars").alias("avg_chars"))


def stats_by_source(rows: DataFrame, text: str = "text", sources: str = "sources") -> DataFrame:
    """Examples, tokens, chars and average tokens of each listed source; a row counts once for each listing."""
    t = F.coalesce(F.col(text), F.lit(""))
    parts = rows.select(token_count(t).alias("tokens"), F.length(t).cast("long").alias("chars"), F.explode(known_sources(F.col(sources))).alias("source"))
    grouped = parts.groupBy("source").agg(F.count(F.lit(1)).alias("examples"), F.sum("tokens").alias("tokens"), F.sum("chars").alias("chars"))
    return grouped.withColumn("avg_tokens", F.col("tokens") / F.col("examples"))


def language_share(rows: DataFrame, label: str, conf: str, target: str, *by: str) -> DataFrame:
    """Evaluated, target count and percentage, mean confidence in the target and top language (ties by name), by group."""
    counts = rows.groupBy(*by, label).agg(F.count(F.lit(1)).alias("n"), F.sum(conf).alias("c"))
    hit = F.col(label) == target
    return counts.groupBy(*by).agg(
        F.sum("n").alias("evaluated"), F.coalesce(F.sum(F.when(hit, F.col("n"))), F.lit(0)).alias("target"),
        (100.0 * F.coalesce(F.sum(F.when(hit, F.col("n"))), F.lit(0)) / F.sum("n")).alias("target_pct"),
        F.coalesce(F.sum(F.when(hit, F.col("c"))) / F.sum(F.when(hit, F.col("n"))), F.lit(0.0)).alias("target_conf"),
        F.min_by(label, F.struct(-F.col("n"), F.col(label))).alias("top_lang"),
    )


def histogram(rows: DataFrame, value: Column, name: str, top: int | None = None) -> DataFrame:
    """(name, n_rows) by count, ties by value; the ``top`` most common or all."""
    out = rows.select(value.alias(name)).groupBy(name).agg(F.count(F.lit(1)).alias("n_rows")).orderBy(F.desc("n_rows"), name)
    return out if top is None else out.limit(top)


def source_histogram(rows: DataFrame, sources: str = "sources", top: int | None = None) -> DataFrame:
    return histogram(rows.select(F.explode(known_sources(F.col(sources))).alias("source")), F.col("source"), "source", top)


def duplicate_rate(rows: DataFrame, text: str = "text") -> DataFrame:
    """One row: n, distinct K2 keys (null and blank are one) and the percentage of duplicates."""
    keys = rows.groupBy(digest(key_strip(F.col(text))).alias("key")).agg(F.count(F.lit(1)).alias("c"))
    out = keys.agg(F.coalesce(F.sum("c"), F.lit(0)).alias("n"), F.count(F.lit(1)).alias("distinct_keys"))
    return out.withColumn("duplicate_pct", F.coalesce(100.0 * (F.col("n") - F.col("distinct_keys")) / F.nullif(F.col("n"), F.lit(0)), F.lit(0.0)))


def length_stats(rows: DataFrame, length: Column, *by: str) -> DataFrame:
    """Count, least, greatest, mean and upper median of ``length`` by group, from counts of each value."""
    counts = rows.groupBy(*by, length.cast("long").alias("length")).agg(F.count(F.lit(1)).alias("c"))
    whole = Window.partitionBy(*by)
    upto = F.sum("c").over(whole.orderBy("length").rowsBetween(Window.unboundedPreceding, 0))
    ranked = counts.withColumn("upto", upto).withColumn("n", F.sum("c").over(whole))
    middle = F.floor(F.col("n") / 2) + 1
    return ranked.groupBy(*by).agg(
        F.sum("c").alias("n"), F.min("length").alias("min_len"), F.max("length").alias("max_len"), (F.sum(F.col("length") * F.col("c")) / F.sum("c")).alias("avg_len"),
        F.min(F.when(F.col("upto") >= middle, F.col("length"))).alias("upper_median"),
    )


def top_k_per_group(rows: DataFrame, group: str, value: Column, name: str, k: int) -> DataFrame:
    """The ``k`` most common values of each group, ties by value descending."""
    counts = rows.groupBy(group, value.alias(name)).agg(F.count(F.lit(1)).alias("n_rows"))
    nth = F.row_number().over(Window.partitionBy(group).orderBy(F.desc("n_rows"), F.desc(name)))
    return counts.withColumn("nth", nth).where(F.col("nth") <= k)


def category_totals(rows: DataFrame, categories: str, words: Column, top: int = 10) -> DataFrame:
    """The ``top`` categories with their count and the words of their articles, each article's words once a category."""
    each = rows.select(F.explode(categories).alias("category")).groupBy("category").agg(F.count(F.lit(1)).alias("n_listed"))
    once = rows.select(F.explode(F.array_distinct(categories)).alias("category"), words.cast("long").alias("w")).groupBy("category").agg(F.sum("w").alias("words"))
    return each.join(once, "category").orderBy(F.desc("n_listed"), "category").limit(top)


def article_totals(rows: DataFrame, words: Column, videos: Column) -> DataFrame:
    """One row: articles, words, mean, estimated MB (seven bytes a word), articles with videos, videos, videos an article."""
    out = rows.agg(F.count(F.lit(1)).alias("articles"), F.coalesce(F.sum(words.cast("long")), F.lit(0)).alias("words"), F.count_if(videos > 0).alias("with_videos"), F.coalesce(F.sum(videos.cast("long")), F.lit(0)).alias("videos"))
    per = lambda c: F.coalesce(F.col(c) / F.nullif(F.col("articles"), F.lit(0)), F.lit(0.0))
    return out.select("*", per("words").alias("avg_words"), (F.col("words") * 7 / (1024.0 * 1024.0)).alias("est_mb"), per("videos").alias("videos_per_article"))


def dataset_profile(rows: DataFrame, text: str = "text", source: str = "source") -> DataFrame:
    """One row: rows, texts that are not null, their mean length and the number of sources."""
    return rows.agg(F.count(F.lit(1)).alias("n_rows"), F.count(text).alias("n_texts"), F.avg(F.length(text)).alias("avg_len"), F.countDistinct(source).alias("n_sources"))


def validation_report(rows: DataFrame, reason: str, words: str, confidence: str, language: str, mismatch: str = "not_target", top: int = 5) -> DataFrame:
    """One row of a validated table: how many passed and were rejected, words and confidence of what passed, and the
    ``top`` languages of the rows rejected for their language, most common first and ties by name."""
    passed, wrong = F.col(reason) == "passed", F.col(reason) == mismatch
    counts = rows.groupBy(F.when(wrong, F.col(language)).alias("l"), wrong.alias("w")).agg(
        F.count(F.lit(1)).alias("n"), F.count_if(passed).alias("p"), F.sum(F.when(passed, F.col(words))).alias("words"),
        F.sum(F.when(passed, F.col(confidence))).alias("c"), F.min(F.when(passed, F.col(confidence))).alias("lo"), F.max(F.when(passed, F.col(confidence))).alias("hi"),
    )
    zero = F.lit(0).cast("long")
    out = counts.agg(
        F.coalesce(F.sum("n"), zero).alias("total"), F.coalesce(F.sum("p"), zero).alias("passed"), F.coalesce(F.sum("words"), zero).alias("words"),
        F.sum("c").alias("_c"), F.min("lo").alias("min_confidence"), F.max("hi").alias("max_confidence"),
        F.slice(F.array_sort(F.collect_list(F.when(F.col("w"), F.struct((-F.col("n")).alias("n"), F.col("l").alias("l"))))), 1, top).alias("_top"),
    )
    share = lambda n: F.coalesce(100.0 * n / F.nullif(F.col("total"), zero), F.lit(0.0))
    return out.select(
        "total", "passed", (F.col("total") - F.col("passed")).alias("rejected"), share(F.col("passed")).alias("passed_pct"), share(F.col("total") - F.col("passed")).alias("rejected_pct"), "words",
        (F.col("words") / F.nullif(F.col("passed"), zero)).alias("avg_words"), (F.col("words") * 7 / (1024.0 * 1024.0)).alias("est_mb"), (F.col("_c") / F.nullif(F.col("passed"), zero)).alias("avg_confidence"),
        "min_confidence", "max_confidence", F.transform("_top", lambda x: F.concat_ws(":", x["l"], (-x["n"]).cast("string"))).alias("top_rejected"),
    )


def dataset_preview(rows: DataFrame, key: str, source: str = "source", first: int = 10) -> DataFrame:
    """One row: the ``first`` sources by name, and the row with the least key as a sample."""
    names = rows.select(F.col(source)).where(F.col(source).isNotNull()).distinct().orderBy(source).limit(first).agg(F.array_sort(F.collect_list(source)).alias("first_sources"))
    return names.crossJoin(F.broadcast(rows.agg(F.min_by(F.struct("*"), F.col(key)).alias("sample"))))


def language_top(rows: DataFrame, label: str, top: int = 20) -> DataFrame:
    """(label, n_rows, pct) of the ``top`` most common labels, percentages of all rows, ties by name."""
    counts = rows.groupBy(label).agg(F.count(F.lit(1)).alias("n_rows"))
    total = counts.agg(F.sum("n_rows").alias("total"))
    shares = counts.crossJoin(F.broadcast(total)).select(label, "n_rows", (100.0 * F.col("n_rows") / F.col("total")).alias("pct"))
    return shares.orderBy(F.desc("n_rows"), label).limit(top)


def sources_with_language(by_source: DataFrame, languages: DataFrame) -> DataFrame:
    """Source roll-up with the language columns of the same source, null where it was not evaluated."""
    return by_source.join(languages, "source", "left")


def total_duration(videos: DataFrame, seconds: str = "duration_seconds", available: str = "available") -> DataFrame:
    """One row: available videos, their summed duration, and unavailable ones; a null flag is unavailable."""
    ok = F.coalesce(F.col(available), F.lit(False))
    return videos.agg(F.count_if(ok).alias("n_available"), F.coalesce(F.sum(F.when(ok, F.col(seconds).cast("long"))), F.lit(0)).alias("seconds"), F.count_if(~ok).alias("n_missing"))


def outcome_counts(rows: DataFrame, status: str = "status") -> DataFrame:
    """(status, n_rows) of a crawl or a transcription run."""
    return rows.groupBy(F.coalesce(F.col(status), F.lit("unknown")).alias("status")).agg(F.count(F.lit(1)).alias("n_rows"))


def group_words(rows: DataFrame, group: str, words: Column, default: str) -> DataFrame:
    """Rows and words of each group, nulls under ``default``, by words descending."""
    return rows.groupBy(F.coalesce(F.col(group), F.lit(default)).alias(group)).agg(F.count(F.lit(1)).alias("n_rows"), F.sum(words.cast("long")).alias("words")).orderBy(F.desc("words"), group)
