"""Ratings and review text: histograms, per-category/country ratings,
tokenization, term counts, top terms and rating-vs-purchase impact.

Tokenization is native (``regexp_replace`` + ``split`` + ``filter``), so the
term counts run as codegen'd Generate -> partial HashAggregate -> Exchange.
A very common term is a hot key only until the map-side combine.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sessionlens.functions.text import tokens
from sessionlens.schema import REVIEW_NEGATIVE, REVIEW_POSITIVE


def _rated(df: DataFrame) -> DataFrame:
    return df.filter(F.col("review_score").isNotNull())


def review_distribution(df: DataFrame) -> DataFrame:
    return (_rated(df).groupBy("review_score")
            .agg(F.count(F.lit(1)).alias("count"))
            .orderBy("review_score"))


def reviews_by_category(df: DataFrame) -> DataFrame:
    return (_rated(df).groupBy("product_category", "review_category")
            .agg(F.count(F.lit(1)).alias("count"))
            .orderBy("product_category", "review_category"))


def reviews_by_country(df: DataFrame) -> DataFrame:
    return (_rated(df).groupBy("country")
            .agg(F.count("review_score").alias("review_count"),
                 F.round(F.avg("review_score"), 2).alias("avg_review_score"))
            .orderBy(F.desc("review_count"), "country"))


def review_tokens(df: DataFrame, text: str = "review_text",
                  key: str | None = None) -> DataFrame:
    """One row per token occurrence: (key, pos, term), whole texts. Without a
    key the ``session_id`` is taken, or none where there is none."""
    key = key or ("session_id" if "session_id" in df.columns else None)
    return (df.filter(F.col(text).isNotNull())
            .select(*([key] if key else []), F.posexplode(tokens(text)).alias("pos", "term")))


def term_counts(df: DataFrame, category: str, text: str = "review_text") -> DataFrame:
    """Term frequencies over the reviews of one rating bucket, most frequent first."""
    return (df.filter((F.col("review_category") == category) & F.col(text).isNotNull())
            .select(F.explode(tokens(text)).alias("term"))
            .groupBy("term").agg(F.count(F.lit(1)).alias("count"))
            .orderBy(F.desc("count"), "term"))


def positive_terms(df: DataFrame) -> DataFrame:
    return term_counts(df, REVIEW_POSITIVE)


def negative_terms(df: DataFrame) -> DataFrame:
    return term_counts(df, REVIEW_NEGATIVE)


def term_counts_by_category(df: DataFrame,
                            categories: tuple[str, ...] = (REVIEW_POSITIVE, REVIEW_NEGATIVE),
                            text: str = "review_text") -> DataFrame:
    """Both buckets in one scan: (review_category, term, count)."""
    return (df.filter(F.col("review_category").isin(*categories) & F.col(text).isNotNull())
            .select("review_category", F.explode(tokens(text)).alias("term"))
            .groupBy("review_category", "term").agg(F.count(F.lit(1)).alias("count")))


def top_terms(df: DataFrame, n: int = 10,
              categories: tuple[str, ...] = (REVIEW_POSITIVE, REVIEW_NEGATIVE)) -> DataFrame:
    """The ``n`` most frequent terms per bucket (ties by term). The limit is
    the feature here; it is planned as a per-group WindowGroupLimit."""
    w = Window.partitionBy("review_category").orderBy(F.desc("count"), F.asc("term"))
    return (term_counts_by_category(df, categories)
            .withColumn("rank", F.row_number().over(w))
            .filter(F.col("rank") <= n)
            .orderBy("review_category", "rank"))


TRACKED = 1 << 16    # terms that a task's sketch follows, at most
SURVIVORS = 4096     # terms a bucket that are counted exactly
SLOTS = 64           # sketches a bucket that are merged last


def top_terms_sketched(df: DataFrame, n: int = 10,
                       categories: tuple[str, ...] = (REVIEW_POSITIVE, REVIEW_NEGATIVE),
                       text: str = "review_text", tracked: int = TRACKED) -> DataFrame:
    """``top_terms`` for vocabularies too large to be shuffled: equal results, in
    two passes over the text. A frequent-items sketch per task and bucket, merged,
    names the terms that can be frequent; only those are counted. A term that it
    does not name occurs at most ``bound`` times: twice the sketch's error (3.5
    words in ``tracked`` at most), or as often as the last term named where the list
    is full. A bucket whose n-th count is not above that is counted in full.
    The driver holds the named terms (``SURVIVORS`` a bucket) and the top rows."""
    rated = df.filter(F.col("review_category").isin(*categories) & F.col(text).isNotNull())
    words = rated.select("review_category", F.explode(tokens(text)).alias("term"))
    named = min(SURVIVORS, tracked)
    # the sketches of many tasks meet in SLOTS tasks, and theirs in one
    slots = words.withColumn("slot", F.pmod(F.spark_partition_id(), F.lit(SLOTS))).groupBy("review_category", "slot").agg(
        F.expr(f"approx_top_k_accumulate(term, {tracked})").alias("sketch"), F.count(F.lit(1)).alias("words"))
    merged = slots.groupBy("review_category").agg(
        F.expr(f"approx_top_k_combine(sketch, {tracked})").alias("sketch"), F.sum("words").alias("words"))
    sketches = merged.select("review_category", "words",
                             F.expr(f"approx_top_k_estimate(sketch, {named})").alias("items")).collect()
    spark, kind = df.sparkSession, "review_category string, term string"
    bound = {r.review_category: max(2 * 3.5 * r.words / tracked,
                                    min((i["count"] for i in r["items"]), default=0) if len(r["items"]) == named else 0)
             for r in sketches}
    survivors = spark.createDataFrame([(r.review_category, i["item"]) for r in sketches for i in r["items"]], kind)
    order = Window.partitionBy("review_category").orderBy(F.desc("count"), F.asc("term"))

    def ranked(some: DataFrame) -> DataFrame:
        counts = some.groupBy("review_category", "term").agg(F.count(F.lit(1)).alias("count"))
        return counts.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= n)

    top = ranked(words.join(F.broadcast(survivors), ["review_category", "term"])).collect()
    last = {r.review_category: r["count"] for r in top if r["rank"] == n}
    unsure = [c for c in bound if last.get(c, 0) <= bound[c]]
    out = spark.createDataFrame([tuple(r) for r in top if r.review_category not in unsure],
                                f"{kind}, count long, rank int")
    if unsure:
        out = out.unionByName(ranked(words.filter(F.col("review_category").isin(*unsure))))
    return out.orderBy("review_category", "rank")


def review_impact(df: DataFrame) -> DataFrame:
    """Users grouped by their rounded mean rating (half-up): mean purchases
    per user and number of users."""
    per_user = (_rated(df).groupBy("user_id")
                .agg(F.avg("review_score").alias("avg_user_review"),
                     F.count("review_score").alias("review_count"),
                     F.sum("has_purchased").alias("purchase_count")))
    return (per_user.groupBy(F.round("avg_user_review").alias("rounded_review_score"))
            .agg(F.avg("purchase_count").alias("avg_purchases_per_user"),
                 F.count(F.lit(1)).alias("user_count"))
            .orderBy("rounded_review_score"))
