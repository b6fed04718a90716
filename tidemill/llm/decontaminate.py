"""Benchmark decontamination as a prefix-filtered set join, in DataFrame operations only.

Items are cut into windows of ``size`` consecutive words (a shorter item is one window); a
document is hit where a whole window occurs.

1. Words are ordered by rarity: the number of documents that hold them, counted over all
   documents. A window must be contained whole, so its necessary prefix is its rarest word.
2. All words of all documents meet the prefix words only. A document's word that is one gives
   candidates: the window's place follows from the word's offset in it (positional bound), and
   must lie inside the document (length bound).
3. Candidates are verified word for word against the document's window of the item window's
   size.

Only prefix words and their counts are broadcast, and only if their measured size is under
``BROADCAST_BYTES``; beyond it Spark shuffles the same join.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemill.llm.words import col, free_name
from tidemill.session import stage

BROADCAST_BYTES = 8 << 20
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def words_of(text: Column) -> Column:
    """Lower-cased (A-Z) runs of letters, digits and all that isn't ASCII, in order; none for null."""
    low = F.translate(F.coalesce(text.cast("string"), F.lit("")), UPPER, LOWER)
    return F.array_remove(F.split(low, r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"), "")


def _sent(words: DataFrame) -> DataFrame:
    """``words`` (column ``word``), to be broadcast if its measured size allows."""
    n = words.agg(F.sum(F.octet_length("word") + 32)).first()[0] or 0
    return F.broadcast(words) if n <= BROADCAST_BYTES else words


def item_windows(items: DataFrame, id: str, text: str, size: int) -> DataFrame:
    """``item_id`` (as text; null is empty) and ``window`` (its words) of every window of every item."""
    words = items.select(F.coalesce(col(id).cast("string"), F.lit("")).alias("item_id"), words_of(col(text)).alias("words"))
    first = F.sequence(F.lit(1), F.greatest(F.size("words") - size + 1, F.lit(1)))
    return (words.where(F.size("words") > 0).select("item_id", "words", F.explode(first).alias("i"))
            .select("item_id", F.slice("words", F.col("i"), size).alias("window")).distinct())


def contamination(docs: DataFrame, items: DataFrame, id: str = "doc_id", text: str = "text", item_id: str = "item_id",
                  item_text: str = "text", size: int = 13, share: int = 20) -> DataFrame:
    """For each document: ``id, n_words, n_hit, item_ids, contaminated, text_key``.

    ``n_hit``: words inside any occurrence of any window; ``item_ids``: the items with occurring
    windows, as sorted texts; ``contaminated``: ``n_hit > 0`` and ``share * n_hit >= n_words``.
    Null and empty texts have no words and no hits; items without words have no windows; rows of
    equal id and text get equal results, also for a null id. An empty table of documents gives
    no rows, one of items leaves all documents clean. ``text_key`` is ``xxhash64`` of the text.
    """
    windows = stage(item_windows(items, item_id, item_text, size), "bench-items")
    distinct = stage(windows.select("window").distinct().withColumn("w", F.monotonically_increasing_id()),
                     "bench-windows")
    of_item = stage(windows.join(distinct, "window").select("w", "item_id"), "bench-of-item")
    vocabulary = stage(distinct.select(F.explode("window").alias("word")).distinct(), "bench-words")

    source = docs.select(col(id).alias("id"), col(text).cast("string").alias("text"))
    own = F.struct(F.col("id"), F.xxhash64("text").alias("text_key"))  # a struct: a null id equals a null id

    # documents by word, of the windows' words
    met = source.select(F.explode(F.array_distinct(words_of(F.col("text")))).alias("word")).join(
        _sent(vocabulary), "word", "left_semi")
    held = stage(met.groupBy("word").agg(F.count(F.lit(1)).alias("held")), "bench-held")

    # each window's rarest word and its first place there; a word in no document rules its windows out
    placed = distinct.select("w", F.size("window").alias("n"), F.posexplode("window").alias("at", "word")).join(
        held, "word", "left")
    rarest = placed.groupBy("w", "n").agg(
        F.min(F.struct(F.coalesce("held", F.lit(0)).alias("held"), "word", "at")).alias("rare"))
    prefix = stage(rarest.where("rare.held > 0").select("w", "n", "rare.word", "rare.at"), "bench-prefix")

    # candidates: where prefix words stand
    seen = source.select(own.alias("own"), words_of(F.col("text")).alias("words")).select(
        "own", F.size("words").alias("n_words"), F.posexplode("words").alias("place", "word"))
    seen = seen.join(_sent(stage(prefix.select("word").distinct(), "bench-prefix-words")), "word", "left_semi")
    begin = F.col("place") - F.col("at")
    candidates = seen.join(prefix, "word").where((begin >= 0) & (begin + F.col("n") <= F.col("n_words"))).select(
        "own", begin.alias("begin"), "w")
    of_document = stage(candidates.join(distinct, "w").groupBy("own").agg(
        F.collect_set(F.struct("begin", "w", "window")).alias("candidates")), "bench-candidates")

    # verification in the document, and the words that its hits cover
    full = (source.withColumn("own", own).join(of_document, "own", "left")
            .select("own", words_of(F.col("text")).alias("words"), "candidates"))
    hits = F.filter("candidates", lambda c: F.slice("words", c["begin"] + 1, F.size(c["window"])) == c["window"])
    hits = F.transform(hits, lambda c: F.struct(c["begin"].alias("begin"), (c["begin"] + F.size(c["window"])).alias("end"),
                                                c["w"].alias("w")))
    zero = F.struct(F.lit(0).alias("n"), F.lit(0).alias("reach"))
    cover = F.aggregate(F.array_sort("hits"), zero, lambda a, h: F.struct(
        (a["n"] + F.greatest(h["end"] - F.greatest(h["begin"], a["reach"]), F.lit(0))).alias("n"),
        F.greatest(a["reach"], h["end"]).alias("reach")), lambda a: a["n"])
    scored = stage(full.select("own", F.size("words").alias("n_words"),
                               F.when(F.col("candidates").isNotNull(), hits).alias("hits"))
                   .select("own", "n_words", F.when(F.size("hits") > 0, cover).otherwise(0).alias("n_hit"),
                           F.array_distinct("hits.w").alias("ws")), "bench-scored")

    listed = scored.where("n_hit > 0").select("own", F.explode("ws").alias("w")).join(of_item, "w")
    listed = listed.groupBy("own").agg(F.sort_array(F.collect_set("item_id")).alias("item_ids"))
    out = scored.join(listed, "own", "left")
    return out.select(
        F.col("own.id").alias(id), F.col("n_words").cast("long").alias("n_words"),
        F.col("n_hit").cast("long").alias("n_hit"),
        F.coalesce("item_ids", F.array().cast("array<string>")).alias("item_ids"),
        ((F.col("n_hit") > 0) & (share * F.col("n_hit") >= F.col("n_words"))).alias("contaminated"),
        F.col("own.text_key").alias("text_key"))


def decontaminated(docs: DataFrame, items: DataFrame, id: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """The rows of ``docs`` that aren't contaminated; same columns, rows repeated as they were."""
    own = free_name(docs, "_bench_own")
    found = contamination(docs, items, id, text, **options).where("contaminated").select(
        F.struct(F.col(f"`{id}`").alias("id"), "text_key").alias(own)).distinct()
    row = F.struct(col(id).alias("id"), F.xxhash64(col(text).cast("string")).alias("text_key"))
    return docs.join(stage(found, "bench-found"), row == F.col(own), "left_anti")


def op8_prefix_filtered_windows(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    out = contamination(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    return out.select("doc_id", "n_words", "n_hit", F.size("item_ids").cast("long").alias("n_items"),
                      F.sha2(F.concat_ws(",", "item_ids"), 256).alias("items_sha256"), "contaminated")
