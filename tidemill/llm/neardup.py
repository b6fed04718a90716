"""Near-duplicate documents by bottom-k sketches from one hash function.

1. Every text's set of word shingles is hashed once; its ``k`` smallest values are the
   sketch. Equal sets are one class from here on (copies never meet in pairs).
2. Inverted lists of the retained values generate overlaps. Two sets of similarity 0.8 share
   at least ``shared`` of their retained values (see ``_least``), so of each sketch, ordered by
   how many classes hold a value, only the first ``size - least + 1`` values need a list.
   The most common values fall away; no list is cut.
3. Every list links its members to one head, twice with other heads: rows grow with the lists,
   not with their squares.
4. Members of lists that are still in several parts are compared on their whole sets: each
   set's rarest fifth (which two similar sets can't both miss) goes to lists again, and members
   of different parts meet if a shared value's places in both sets, and the common values
   among the rarest, leave room for the similarity: first with one head of each list, then all
   pairs of the parts that are left. There the bound is exact for sets of up to ``SHARP`` values, so
   that only pairs that are links get written. Pairs in one part need no test, as only components
   are asked for; no other pair is left out.
5. Pairs that pass the length bound and the union-sketch estimate are confirmed by the exact
   similarity of their whole sets of shingles (as word sequences, not hashes).
6. Components by repeated least-label steps with pointer jumping, each written to the shared
   folder; nothing is collected but a count.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemill.llm.words import col, free_name, given_back, ship, slices, split_words
from tidemill.session import stage

#: Values of a sketch, and how many of them two sets of the least similarity share at least.
#: With 32 values and similarity 0.8, fewer than 12 are shared with a chance of 2 in 10^8.
SKETCH, SHARED = 32, 12

#: So many of a set's rarest values go along with it to bound what two sets can share: with one head of each
#: list, and with all pairs of parts. Sets of up to ``SHARP`` values go along whole, so that the bound is exact.
FRONT, SHARP = 64, 512

#: Odd multipliers of the shingle hash (splitmix64's constants).
MIX = [0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB, 0xD6E8FEB86659FD93]

SCHEMA = "n_shingles long, fingerprint binary, sketch array<long>"


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(MIX[1])
    x = (x ^ (x >> np.uint64(27))) * np.uint64(MIX[2])
    return x ^ (x >> np.uint64(31))


def shingle_hashes(texts: pa.Array, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct shingle hashes of all texts, and ``len + 1`` offsets by text."""
    codes, offsets, distinct = split_words(pc.ascii_lower(texts))
    hashes = np.fromiter(map(xxhash.xxh3_64_intdigest, distinct.cast(pa.binary()).to_pylist()), np.uint64,
                         len(distinct))
    word = hashes[codes]
    n_words = np.diff(offsets)
    n = np.where(n_words >= size, n_words - size + 1, np.minimum(n_words, 1))
    at = np.concatenate(([0], np.cumsum(n)))
    owner = np.repeat(np.arange(len(texts)), n)
    start = np.arange(at[-1]) - at[owner] + offsets[owner]
    length = np.minimum(n_words, size)[owner]
    value = np.zeros(at[-1], dtype=np.uint64)
    with np.errstate(over="ignore"):
        for i in range(size):
            own = i < length
            value[own] = _mixed(value[own] * np.uint64(MIX[0]) + word[start[own] + i] + np.uint64(i + 1))
    order = np.lexsort((value, owner))
    value, owner = value[order], owner[order]
    new = np.ones(len(value), dtype=bool)
    new[1:] = (value[1:] != value[:-1]) | (owner[1:] != owner[:-1])
    kept = np.concatenate(([0], np.cumsum(new)))
    return value[new], kept[at]


def sketches(texts: pa.Array, size: int, k: int) -> pa.StructArray:
    """The columns of ``SCHEMA`` for a slice of texts without nulls; no fingerprint for an empty set."""
    value, at = shingle_hashes(texts, size)
    n = np.diff(at)
    prints = [xxhash.xxh3_128_digest(value[i:j].tobytes()) if j > i else None for i, j in zip(at[:-1], at[1:])]
    take = np.minimum(n, k)
    ends = np.concatenate(([0], np.cumsum(take)))
    place = np.arange(ends[-1]) - np.repeat(ends[:-1], take) + np.repeat(at[:-1], take)
    lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(value[place].view(np.int64)))
    return pa.StructArray.from_arrays([pa.array(n), pa.array(prints, pa.binary()), lists],
                                      ["n_shingles", "fingerprint", "sketch"])


def _shingles(text: str | None, size: int) -> set:
    """The shingles of a text as its word sequences."""
    words = (text or "").encode().lower().split()
    if len(words) < size:
        return {b" ".join(words)} if words else set()
    return {b" ".join(words[i:i + size]) for i in range(len(words) - size + 1)}


def _sketched(docs: DataFrame, text: str, size: int, k: int, into: str) -> DataFrame:
    @F.arrow_udf(SCHEMA)
    def sketch(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in given_back(batches):
            done = [sketches(part, size, k) for part in slices(batch)]
            yield pa.concat_arrays(done or [sketches(pc.fill_null(batch, ""), size, k)])

    return docs.withColumn(into, sketch(col(text).cast("string")))


def _least(size, percent: int, shared: int):
    """Values that a sketch of ``size`` shares at least with that of a set as similar as ``percent``."""
    return F.least(F.lit(shared), F.ceil(size * percent / 100))


def _estimate(s_a: str, s_b: str, percent: int, k: int, shared: int):
    """Whether two sketches may belong to sets of the similarity: overlap first, then the union's own sketch.

    The union's ``k`` smallest values are a uniform sample of it; those in both sides
    estimate the similarity.
    """
    both = F.array_intersect(s_a, s_b)
    union = F.slice(F.array_sort(F.array_union(s_a, s_b)), 1, k)
    return ((F.size(both) >= F.least(_least(F.size(s_a), percent, shared), _least(F.size(s_b), percent, shared)))
            & (F.size(F.array_intersect(union, both)) >= _least(F.size(union), percent, shared)))


def _alike(percent: int, k: int, shared: int):
    """The length bound and the estimate for columns ``n_a, n_b, s_a, s_b``."""
    length = 100 * F.least("n_a", "n_b") >= percent * F.greatest("n_a", "n_b")
    return length & _estimate("s_a", "s_b", percent, k, shared)


def _confirmed(pairs: DataFrame, texts: DataFrame, size: int, percent: int) -> DataFrame:
    """Those of ``a, b`` whose whole sets reach the similarity. ``texts``: ``node, text``."""
    @F.arrow_udf("boolean")
    def similar(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        last, left = None, set()
        for one, other in batches:
            out = []
            for a, b in zip(one.to_pylist(), other.to_pylist()):
                if a != last:  # the join leaves equal first sides together
                    last, left = a, _shingles(a, size)
                right = _shingles(b, size)
                both = len(left & right)
                out.append(100 * both >= percent * (len(left) + len(right) - both))
            yield pa.array(out, pa.bool_())

    rows = (pairs.join(texts.select(F.col("node").alias("b"), F.col("text").alias("text_b")), "b")
            .join(texts.select(F.col("node").alias("a"), F.col("text").alias("text_a")), "a"))
    return rows.where(similar(F.col("text_a"), F.col("text_b"))).select("a", "b")


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``node, component`` (its smallest node) for every node of the edges; nodes without edges don't appear.

    In each step a node takes the least label around it, and then its label's label.
    """
    both = stage(edges.select(F.col(a).alias("node"), F.col(b).alias("other"))
                 .union(edges.select(F.col(b).alias("node"), F.col(a).alias("other"))).distinct(), "near-edges")
    labels = stage(both.groupBy("node").agg(F.least(F.col("node"), F.min("other")).alias("component")), "near-labels")
    while True:
        around = (both.join(labels.withColumnRenamed("node", "other"), "other")
                  .groupBy("node").agg(F.min("component").alias("near")))
        closer = labels.join(around, "node").select("node", F.least("component", "near").alias("to"),
                                                    F.col("component").alias("was"))
        of = labels.select(F.col("node").alias("to"), F.col("component").alias("jump"))
        new = stage(closer.join(of, "to", "left").select(
            "node", F.least("to", F.coalesce("jump", "to")).alias("component"), "was"), "near-labels")
        if not new.where("component <> was").limit(1).count():
            return new.select("node", "component")
        labels = new.select("node", "component")


def _hashed(docs: DataFrame, size: int) -> DataFrame:
    """Add ``set``: the sorted distinct shingle hashes of ``text``."""
    @F.arrow_udf("array<long>")
    def hashed(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            done = []
            for part in slices(batch):
                value, at = shingle_hashes(part, size)
                done.append(pa.ListArray.from_arrays(pa.array(at, pa.int32()), pa.array(value.view(np.int64))))
            yield pa.concat_arrays(done) if done else pa.array([], pa.list_(pa.int64()))

    return docs.withColumn("set", hashed(F.col("text")))


def _split(met: DataFrame, links: DataFrame | None) -> DataFrame:
    """``value, node, part`` of the lists whose members the links leave in several parts."""
    if links is None:
        return met.withColumn("part", F.col("node"))
    rows = met.join(components(links), "node", "left").select(
        "value", "node", F.coalesce("component", "node").alias("part"))
    rows = stage(rows, "near-parts")
    several = rows.groupBy("value").agg(F.min("part").alias("low"), F.max("part").alias("high")).where("low <> high")
    return rows.join(several.select("value"), "value")


def _up_to(places):
    """Those of ``most``, a set's common values from the place ``alone`` on, that stand in its first ``places``."""
    return F.slice("most", F.lit(1), F.greatest(F.lit(0), places - F.col("alone")).cast("int"))


def near_duplicates(docs: DataFrame, id: str = "doc_id", text: str = "text", size: int = 4, percent: int = 80,
                    k: int = SKETCH, shared: int = SHARED) -> DataFrame:
    """``id, n_shingles, component_id, kept, text_key, chosen`` for each row of ``docs``.

    Documents are linked when 100 * intersection >= ``percent`` * union of their sets of
    ``size``-word shingles; ``component_id`` is the smallest id reachable, and ``kept`` whether
    that is the row's own. A null or empty text has no shingles and is a component by itself.
    Rows of equal id and text are one document and get equal results; a null id comes after
    all others, so a component has a null ``component_id`` only if it has no other id. An empty
    table gives no rows. ``text_key`` is ``xxhash64`` of the text, and ``chosen`` marks one id
    and text of each component, also where ids are null or shared by different texts.
    """
    ship(docs.sparkSession)
    source = docs.select(col(id).alias("id"), col(text).cast("string").alias("text")).withColumn(
        "text_key", F.xxhash64("text"))
    rows = stage(_sketched(source, "text", size, k, "s").select(
        "id", "text_key", F.inline(F.array("s"))), "near-sketches")

    # a class: all documents of one set; it stands for its copies from here on
    one = F.struct(F.col("id").isNull().alias("no_id"), "id", "text_key")
    classes = stage(rows.where("fingerprint is not null").groupBy("fingerprint").agg(
        F.min(one).alias("one"), F.first("n_shingles").alias("n"), F.first("sketch").alias("sketch"))
        .withColumn("node", F.monotonically_increasing_id()), "near-classes")
    around = classes.select("node", "n", "sketch")

    values = classes.select("node", F.explode("sketch").alias("value"))
    held = values.groupBy("value").agg(F.count(F.lit(1)).alias("held")).where("held > 1")
    common = values.join(held, "value")
    order = Window.partitionBy("node").orderBy("held", "value")
    ranked = common.select("node", "value", F.row_number().over(order).alias("place"),
                           F.count(F.lit(1)).over(Window.partitionBy("node")).alias("n_common"))
    needed = ranked.join(classes.select("node", F.size("sketch").alias("size")), "node").where(
        F.col("place") <= F.col("n_common") - _least(F.col("size"), percent, shared) + 1)
    lists = stage(needed.select("value", "node"), "near-lists")
    several = lists.groupBy("value").agg(F.count(F.lit(1)).alias("held")).where("held > 1").select("value")
    met = stage(lists.join(several, "value"), "near-met")

    # the texts of all classes that share a list with another
    wanted = met.select("node").distinct().join(classes.select(
        "node", "one.id", "one.text_key"), "node").withColumnsRenamed({"id": "one_id", "text_key": "one_key"})
    texts = stage(source.join(wanted, F.col("id").eqNullSafe(F.col("one_id")) & (F.col("text_key") == F.col("one_key")))
                  .select("node", "text"), "near-texts")
    if rows.where("id is null").limit(1).count() or rows.groupBy("id", "text_key").count().where(
            "count > 1").limit(1).count():
        texts = stage(texts.dropDuplicates(["node"]), "near-texts")

    sides = [around.select(F.col("node").alias(x), F.col("n").alias(f"n_{x}"), F.col("sketch").alias(f"s_{x}"))
             for x in "ab"]

    def links_of(pairs: DataFrame) -> DataFrame:
        near = pairs.join(sides[1], "b").join(sides[0], "a").where(_alike(percent, k, shared)).select("a", "b")
        return stage(_confirmed(near, texts, size, percent), "near-links")

    # each class with that head, of those of its lists, that it shares most of them with
    weight = met.groupBy("node").agg(F.count(F.lit(1)).alias("n_lists"))
    links = None
    for choice in (F.struct("n_lists", -F.col("node")), -F.col("node")):
        members = _split(met, links).join(weight, "node")
        heads = members.groupBy("value").agg(F.max_by(F.struct("node", "part"), choice).alias("head"))
        star = members.join(heads, "value").where("part <> head.part").groupBy(
            F.col("node").alias("b"), F.col("head.node").alias("a")).agg(F.count(F.lit(1)).alias("lists"))
        star = star.groupBy("b").agg(F.max_by("a", F.struct("lists", "a")).alias("a"))
        found = links_of(star)
        links = found if links is None else stage(links.unionByName(found), "near-links")

    # whole sets of what the heads have left in several parts
    left = stage(_split(met, links).select("node", "part").distinct(), "near-left")
    whole = _hashed(texts.join(left, "node"), size).select("node", "part", F.size("set").alias("n"),
                                                          F.explode("set").alias("value"))
    whole = stage(whole, "near-sets")
    held = whole.groupBy("value").agg(F.count(F.lit(1)).alias("held")).where("held > 1")
    # the values that no other set holds come first, in places from 0 to ``alone``, then the others, rarest first
    fronts = whole.join(held, "value").groupBy("node", "part", "n").agg(
        F.array_sort(F.collect_list(F.struct("held", "value"))).alias("most"))
    needed = (F.col("n") - F.ceil(F.col("n") * percent / 100)).cast("int")  # the last place of the prefix
    fronts = fronts.withColumn("alone", F.col("n") - F.size("most"))
    fronts = stage(fronts.withColumn("most", _up_to(F.greatest(needed + 1, F.lit(SHARP)))), "near-fronts")

    def front(places: int) -> list:
        size = F.least(F.lit(places), F.col("n"))
        rarest = _up_to(size)
        return [size.alias("front"), rarest.getField("value").alias("rare"),
                F.try_element_at(rarest, F.lit(-1)).alias("last")]

    prefix = fronts.select("node", "part", "n", "alone", *front(FRONT),
                           F.posexplode(_up_to(needed + 1)).alias("nth", "common"))
    prefix = stage(prefix.withColumn("value", F.col("common.value")).withColumn(
        "place", F.col("alone") + F.col("nth")).drop("alone", "nth", "common"), "near-prefix")

    def sides_of(rows: DataFrame) -> list[DataFrame]:
        return [rows.select(*[F.col(c).alias(f"{c}_{x}") for c in rows.columns]) for x in "ab"]

    total = F.col("n_a") + F.col("n_b")
    room = F.least(F.col("n_a") - F.col("place_a"), F.col("n_b") - F.col("place_b"))
    both = F.array_intersect("rare_a", "rare_b")  # rarest first
    # what the two share up to the earlier end of their fronts is in both fronts
    earlier = F.col("last_a").isNull() | F.coalesce(F.col("last_a") <= F.col("last_b"), F.lit(False))
    beyond = F.when(earlier, F.col("n_a") - F.col("front_a")).otherwise(F.col("n_b") - F.col("front_b"))
    meet = ((F.col("value_a") == F.col("value_b")) & (F.col("part_a") != F.col("part_b"))
            & (100 * F.least("n_a", "n_b") >= percent * F.greatest("n_a", "n_b"))
            & ((100 + percent) * room >= percent * total)
            & ((100 + percent) * (F.size(both) + beyond) >= percent * total))

    # every such list first links its members to a head of its own, picked by hash
    one, two = sides_of(prefix)
    heads = two.groupBy("value_b").agg(F.min_by(F.struct(*two.columns), F.xxhash64("value_b", "node_b")).alias("head"))
    found = links_of(one.join(heads.select("head.*"), meet).select(
        F.least("node_a", "node_b").alias("a"), F.greatest("node_a", "node_b").alias("b")).distinct())
    links = stage(links.unionByName(found), "near-links")
    prefix = prefix.drop("part").join(components(links).withColumnRenamed("component", "part"), "node", "left")
    prefix = stage(prefix.withColumn("part", F.coalesce("part", "node")), "near-prefix")

    # then all pairs of different parts; each has a member outside the list's largest part. They are made with
    # so much of both sets that those of up to SHARP values are decided before a pair is written
    parts = prefix.groupBy("value", "part").agg(F.count(F.lit(1)).alias("held"))
    split = parts.groupBy("value").agg(F.max_by("part", F.struct("held", "part")).alias("largest"),
                                       F.count(F.lit(1)).alias("n_parts")).where("n_parts > 1")
    open_lists = prefix.drop("front", "rare", "last").join(split.select("value", "largest"), "value")
    one, two = sides_of(open_lists.join(fronts.select("node", *front(SHARP)), "node"))
    pairs = one.where("part_a <> largest_a").join(
        two, meet & ((F.col("node_a") < F.col("node_b")) | (F.col("part_b") == F.col("largest_b")))
        & F.coalesce(F.try_element_at(both, F.lit(1)) == F.col("value_a"), F.lit(True)))  # where they meet first
    pairs = stage(pairs.select(F.least("node_a", "node_b").alias("a"), F.greatest("node_a", "node_b").alias("b"))
                  .distinct(), "near-rest")
    links = links.unionByName(links_of(pairs))

    labels = classes.join(components(links), "node", "left").select(
        "fingerprint", "one", F.coalesce("component", "node").alias("component"))
    least = labels.groupBy("component").agg(F.min("one").alias("least"))
    result = labels.join(least, "component").select("fingerprint", "least")
    out = rows.join(result, "fingerprint", "left").withColumn(
        "least", F.coalesce("least", F.struct(F.col("id").isNull().alias("no_id"), "id", "text_key")))
    return out.select(F.col("id").alias(id), "n_shingles", F.col("least.id").alias("component_id"),
                      F.col("id").eqNullSafe(F.col("least.id")).alias("kept"), "text_key",
                      (F.col("id").eqNullSafe(F.col("least.id"))
                       & (F.col("text_key") == F.col("least.text_key"))).alias("chosen"))


def one_of_each(docs: DataFrame, id: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """One row of ``docs`` for each component of :func:`near_duplicates`; same columns.

    Of repeated rows (equal id and text) one stays, whichever it is.
    """
    own = free_name(docs, "_near_own")
    found = stage(near_duplicates(docs, id, text, **options).where("chosen")
                  .groupBy(F.struct(F.col(f"`{id}`").alias("id"), "text_key").alias(own))
                  .agg(F.count(F.lit(1)).alias("_n")), "near-kept")
    row = F.struct(col(id).alias("id"), F.xxhash64(col(text).cast("string")).alias("text_key"))
    rest = docs.join(found.select(own), row == F.col(own), "left_semi")
    return rest.dropDuplicates([id, text]) if found.where("_n > 1").limit(1).count() else rest


def op9_bottom_k_neardup(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return near_duplicates(docs).select("doc_id", "n_shingles", "component_id", "kept")
