"""Personal data, and the terms that give it away, in DataFrame operations only.

Base: spans of e-mail addresses, IP addresses, card and phone numbers. ``split`` gives the gaps
between a pattern's matches and ``regexp_extract_all`` the matches, so that running sums of
their lengths are the spans.

Information-theoretic sanitisation: each value found is a protected entity. A term of a document
that holds it discloses it as far as their pointwise mutual information approaches the entity's own
information content:

    PMI(entity; term) / IC(entity) = log2(N * n(e, t) / (n(e) * n(t))) / log2(N / n(e))

with ``N`` documents, ``n(e)`` holding the entity, ``n(t)`` holding the term, and ``n(e, t)``
holding both; all are counted over the whole texts of the whole corpus. Every entity's terms are
scored, and a disclosing one is found wherever it stands in the documents that hold the entity. A pair that fewer than ``MIN_JOINT`` documents show is weak evidence, so its
``n(t)`` is taken as one more (add-one smoothing): a term of a single document reaches a share of
1 - 1 / IC(entity). Terms from ``GENERALISE`` on are replaced by a general label, from ``REMOVE``
on they are removed.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemill.llm.words import col, free_name
from tidemill.session import stage

#: Least share of an entity's information at which a term is generalised, and removed; common documents that need no smoothing.
GENERALISE, REMOVE, MIN_JOINT = 0.9, 0.97, 2

KINDS = ["email", "ip", "card", "phone", "term"]

#: The contract's patterns. Possessive quantifiers and look-behinds keep their matches but avoid
#: a second look at the same run of characters; twelve digits ahead spare shorter numbers.
PATTERNS = {
    "email": r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"(?<![0-9])(?=[0-9](?:[\x20-]?[0-9]){11})[0-9]++(?:[\x20-][0-9]++)*+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}

#: A term: letters between white space, with one closing mark at most. It can't overlap a base span.
TERM = r"(?<!\S)\p{L}{4,}+(?=[,;:.!?]?(?:\s|$))"

LABELS = {"email": "[EMAIL]", "ip": "[IP]", "card": "[CARD]", "phone": "[PHONE]"}


def _array(pattern: str, text: Column, *, gaps: bool) -> Column:
    return F.split(text, pattern) if gaps else F.regexp_extract_all(text, F.lit(pattern), F.lit(0))


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def _luhn(digits: Column) -> Column:
    """Whether a string of digits passes the Luhn test."""
    def weigh(c, i):
        twice = c.cast("int") * 2
        return F.when(i % 2 == 0, c.cast("int")).when(twice > 9, twice - 9).otherwise(twice)
    return F.aggregate(F.transform(F.reverse(F.split(digits, "")), weigh), F.lit(0), lambda a, x: a + x) % 10 == 0


def _passes(kind: Column, value: Column) -> Column:
    digits = _digits(value)
    parts = F.split(value, r"\.")
    return (F.when(kind == 0, True)
            .when(kind == 1, F.forall(parts, lambda p: p.rlike("^0*(?:25[0-5]|2[0-4][0-9]|1?[0-9]{1,2})$")))
            .when(kind == 2, F.when(F.length(digits).between(12, 19), _luhn(digits)).otherwise(False))
            .otherwise(F.length(digits).between(9, 15)))


def base_matches(docs: DataFrame, id: str, text: str) -> DataFrame:
    """A row for each match of each pattern, and one with a null ``kind`` for a document without any.

    ``row`` (a number of the document), ``id, text_key, kind, start, stop, value, passed, text``; a document
    with a match that passes has its ``text`` in one of its rows.
    """
    source = docs.select(F.monotonically_increasing_id().alias("row"), col(id).alias("id"),
                         F.coalesce(col(text).cast("string"), F.lit("")).alias("text"),
                         F.xxhash64(col(text).cast("string")).alias("text_key"))
    # texts without the sign that every match of a pattern has are spared its search
    sign = {"email": F.contains("text", F.lit("@")), "phone": F.contains("text", F.lit("+"))}
    found = source.select("*", *[
        F.when(sign.get(k, F.lit(True)), _array(p, F.col("text"), gaps=False)).otherwise(
            F.array().cast("array<string>")).alias(f"m_{k}")
        for k, p in PATTERNS.items()])
    found = found.select("row", "id", "text_key", "text", *[f"m_{k}" for k in PATTERNS], *[
        F.when(F.size(f"m_{k}") > 0, _array(p, F.col("text"), gaps=True)).alias(f"g_{k}") for k, p in PATTERNS.items()])

    def entries(number: int, kind: str) -> Column:
        m, g = F.col(f"m_{kind}"), F.col(f"g_{kind}")
        return F.transform(m, lambda v, i: F.struct(
            F.lit(number).alias("kind"), i.alias("i"), F.length(g[i]).alias("gap"), v.alias("value"),
            _passes(F.lit(number), v).alias("passed")))

    rows = found.select("row", "id", "text_key", "text", F.concat(*[entries(n, k) for n, k in enumerate(PATTERNS)]).alias("e"))
    rows = rows.select("row", "id", "text_key", F.when(F.exists("e", lambda m: m["passed"]), F.col("text")).alias("text"),
                       F.posexplode_outer("e").alias("place", "m"))
    rows = rows.select("row", "id", "text_key", F.when(F.col("place") == 0, F.col("text")).alias("text"), "m.*"
                       ).repartition("row")
    so_far = Window.partitionBy("row", "kind").orderBy("i").rowsBetween(Window.unboundedPreceding, 0)
    length = F.length("value")
    start = F.sum("gap").over(so_far) + F.sum(length).over(so_far) - length
    return rows.select("row", "id", "text_key", "kind", start.alias("start"), (start + length).alias("stop"), "value",
                       F.coalesce("passed", F.lit(False)).alias("passed"), "text")


def _terms(matches: DataFrame) -> DataFrame:
    """``row, id, text_key, term, start, stop`` of all terms of the documents that hold an entity."""
    texts = matches.where("text is not null").select("row", "id", "text_key", "text").repartition("row")
    found = texts.select("row", "id", "text_key", _array(TERM, F.col("text"), gaps=False).alias("terms"),
                         _array(TERM, F.col("text"), gaps=True).alias("gaps"))
    rows = found.select("row", "id", "text_key", F.explode(F.transform("terms", lambda t, i: F.struct(
        i.alias("i"), F.length(F.col("gaps")[i]).alias("gap"), t.alias("value")))).alias("t"))
    rows = rows.select("row", "id", "text_key", "t.*")
    so_far = Window.partitionBy("row").orderBy("i").rowsBetween(Window.unboundedPreceding, 0)
    length = F.length("value")
    start = F.sum("gap").over(so_far) + F.sum(length).over(so_far) - length
    return rows.select("row", "id", "text_key", F.lower("value").alias("term"), start.alias("start"),
                       (start + length).alias("stop"))


def _share(n: Column, n_e: Column, n_t: Column, n_et: Column, min_joint: int) -> Column:
    """PMI / information content; null for an entity that all documents hold. It grows with ``n_et``."""
    information = F.log2(n / n_e)
    smoothed = n_t + F.when(n_et < min_joint, 1).otherwise(0)
    return F.when(information > 0, F.log2(n * n_et / (n_e * smoothed)) / information)


def disclosing_terms(matches: DataFrame, docs: DataFrame, text: str, generalise: float = GENERALISE,
                     min_joint: int = MIN_JOINT) -> DataFrame:
    """``row, id, text_key, start, stop, share`` of the terms that disclose an entity of their document.

    ``matches``: what :func:`base_matches` gives, stored; ``docs``: the same documents.
    """
    value = F.when(F.col("kind") == 0, F.lower("value")).when(F.col("kind") == 1, F.col("value")).otherwise(
        _digits(F.col("value")))
    entities = matches.where("passed").select(
        "row", F.concat_ws(":", F.col("kind").cast("string"), value).alias("entity")).distinct()
    known = entities.groupBy("entity").agg(F.count(F.lit(1)).alias("n_e"))
    entities = stage(entities.join(known, "entity"), "pii-entities")
    terms = stage(_terms(matches), "pii-terms")
    n = matches.select("row").distinct().count()
    most = entities.agg(F.max("n_e")).first()[0] or 1

    # no share reaches ``generalise`` for a term that more documents hold than this
    limit = most * (max(n, 1) / most) ** (1 - generalise) * (1 + 1e-9)
    held = docs.select(F.explode(F.array_distinct(F.transform(
        _array(TERM, col(text).cast("string"), gaps=False), F.lower))).alias("term"))
    held = held.groupBy("term").agg(F.count(F.lit(1)).alias("n_t")).where(F.col("n_t") <= limit)
    held = stage(held, "pii-held")  # so that Spark can split the join's common terms

    def share(n_et: Column) -> Column:
        return _share(F.lit(n), F.col("n_e"), F.col("n_t"), n_et, min_joint)

    cells = terms.select("row", "term").distinct().join(held, "term").join(entities, "row")
    cells = stage(cells.where(share(F.least("n_e", "n_t")) >= generalise), "pii-cells")
    joint = cells.groupBy("entity", "term").agg(
        F.count(F.lit(1)).alias("n_et"), F.first("n_e").alias("n_e"), F.first("n_t").alias("n_t"))
    joint = joint.select("entity", "term", share(F.col("n_et")).alias("share")).where(F.col("share") >= generalise)
    joint = stage(joint, "pii-joint")
    found = cells.join(joint, ["entity", "term"]).groupBy("row", "term").agg(F.max("share").alias("share"))
    return terms.join(found, ["row", "term"]).select("row", "id", "text_key", "start", "stop", "share")


def personal_data(docs: DataFrame, id: str = "doc_id", text: str = "text", generalise: float = GENERALISE,
                  min_joint: int = MIN_JOINT) -> DataFrame:
    """One row for each document: ``id, text_key, spans``.

    ``spans``: array of ``start, kind, stop, share`` in code points (end exclusive), sorted;
    ``kind`` is a place in ``KINDS``, ``share`` is null but for terms. A null text counts as
    empty. Documents without a find have an empty array. Rows of equal id and text stay rows of
    their own and count as documents of their own. An empty table gives no rows.
    """
    matches = stage(base_matches(docs, id, text), "pii-matches")
    terms = disclosing_terms(matches, docs, text, generalise, min_joint)
    span = F.struct("start", "kind", "stop", "share")
    base = matches.withColumn("share", F.lit(None).cast("double")).select(
        "row", "id", "text_key", F.when(F.col("passed"), span).alias("span"))
    more = terms.withColumn("kind", F.lit(len(PATTERNS))).withColumn("start", F.col("start").cast("long")).withColumn(
        "stop", F.col("stop").cast("long")).select("row", "id", "text_key", span.alias("span"))
    spans = base.unionByName(more).groupBy("row").agg(
        F.first(F.struct("id", "text_key")).alias("own"), F.array_sort(F.collect_list("span")).alias("spans"))
    return spans.select(F.col("own.id").alias(id), F.col("own.text_key").alias("text_key"), "spans")


def _written(spans: Column) -> Column:
    kinds = F.array(*[F.lit(k) for k in KINDS])
    return F.concat_ws(",", F.transform(spans, lambda s: F.concat_ws(
        ":", F.element_at(kinds, s["kind"] + 1), s["start"].cast("string"), s["stop"].cast("string"))))


def sanitised(docs: DataFrame, id: str = "doc_id", text: str = "text", remove: float = REMOVE, **options) -> DataFrame:
    """``docs`` with personal data in ``text`` replaced by labels, disclosing terms generalised or removed.

    Same rows and columns; texts without a find, also null ones, stay as they are. Of
    overlapping spans the first stands, and covers up to the end of the last.
    """
    own = free_name(docs, "_pii_own")
    spans_ = free_name(docs, "_pii_spans")
    found = personal_data(docs, id, text, **options).where(F.size("spans") > 0)
    found = stage(found.groupBy(F.struct(F.col(f"`{id}`").alias("id"), "text_key").alias(own)).agg(
        F.first("spans").alias(spans_)), "pii-found")
    row = F.struct(col(id).alias("id"), F.xxhash64(col(text).cast("string")).alias("text_key"))
    joined = docs.join(found, row == F.col(own), "left")
    value = col(text).cast("string")
    label = F.array(*[F.lit(LABELS[k]) for k in PATTERNS])

    def step(a, s):
        put = F.when(s["kind"] < len(PATTERNS), F.element_at(label, F.least(s["kind"] + 1, F.lit(len(PATTERNS))))).when(
            s["share"] >= remove, "").otherwise("[TERM]")
        ahead = F.substring(value, (a["reach"] + 1).cast("int"), (s["start"] - a["reach"]).cast("int"))
        inside = s["start"] < a["reach"]
        return F.struct(F.when(inside, a["out"]).otherwise(F.concat(a["out"], ahead, put)).alias("out"),
                        F.greatest(a["reach"], s["stop"]).alias("reach"))

    zero = F.struct(F.lit("").alias("out"), F.lit(0).cast("long").alias("reach"))
    done = F.aggregate(spans_, zero, step, lambda a: F.concat(
        a["out"], F.substring(value, (a["reach"] + 1).cast("int"), F.length(value))))
    return joined.withColumn(text, F.when(F.col(spans_).isNotNull(), done).otherwise(col(text))).select(
        *[col(c) for c in docs.columns])


def op4_information_sanitising(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    found = personal_data(docs)
    base = F.filter("spans", lambda s: s["kind"] < len(PATTERNS))

    def number(kind: int) -> Column:
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long")

    count = [number(n).alias(f"n_{k}") for n, k in enumerate(PATTERNS)]
    return found.select("doc_id", *count, F.sha2(_written(base), 256).alias("base_sha256"),
                        _written(F.col("spans")).alias("spans"))
