"""Chat formatting after collapsing cumulative snapshots.

Chat logs often hold the same conversation many times, each time some turns longer. Every turn
gets the hash of its conversation up to it: a running sum of hashes that depend on place, role
and text (two 64-bit hashes, summed in halves, so a long conversation may span tasks).
A conversation whose last hash is an inner hash of another is a snapshot of it; anti-joins
against the distinct inner hashes leave the maximal ones. Of equal conversations the smallest
id stays. Only then are conversations rendered.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemill.llm.ranges import running
from tidemill.llm.words import col
from tidemill.session import stage

HASHES = ["h0", "h1", "h2", "h3"]


def turns_of(logs: DataFrame, conv: str, turn: str, role: str, text: str) -> DataFrame:
    """``key, turn, role, text``: distinct turns; a turn without a conversation is one by itself."""
    rows = logs.select(col(conv).alias("conv"), col(turn).alias("turn"),
                       F.coalesce(col(role).cast("string"), F.lit("unknown")).alias("role"),
                       F.coalesce(col(text).cast("string"), F.lit("")).alias("text")).distinct()
    alone = F.when(F.col("conv").isNull(), F.sha2(F.concat_ws("\n", F.col("turn").cast("string"), "role", "text"), 256))
    return rows.select(F.struct("conv", alone.alias("alone")).alias("key"), "turn", "role", "text")


def maximal(turns: DataFrame) -> DataFrame:
    """``key, n_turns`` of the conversations that no longer one starts with, one of equal ones."""
    numbered = running(turns.select("key", "turn", F.sha2(F.concat_ws("\n", "role", "text"), 256).alias("sha"),
                                    "role", F.xxhash64("text").alias("text_hash")),
                       ["key"], ["turn", "role", "sha"], sums={"n_turns": F.lit(1).cast("long")})
    first = F.xxhash64("n_turns", "role", "sha")
    second = F.xxhash64("sha", "text_hash", "n_turns")
    halves = {n: (F.shiftrightunsigned(h, 32) if i % 2 else h.bitwiseAND(F.lit(0xFFFFFFFF)))
              for i, (n, h) in enumerate(zip(HASHES, [first, first, second, second]))}
    hashed = stage(running(numbered.select("key", "n_turns", *[h.alias(f"own_{n}") for n, h in halves.items()]),
                           ["key"], ["n_turns"], sums={n: F.col(f"own_{n}") for n in HASHES})
                   .select("key", F.struct("n_turns", *HASHES).alias("prefix")), "chat-prefixes")
    ends = hashed.groupBy("key").agg(F.max("prefix.n_turns").alias("n"))
    marked = hashed.join(ends, "key").withColumn("ends", F.col("prefix.n_turns") == F.col("n"))
    marked = stage(marked.select("key", "prefix", "ends"), "chat-ends")
    inner = marked.where(~F.col("ends")).select("prefix").distinct()
    whole = marked.where("ends").groupBy("prefix").agg(F.min("key").alias("key"))
    return whole.join(inner, "prefix", "left_anti").select("key", F.col("prefix.n_turns").alias("n_turns"))


def rendered(logs: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text",
             start: str = "<|im_start|>", end: str = "<|im_end|>") -> DataFrame:
    """``conv, n_turns, text`` of every maximal conversation.

    Repeated rows are one turn; turns of equal number are ordered by role, then by a digest of
    both; a null turn comes first, a null role is ``unknown``, a null text empty; rows with a null
    conversation are conversations of one turn with a null id. Marks inside texts lose their
    force by a space after ``<``. An empty table gives no rows. A rendered conversation is one
    value, so it must fit into one.
    """
    turns = stage(turns_of(logs, conv, turn, role, text), "chat-turns")
    kept = stage(maximal(turns), "chat-maximal")
    plain = F.replace(F.replace("text", F.lit(start), F.lit("< " + start[1:])), F.lit(end), F.lit("< " + end[1:]))
    line = F.concat(F.lit(start), "role", F.lit("\n"), plain, F.lit(end + "\n"))
    parts = turns.join(kept, "key").select("key", "n_turns", F.struct(
        "turn", "role", F.sha2(F.concat_ws("\n", "role", "text"), 256).alias("sha"), line.alias("line")).alias("t"))
    whole = parts.groupBy("key", "n_turns").agg(F.array_sort(F.collect_list("t")).alias("t"))
    return whole.select(F.col("key.conv").alias(conv), "n_turns", F.array_join("t.line", "").alias("text"))


def op1_snapshot_collapse(spark, sf_dir: str) -> DataFrame:
    return rendered(spark.read.parquet(f"{sf_dir}/conversations.parquet"))


OP1_SQL = """
WITH t AS (
  SELECT DISTINCT conv_id, turn, coalesce(role, 'unknown') AS role, coalesce(text, '') AS text FROM conversations),
s AS (SELECT *, sha256(role || chr(10) || text) AS sha FROM t),
c AS (
  SELECT conv_id, CASE WHEN conv_id IS NULL THEN concat_ws(chr(10), turn, role, text) END AS alone, count(*) AS n_turns,
         list({'role': role, 'text': text} ORDER BY turn NULLS FIRST, role, sha) AS turns,
         string_agg('<|im_start|>' || role || chr(10)
           || replace(replace(text, '<|im_start|>', '< |im_start|>'), '<|im_end|>', '< |im_end|>')
           || '<|im_end|>' || chr(10), '' ORDER BY turn NULLS FIRST, role, sha) AS text
  FROM s GROUP BY ALL),
one AS (SELECT min(conv_id) AS conv_id, n_turns, turns, min(text) AS text FROM c GROUP BY n_turns, turns)
SELECT conv_id, n_turns, text FROM one a
WHERE NOT EXISTS (SELECT 1 FROM one b WHERE b.n_turns > a.n_turns AND b.turns[1:a.n_turns] = a.turns)
"""
