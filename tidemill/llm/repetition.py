"""Quality rules on repetition inside a document, from its suffix array over words.

For every text the suffixes (over words) are sorted by prefix doubling. Each time a
class of equal prefixes splits, the two sides' longest common prefix (LCP) is known; a
suffix's longest repeat is the largest LCP with its neighbours in the suffix array. These
LCP intervals give the maximal repeated substrings; their spans are united per text.

A text is sorted whole, whatever its length: memory is a few arrays of its word count for
each doubling. Texts are independent, so a plan needs no shuffle and a lost task repeats
its own rows only.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemill.llm.words import col, free_name, given_back, per_text, ship, slices, split_words

#: Production limits: repeats of at least MIN_REPEAT words count; they may cover MAX_COVERED
#: of the words, and the longest may hold MAX_LONGEST of them. Both lie above what clean documents reach
#: (sf0.1: at most 0.25 covered) and below the base rule, which fails from 0.5 covered on.
MIN_REPEAT, MAX_COVERED, MAX_LONGEST = 10, 0.3, 0.15

#: Text bytes that are sorted together; every doubling keeps an array of their words.
SLICE_BYTES = 2 << 20

SCHEMA = ("n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, covered_words long,"
          " longest_repeat long, spans array<struct<start: long, stop: long>>, base_failed boolean, kept boolean")


def longest_repeats(codes: np.ndarray, text_of: np.ndarray) -> np.ndarray:
    """For each word position: words of the longest substring that starts there and occurs again in its text.

    >>> longest_repeats(np.array([1, 2, 9, 1, 2, 1, 2]), np.array([0, 0, 0, 0, 0, 1, 1])).tolist()
    [2, 1, 0, 2, 1, 0, 0]
    """
    n = len(codes)
    best = np.zeros(n, dtype=np.int64)
    if not n:
        return best
    key = text_of * (int(codes.max()) + 1) + codes
    order = np.argsort(key, kind="stable")
    first = np.concatenate(([True], np.diff(key[order]) != 0))
    begin = np.flatnonzero(first)
    size = np.diff(np.append(begin, n))
    rank = np.full(n + 1, -1, dtype=np.int64)  # the class's first place in the suffix array; unlike at the end
    rank[order] = np.repeat(begin, size)
    active = order[np.repeat(size > 1, size)]
    ranks, h = [rank], 1
    while len(active):
        rank = ranks[-1]
        old = rank[active]
        key = old * (n + 1) + rank[active + h] + 1
        by = np.argsort(key, kind="stable")
        active, key, old = active[by], key[by], old[by]
        place = np.arange(len(active))
        group = np.concatenate(([True], old[1:] != old[:-1]))
        split = np.concatenate(([True], key[1:] != key[:-1]))
        cut = np.flatnonzero(split & ~group)
        if len(cut):
            a, b = active[cut - 1], active[cut]
            lcp, k = np.full(len(cut), h), h
            for level in reversed(ranks[:-1]):
                k //= 2
                lcp += np.where(level[a + lcp] == level[b + lcp], k, 0)
            best[a] = np.maximum(best[a], lcp)
            best[b] = np.maximum(best[b], lcp)
        begin = np.flatnonzero(split)
        size = np.diff(np.append(begin, len(active)))
        slot = old + place - np.maximum.accumulate(np.where(group, place, 0))
        rank = rank.copy()
        rank[active] = np.repeat(slot[begin], size)
        active = active[np.repeat(size > 1, size)]
        ranks.append(rank)
        h *= 2
    return best


def covered(best: np.ndarray, least: int) -> np.ndarray:
    """Whether each position lies in a repeated substring of ``least`` words or more."""
    place = np.arange(len(best))
    return np.maximum.accumulate(np.where(best >= least, place + best, 0)) > place


def _spans(inside: np.ndarray, offsets: np.ndarray) -> pa.Array:
    """Runs of True by text, as positions in the text."""
    starts = np.zeros(len(inside) + 1, dtype=bool)
    starts[offsets] = True
    pad = np.concatenate(([False], inside, [False]))
    begin = np.flatnonzero(inside & (~pad[:-2] | starts[:-1]))
    stop = np.flatnonzero(inside & (~pad[2:] | starts[1:])) + 1
    text = np.searchsorted(offsets, begin, "right") - 1
    at = np.searchsorted(begin, offsets)
    return pa.ListArray.from_arrays(pa.array(at, pa.int32()), pa.StructArray.from_arrays(
        [pa.array(begin - offsets[text]), pa.array(stop - offsets[text])], ["start", "stop"]))


def _duplicate_lines(text: str) -> int:
    if "\n" not in text:
        return 0
    seen, n = set(), 0
    for line in text.split("\n"):
        if line in seen:
            n += 1
        elif line.strip(" \t\n\r\x0b\x0c"):
            seen.add(line)
    return n


def measure(texts: pa.Array, min_repeat: int, max_covered: float, max_longest: float) -> pa.StructArray:
    """The columns of ``SCHEMA`` for a slice of texts without nulls."""
    codes, offsets, distinct = split_words(texts)
    n_words = np.diff(offsets)
    best = longest_repeats(codes, np.repeat(np.arange(len(texts)), n_words))
    chars = pc.utf8_length(distinct).to_numpy(zero_copy_only=False) if len(codes) else codes
    inside = covered(best, min_repeat)
    n_repeat, n_covered = per_text(covered(best, 3), offsets), per_text(inside, offsets)
    longest = np.zeros(len(texts), dtype=np.int64)
    if len(codes):
        longest[n_words > 0] = np.maximum.reduceat(best, offsets[:-1][n_words > 0])
    base_failed = (n_words < 50) | (100 * n_repeat > 50 * n_words)
    wrong = (n_covered > max_covered * n_words) | ((longest >= min_repeat) & (longest > max_longest * n_words))
    symbols = pc.count_substring_regex(texts, "[#*$%&|<>]").cast(pa.int64())
    lines = pa.array(map(_duplicate_lines, texts.to_pylist()), pa.int64())
    return pa.StructArray.from_arrays(
        [pa.array(n_words), pa.array(per_text(chars[codes], offsets)), symbols, lines, pa.array(n_repeat),
         pa.array(n_covered), pa.array(longest), _spans(inside, offsets), pa.array(base_failed),
         pa.array(~base_failed & ~wrong)],
        ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "covered_words", "longest_repeat",
         "spans", "base_failed", "kept"])


def repetition(docs: DataFrame, text: str = "text", into: str = "repetition", min_repeat: int = MIN_REPEAT,
               max_covered: float = MAX_COVERED, max_longest: float = MAX_LONGEST) -> DataFrame:
    """Add the struct column ``into`` (fields of ``SCHEMA``); spans are word positions covered by long repeats.

    A null or empty text has no words, fails the base rule and isn't kept. Every row is
    measured by itself, so repeated rows get equal results; an empty table stays empty. Other
    columns are untouched (``into`` replaces a column of that name).
    """
    ship(docs.sparkSession)

    @F.arrow_udf(SCHEMA)
    def rules(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in given_back(batches):
            done = [measure(part, min_repeat, max_covered, max_longest) for part in slices(batch, SLICE_BYTES)]
            yield pa.concat_arrays(done or [measure(pc.fill_null(batch, ""), min_repeat, max_covered, max_longest)])

    return docs.withColumn(into, rules(col(text).cast("string")))


def clean(docs: DataFrame, text: str = "text", **limits) -> DataFrame:
    """Only the rows whose text passes the rules; same columns."""
    into = free_name(docs, "_repetition")
    return repetition(docs, text, into, **limits).where(F.col(f"{into}.kept")).drop(into)


def op10_suffix_repetition(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    out = repetition(docs, into="r")
    fields = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept",
              "covered_words", "longest_repeat"]
    return out.select("doc_id", *[F.col(f"r.{f}").alias(f) for f in fields])
