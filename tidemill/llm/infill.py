"""Fill-in-middle transformation of documents, cut between tokens found by chunk summaries.

A token is a run of letters A-Z, a-z, or any other character by itself. To find where a given
token of a text starts, without matching tokens over the whole text:

1. A rolling hash over the last ``WINDOW`` bytes cuts the text into chunks where eight of its bits are
   zero, so equal passages fall into equal chunks wherever they stand. Cuts lie between characters;
   a chunk of more than ``LONGEST`` bytes is cut further.
2. Chunks are told apart by their whole content. Each distinct one is summarised once: its tokens,
   its characters, whether it begins and whether it ends with a letter. A cache of bounded size keeps
   the summaries for the rest of the task; it changes no result.
3. A text's tokens are the sum over its chunks, less one wherever a run of letters goes on
   from one chunk to the next. Running sums of this give the chunk that a cut falls in, and only
   that chunk is matched.

Rows are independent: no shuffle, and a lost task repeats its own rows only.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemill.llm.words import col, free_name, ship, slices

SCHEMA = "n long, form string, prefix_chars long, middle_chars long, output string"

#: Bytes that the rolling hash sees, how many of its bits are zero at a cut (one place in 256), the longest chunk.
WINDOW, CUT_BITS, LONGEST = 16, 0xFF, 1 << 16
#: Chunk bytes that the cache may hold.
CACHE_BYTES = 8 << 20
#: Documents in a hundred that are transformed, and those of them that start with the suffix.
RATE, SPM_RATE = 90, 20
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"

_LETTER = np.zeros(256, dtype=bool)
_LETTER[65:91] = _LETTER[97:123] = True
#: A random number for each byte value.
_GEAR = np.random.default_rng(0).integers(0, 1 << 32, 256, dtype=np.uint32)


def chunk_ends(data: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Where the chunks of consecutive texts end: ``data`` are their bytes, ``at`` the ``len + 1`` offsets.

    Every text that isn't empty ends a chunk, and no chunk reaches into another text.
    """
    h = _GEAR[data]
    width = 1
    while width < WINDOW:  # sums over 1, 2, 4, ... bytes, older ones shifted out to the left
        h[width:] = h[width:] + (h[:-width] << np.uint32(width))
        width *= 2
    cut = np.zeros(len(data) + 1, dtype=bool)
    cut[1:] = (h & np.uint32(CUT_BITS) << np.uint32(WINDOW)) == 0
    first = np.zeros(len(data) + 1, dtype=bool)  # a character starts
    first[:-1] = (data & 0xC0) != 0x80
    cut &= first
    starts = at[:-1][at[1:] > at[:-1]]
    for i in range(1, WINDOW):  # these places have seen bytes of the text before
        cut[np.minimum(starts + i, len(data))] = False
    cut[at] = True
    ends = np.flatnonzero(cut)
    wide = np.flatnonzero(np.diff(ends) > LONGEST)
    if len(wide):
        extra = np.concatenate([np.arange(ends[i] + LONGEST, ends[i + 1], LONGEST) for i in wide])
        for _ in range(3):
            extra = extra + ~first[extra]
        ends = np.union1d(ends, extra)
    return ends[ends > 0]


def _starts(data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of consecutive chunks: the bytes that start a token, and those that start a character."""
    letter = _LETTER[data]
    first = (data & 0xC0) != 0x80
    goes_on = np.zeros(len(data), dtype=bool)
    goes_on[1:] = letter[1:] & letter[:-1]
    goes_on[at[:-1]] = False
    return first & ~goes_on, first


def _gathered(data: np.ndarray, start: np.ndarray, stop: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of these ranges one after another, and their offsets."""
    at = np.concatenate(([0], np.cumsum(stop - start)))
    return data[np.arange(at[-1]) + np.repeat(start - at[:-1], stop - start)], at


class Summaries:
    """Summaries of chunks by content: tokens, characters, begins with a letter, ends with one."""

    def __init__(self, cache_bytes: int = CACHE_BYTES):
        self.cache: dict[bytes, tuple] = {}
        self.held, self.cache_bytes = 0, cache_bytes

    def _summarise(self, chunks: list[bytes]) -> np.ndarray:
        at = np.concatenate(([0], np.cumsum(np.fromiter(map(len, chunks), np.int64, len(chunks)))))
        data = np.frombuffer(b"".join(chunks), np.uint8)
        tokens, chars = _starts(data, at)
        return np.stack([np.add.reduceat(tokens, at[:-1], dtype=np.int64), np.add.reduceat(chars, at[:-1], dtype=np.int64),
                         _LETTER[data[at[:-1]]], _LETTER[data[at[1:] - 1]]], axis=1)

    def of(self, data: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """A row for each of the consecutive chunks of ``data`` that end there."""
        if not len(ends):
            return np.zeros((0, 4), dtype=np.int64)
        offsets = pa.array(np.concatenate(([0], ends)), pa.int64())
        chunks = pa.Array.from_buffers(pa.large_binary(), len(ends), [None, offsets.buffers()[1], pa.py_buffer(data)])
        coded = chunks.dictionary_encode()
        distinct = coded.dictionary.to_pylist()
        found = [self.cache.get(c) for c in distinct]
        new = [i for i, x in enumerate(found) if x is None]
        if new:
            made = self._summarise([distinct[i] for i in new])
            if self.held > self.cache_bytes:
                self.cache.clear()
                self.held = 0
            for i, row in zip(new, made.tolist()):
                found[i] = row
                if self.held <= self.cache_bytes:
                    self.cache[distinct[i]] = row
                    self.held += len(distinct[i])
        return np.array(found, dtype=np.int64)[coded.indices.to_numpy()]


class Tokens:
    """Token counts of a slice of texts without nulls, and the places where given tokens start."""

    def __init__(self, texts: pa.Array, summaries: Summaries):
        texts = texts.cast(pa.large_binary())
        at = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset:texts.offset + len(texts) + 1]
        held = texts.buffers()[2]
        data = np.frombuffer(held, np.uint8)[at[0]:at[-1]] if held else np.zeros(0, np.uint8)
        self.data, self.at = data, at - at[0]
        self.ends = chunk_ends(data, self.at)
        self.begin = np.concatenate(([0], self.ends[:-1])) if len(self.ends) else self.ends
        tokens, chars, first, last = summaries.of(data, self.ends).T
        inner = ~np.isin(self.begin, self.at)  # the chunk isn't the first of its text
        self.joins = np.zeros(len(self.ends), dtype=np.int64)
        self.joins[1:] = first[1:] & last[:-1] & inner[1:]
        self.tokens = np.concatenate(([0], np.cumsum(tokens - self.joins)))
        self.chars = np.concatenate(([0], np.cumsum(chars)))
        self.chunk = np.searchsorted(self.begin, self.at)  # of every text, the first chunk
        self.counts = np.diff(self.tokens[self.chunk])

    def places(self, nth: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Bytes and characters of each text before its token ``nth``, or all of them if it has no more tokens than that."""
        byte = np.diff(self.at)
        char = self.chars[self.chunk[1:]] - self.chars[self.chunk[:-1]]
        own = np.flatnonzero(nth < self.counts)
        if not len(own):
            return byte, char
        want = self.tokens[self.chunk[own]] + nth[own]
        c = np.searchsorted(self.tokens, want, "right") - 1
        part, at = _gathered(self.data, self.begin[c], self.ends[c])
        tokens, chars = _starts(part, at)
        before = np.concatenate(([0], np.cumsum(tokens)))
        chars = np.concatenate(([0], np.cumsum(chars)))
        place = np.flatnonzero(tokens)[before[at[:-1]] + want - self.tokens[c] + self.joins[c]]
        byte[own] = self.begin[c] - self.at[own] + place - at[:-1]
        char[own] = self.chars[c] - self.chars[self.chunk[own]] + chars[place] - chars[at[:-1]]
        return byte, char


def _transform(texts: pa.Array, draws: np.ndarray, rate: int, spm_rate: int, summaries: Summaries) -> pa.StructArray:
    """The fields of ``SCHEMA`` for a slice of texts without nulls; ``draws``: four numbers for each."""
    t = Tokens(texts, summaries)
    n = t.counts
    one, two = draws[:, 0] % (n + 1), draws[:, 1] % (n + 1)
    a, prefix_chars = t.places(np.minimum(one, two))
    b, to_middle = t.places(np.maximum(one, two))
    marked = np.zeros(len(texts), dtype=bool)
    for mark in (PREFIX, SUFFIX, MIDDLE):
        marked |= pc.match_substring(texts, mark).to_numpy(zero_copy_only=False)
    plain = (n == 0) | marked | (draws[:, 2] % 100 >= rate)
    spm = draws[:, 3] % 100 < spm_rate
    p, s, m = PREFIX.encode(), SUFFIX.encode(), MIDDLE.encode()
    out, data = [], t.data.tobytes()
    for i, (x, y) in enumerate(zip(t.at[:-1].tolist(), t.at[1:].tolist())):
        if plain[i]:
            out.append(data[x:y])
            continue
        i, j = x + int(a[i]), x + int(b[i])
        out.append(b"".join((s, data[j:y], p, data[x:i], m, data[i:j]) if spm[len(out)]
                            else (p, data[x:i], s, data[j:y], m, data[i:j])))
    return pa.StructArray.from_arrays(
        [pa.array(n), pa.array(np.where(plain, "plain", np.where(spm, "spm", "psm"))),
         pa.array(prefix_chars, mask=plain), pa.array(to_middle - prefix_chars, mask=plain),
         pa.array(out, pa.binary()).cast(pa.string())], ["n", "form", "prefix_chars", "middle_chars", "output"])


def fill_in_middle(docs: DataFrame, id: str = "doc_id", text: str = "text", into: str = "infill", seed: int = 1,
                   rate: int = RATE, spm_rate: int = SPM_RATE) -> DataFrame:
    """Add the struct column ``into`` (fields of ``SCHEMA``): each text with its middle moved to the end.

    The cuts and the form depend on the id and ``seed`` alone. Texts without tokens (null counts
    as empty), with one of the marks in them, and those the rate leaves out stay ``plain``: ``output`` is the text,
    ``prefix_chars`` and ``middle_chars`` are null. A null id draws as an empty one. Repeated rows
    get equal results, an empty table stays empty, other columns are untouched (``into`` replaces one
    of that name). A text is taken whole, whatever its length.
    """
    ship(docs.sparkSession)

    @F.arrow_udf(SCHEMA)
    def moved(batches: Iterator[tuple[pa.Array, ...]]) -> Iterator[pa.Array]:
        summaries = Summaries()
        for texts, *numbers in batches:
            draws, done, i = np.stack([x.to_numpy() for x in numbers], axis=1), [], 0
            for part in slices(texts):
                done.append(_transform(part, draws[i:i + len(part)], rate, spm_rate, summaries))
                i += len(part)
            yield pa.concat_arrays(done or [_transform(pc.fill_null(texts, ""), draws, rate, spm_rate, summaries)])

    drawn = free_name(docs, "_drawn")
    hashed = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(col(id).cast("string"), F.lit(""))), 256)
    numbers = [F.conv(F.substring(F.col(drawn), 1 + 8 * i, 8), 16, 10).cast("long") for i in range(4)]
    return docs.withColumn(drawn, hashed).withColumn(into, moved(col(text).cast("string"), *numbers)).drop(drawn)


def restored(output: Column, form: Column) -> Column:
    """The text that :func:`fill_in_middle` made this output of."""
    def between(first: str, second: str | None) -> Column:
        tail = F.substr(output, F.locate(first, output) + len(first))
        return F.substring_index(tail, second, 1) if second else tail

    return (F.when(form == "psm", F.concat(between(PREFIX, SUFFIX), between(MIDDLE, None), between(SUFFIX, MIDDLE)))
            .when(form == "spm", F.concat(between(PREFIX, MIDDLE), between(MIDDLE, None), between(SUFFIX, PREFIX)))
            .otherwise(output))


def op13_chunk_infill(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    out = fill_in_middle(docs, into="f").select("doc_id", "f.*")
    return out.select("doc_id", "n", "form", "prefix_chars", "middle_chars", F.sha2("output", 256).alias("output_sha256"),
                      F.sha2(restored(F.col("output"), F.col("form")), 256).alias("restored_sha256"))


OP13_SQL = """
WITH t AS (
  SELECT doc_id, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '[A-Za-z]+|[^A-Za-z]') AS w,
         sha256('1:' || doc_id) AS h FROM documents),
d AS (
  SELECT doc_id, text, w, len(w) AS n, [CAST('0x' || h[1 + 8 * i:8 + 8 * i] AS BIGINT) FOR i IN range(4)] AS h FROM t),
c AS (
  SELECT doc_id, text, w, n, least(h[1] % (n + 1), h[2] % (n + 1)) AS a, greatest(h[1] % (n + 1), h[2] % (n + 1)) AS b,
         CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') OR h[3] % 100 >= 90
              THEN 'plain' WHEN h[4] % 100 < 20 THEN 'spm' ELSE 'psm' END AS form FROM d),
p AS (
  SELECT doc_id, text, n, form, array_to_string(w[1:a], '') AS prefix, array_to_string(w[a + 1:b], '') AS middle,
         array_to_string(w[b + 1:n], '') AS suffix FROM c)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN length(prefix) END AS prefix_chars,
       CASE WHEN form <> 'plain' THEN length(middle) END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle
              ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END) AS output_sha256,
       sha256(text) AS restored_sha256
FROM p
"""
