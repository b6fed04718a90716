"""Best-fit packing of tokenised documents into sequences of bounded length.

``token_pieces`` tokenises each document and cuts only those longer than a sequence.
``pack`` is a bulk-synchronous best fit. Pieces are range-sorted by length and ranked within
their length; open sequences (gaps) are ranked within their free space. In every round

1. a successor sweep goes up the gap sizes and gives each gap the largest unplaced piece
   that fits, as often as that length fits and pieces are left;
2. conflicts, many pieces for the gaps of one size, are resolved by rank: the pieces of ranks
   ``a, a+1, ...`` go to the gaps of ranks ``b, b+1, ...``;
3. the gaps' free space and ranks are updated and written.

Rounds repeat until all is placed; when nothing fits, new sequences are opened for the tokens
left. Lengths are whole numbers up to the capacity, so the sweep itself runs over at most that
many classes whatever the number of documents (its plan has a size bound, and only plans are
broadcast); documents and gaps stay distributed, a hot length spans many range partitions, and
every round's gaps are a table in the shared folder, which a lost executor can't take away.
"""

from __future__ import annotations

import os
import zlib
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemill.llm.words import col, given_back, ship, slices, split_words
from tidemill.session import fresh_path, stage

PIECES = "array<struct<piece: int, start: long, length: long, ids_crc32: long>>"

#: Bytes of words and ids that are remembered while a task runs, and what one costs besides; new words encoded by the
#: library at once; words in one text for it.
MEMO_BYTES, ENTRY_BYTES, ENCODE_WORDS, TEXT_WORDS = 12 << 20, 24, 16_000, 500

_PUNCTUATION = "".join(chr(c) for c in range(33, 127) if not chr(c).isalnum())

#: A letter or digit, from which the tokenizer always cuts off closing punctuation; and lower-case letters that
#: normalisation leaves alone, so that a run of them is one word to the tokenizer.
_ENDS_PLAIN = "[a-z0-9\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u00ff]$"
_LETTERS = "^[a-z\u00df-\u00f6\u00f8-\u00ff]+$"


def _expanded(first: np.ndarray, n: np.ndarray) -> np.ndarray:
    """``first[0], first[0] + 1, ...``: ``n[0]`` numbers, then as many from ``first[1]`` on as ``n[1]`` says, and so on."""
    at = np.cumsum(n) - n
    return np.repeat(first - at, n) + np.arange(int(n.sum()))


class WordIds:
    """Ids of texts from a tokenizer that never joins across ASCII white space; made for the distinct words of a slice."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer, pre_tokenizers

        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        # the same model for words of letters alone, which normalisation leaves as they are
        self.letters = Tokenizer(self.model)
        self.letters.pre_tokenizer = pre_tokenizers.Sequence([
            pre_tokenizers.WhitespaceSplit(), pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)])
        end, vocab = self.model.end_of_word_suffix, self.tokenizer.get_vocab()
        #: Whether an id is the last of a word.
        self.last = np.zeros(max(vocab.values()) + 1, dtype=bool)
        self.last[[i for token, i in vocab.items() if end and token.endswith(end)]] = True

    def _encode(self, texts: list[str]) -> list[list[int]]:
        return [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _units(self, words: pa.Array) -> tuple[pa.Array, np.ndarray, np.ndarray]:
        """What the tokenizer takes apart at most, and which two of them each word is: it without its closing
        punctuation in lower case, and the punctuation (none for other words, which are taken as they are)."""
        low = pc.ascii_lower(words)
        body = pc.ascii_rtrim(low, characters=_PUNCTUATION)
        cut = pc.and_(pc.match_substring_regex(body, _ENDS_PLAIN), pc.invert(pc.match_substring(words, "<")))
        body = pc.if_else(cut, body, words)
        tail = _after(pc.if_else(cut, low, ""), pc.if_else(cut, pc.binary_length(body), 0))
        both = pa.concat_arrays([body, tail]).dictionary_encode()
        codes = both.indices.to_numpy()
        return both.dictionary, codes[:len(words)], codes[len(words):]

    def _each(self, units: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids of units, in their order, and the number of each one's, by one call for each unit."""
        ids = [x for i in range(0, len(units), ENCODE_WORDS) for x in self._encode(units[i:i + ENCODE_WORDS].to_pylist())]
        n = np.fromiter(map(len, ids), np.int64, len(ids))
        return np.fromiter(chain.from_iterable(ids), "<u4", int(n.sum())), n

    def _joined(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """:meth:`_each` of words of letters, many of them in one text: a word's last id shows where it ends."""
        flat = [np.zeros(0, "<u4")]
        for i in range(0, len(words), ENCODE_WORDS):
            part = words[i:i + ENCODE_WORDS]
            ends = pa.array([*range(0, len(part), TEXT_WORDS), len(part)], pa.int32())
            texts = pc.binary_join(pa.ListArray.from_arrays(ends, part), " ").to_pylist()
            flat += [np.array(e.ids, "<u4") for e in self.letters.encode_batch_fast(texts, add_special_tokens=False)]
        flat = np.concatenate(flat)
        ends = np.flatnonzero(self.last[flat]) + 1
        if len(ends) != len(words):  # a model that doesn't mark the ends of words
            return self._each(words)
        return flat, np.diff(ends, prepend=0)

    def _ids(self, units: pa.Array, memo: Memo) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids, and the first and the number of each unit's in them; those of letters only go straight to the tokenizer's model."""
        first, n = np.zeros(len(units), np.int64), np.zeros(len(units), np.int64)
        at = pc.index_in(units, value_set=memo.words)
        met = at.is_valid().to_numpy(zero_copy_only=False)
        known = at.drop_null().to_numpy()
        first[met], n[met] = memo.first[known], memo.n[known]
        flat = [memo.flat]
        before, new = len(memo.flat), []
        unmet = np.flatnonzero(~met)
        rest = units.take(pa.array(unmet))
        plain = pc.match_substring_regex(rest, _LETTERS)
        for kind, make in ((plain, self._joined), (pc.invert(plain), self._each)):
            where, words = unmet[kind.to_numpy(zero_copy_only=False)], rest.filter(kind)
            made, sizes = make(words)
            first[where], n[where] = before + np.cumsum(sizes) - sizes, sizes
            before += len(made)
            flat.append(made)
            new.append((words, made, sizes))
        for words, made, sizes in new:
            memo.keep(words, made, sizes)
        return np.concatenate(flat), first, n

    def ids(self, texts: pa.Array, memo: Memo) -> Iterator[bytes]:
        """Little-endian 32-bit ids of each whole text of a slice without nulls."""
        whole = np.zeros(len(texts), dtype=bool)
        for s in self.special:  # the library's own handling of texts that hold their strings
            whole |= pc.match_substring(texts, s).to_numpy(zero_copy_only=False)
        codes, offsets, distinct = split_words(texts)
        units, body, tail = self._units(distinct)
        flat, first, n = self._ids(units, memo)
        two = np.stack([body, tail], axis=1).ravel()  # every word's ids in one place
        flat, n = flat[_expanded(first[two], n[two])], n[body] + n[tail]
        first = np.cumsum(n) - n
        all_ids = flat[_expanded(first[codes], n[codes])]
        ends = np.concatenate(([0], np.cumsum(n[codes])))[offsets]
        for i in range(len(texts)):
            if whole[i]:
                yield np.array(self._encode([texts[i].as_py()])[0], dtype="<u4").tobytes()
            else:
                yield all_ids[ends[i]:ends[i + 1]].tobytes()


class Memo:
    """Ids of words, up to a number of bytes: the words met first, the most frequent among them. It changes no result."""

    def __init__(self, size: int = MEMO_BYTES):
        self.words, self.flat = pa.array([], pa.string()), np.zeros(0, "<u4")
        self.first, self.n = np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.left = size

    def keep(self, words: pa.Array, flat: np.ndarray, n: np.ndarray) -> None:
        """Remember new words with ``n`` ids each, which ``flat`` holds one after the other: as many as there is room for."""
        cost = np.cumsum(ENTRY_BYTES + pc.binary_length(words).to_numpy(zero_copy_only=False) + 4 * n)
        k = int(np.searchsorted(cost, self.left, "right"))
        if k:
            self.left -= int(cost[k - 1])
            n = n[:k]
            self.first = np.concatenate([self.first, len(self.flat) + np.cumsum(n) - n])
            self.flat = np.concatenate([self.flat, flat[:int(n.sum())]])
            self.n = np.concatenate([self.n, n])
            self.words = pa.concat_arrays([self.words, words.slice(0, k)])


def _after(texts: pa.Array, n: pa.Array) -> pa.Array:
    """Each text without its first ``n`` bytes, which end a character."""
    at = np.frombuffer(texts.buffers()[1], np.int32)[texts.offset:texts.offset + len(texts) + 1].astype(np.int64)
    n = n.to_numpy(zero_copy_only=False)
    size = np.diff(at) - np.minimum(n, np.diff(at))
    data = texts.buffers()[2]
    kept = np.frombuffer(data, np.uint8)[_expanded(at[1:] - size, size)] if data else np.zeros(0, np.uint8)
    ends = np.concatenate(([0], np.cumsum(size))).astype(np.int32)
    return pa.Array.from_buffers(pa.string(), len(texts), [None, pa.py_buffer(ends), pa.py_buffer(kept)])


@lru_cache(maxsize=1)
def _word_ids(path: str) -> WordIds:
    return WordIds(path)


def token_pieces(docs: DataFrame, tokenizer: str, capacity: int, separator: int = 0, text: str = "text",
                 into: str = "pieces") -> DataFrame:
    """Add the array column ``into``: the pieces of each text's ids followed by ``separator``.

    Only texts of more than ``capacity`` ids have several pieces, all full but the last. A
    null or empty text is one piece with the separator alone.
    """
    ship(docs.sparkSession)
    end, step = np.array([separator], dtype="<u4").tobytes(), 4 * capacity

    @F.arrow_udf(PIECES)
    def pieces(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        ids_of, memo = _word_ids(tokenizer), Memo()
        for batch in given_back(batches):
            at, piece, start, length, crc = [0], [], [], [], []
            for part in slices(batch):
                for ids in ids_of.ids(part, memo):
                    ids += end
                    for k, i in enumerate(range(0, len(ids), step)):
                        own = ids[i:i + step]
                        piece.append(k)
                        start.append(i // 4)
                        length.append(len(own) // 4)
                        crc.append(zlib.crc32(own))
                    at.append(len(piece))
            yield pa.ListArray.from_arrays(pa.array(at, pa.int32()), pa.StructArray.from_arrays(
                [pa.array(piece, pa.int32()), pa.array(start, pa.int64()), pa.array(length, pa.int64()),
                 pa.array(crc, pa.int64())], ["piece", "start", "length", "ids_crc32"]))

    return docs.withColumn(into, pieces(col(text).cast("string")))


def sweep(left: dict[int, int], gaps: dict[int, int], taken: dict[int, int]) -> list[tuple[int, int, int, int, int, int]]:
    """One successor sweep over size classes: ``(length, first rank, gap size, first gap rank, pieces a gap, gaps)``.

    ``left``: unplaced pieces by length; ``gaps``: gaps by free space; ``taken``: pieces of
    each length placed so far, which is the rank of the next. Changes ``left`` and ``taken``.

    >>> sweep({5: 3, 2: 4}, {4: 1, 10: 2}, {})
    [(2, 0, 4, 0, 2, 1), (5, 0, 10, 0, 2, 1), (5, 2, 10, 1, 1, 1)]
    """
    lengths, at, stack, plan = sorted(x for x, n in left.items() if n), 0, [], []
    for size in sorted(gaps):
        while at < len(lengths) and lengths[at] <= size:
            stack.append(lengths[at])
            at += 1
        rank, free = 0, gaps[size]
        while free and stack:
            length = stack[-1]
            each = min(size // length, left[length])
            n = min(free, left[length] // each)
            plan.append((length, taken.get(length, 0), size, rank, each, n))
            taken[length] = taken.get(length, 0) + n * each
            left[length] -= n * each
            rank, free = rank + n, free - n
            if not left[length]:
                stack.pop()
    return plan


def _ranked(pieces: DataFrame, key: str, length: str) -> DataFrame:
    """``key, length, rank``: the rank from 0 among equal lengths, by range partitions that a hot length may fill."""
    ranged = stage(pieces.select(col(key).alias("key"), col(length).alias("length"))
                   .repartitionByRange("length", "key").withColumn("part", F.spark_partition_id()), "pack-sorted")
    counts = ranged.groupBy("length", "part").agg(F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("length", "part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))
    local = F.row_number().over(Window.partitionBy("length", "part").orderBy("key")) - 1
    return (ranged.withColumn("local", local).join(offsets, ["length", "part"])
            .select("key", "length", (F.col("before") + F.col("local")).alias("rank")))


def pack(pieces: DataFrame, key: str, length: str, capacity: int) -> DataFrame:
    """``key, sequence_id, offset`` of each piece: a place for all of them in sequences of at most ``capacity``.

    ``key`` must be unique and not null, ``length`` from 1 to ``capacity``. Equal lengths are
    taken in the order of ``key``. An empty table gives no rows. Sequences have no holes:
    offsets go from 0 without a gap.
    """
    spark = pieces.sparkSession
    ranked = stage(_ranked(pieces, key, length), "pack-ranked")
    left = {r["length"]: r["n"] for r in ranked.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}
    if any(n < 1 or n > capacity for n in left):
        raise ValueError(f"lengths must be from 1 to {capacity}")
    taken: dict[int, int] = {}
    sizes: dict[int, int] = {}
    log, rounds, opened, parts = fresh_path(spark, "pack-gaps"), [], 0, max(1, ranked.rdd.getNumPartitions())
    gaps, plans = None, []
    while any(left.values()):
        smallest = min(x for x, n in left.items() if n)
        if not any(size >= smallest for size in sizes):
            new = -(-sum(x * n for x, n in left.items()) // capacity)
            fresh = spark.range(opened, opened + new, 1, parts).select(
                F.col("id").alias("sequence_id"), F.lit(capacity).cast("long").alias("free"),
                (F.col("id") - opened + sizes.get(capacity, 0)).alias("rank"))
            gaps = fresh if gaps is None else gaps.unionByName(fresh)
            sizes[capacity] = sizes.get(capacity, 0) + new
            opened += new
        plan = sweep(left, sizes, taken)
        # the gaps after this round, by free space: first what no piece was given to, then what the plan leaves
        now, steps, used = {}, [], {}
        for _, _, size, _, _, n in plan:
            used[size] = used.get(size, 0) + n
        for size, n in sizes.items():
            rest = n - used.get(size, 0)
            if rest and size >= smallest:
                steps.append((None, None, size, used.get(size, 0), 0, rest, size, now.get(size, 0)))
                now[size] = now.get(size, 0) + rest
        for length_, first, size, rank, each, n in plan:
            free = size - each * length_
            steps.append((len(plans), length_, size, rank, each, n, free, now.get(free, 0)))
            now[free] = now.get(free, 0) + n
            plans.append((len(plans), length_, first, each, n))
        table = spark.createDataFrame(steps, "step long, length_ long, free long, from_rank long, each long, n long,"
                                             " free_after long, rank_after long")
        own = (F.col("rank") >= F.col("from_rank")) & (F.col("rank") < F.col("from_rank") + F.col("n"))
        path = f"{log}/round={len(rounds)}"
        (gaps.join(F.broadcast(table), "free").where(own)
         .select("sequence_id", "free", "step", (F.col("rank") - F.col("from_rank")).alias("i"), "free_after",
                 (F.col("rank_after") + F.col("rank") - F.col("from_rank")).alias("rank_after"))
         .write.parquet(path))
        rounds.append(path)
        gaps = spark.read.parquet(path).select("sequence_id", F.col("free_after").alias("free"),
                                               F.col("rank_after").alias("rank"))
        sizes = now
    if not rounds:
        return spark.createDataFrame([], f"{key} long, sequence_id long, offset long")
    taken_gaps = spark.read.parquet(*rounds).where("step is not null").select("step", "i", "sequence_id", "free")
    plan = spark.createDataFrame(plans, "step long, length long, first long, each long, n long")
    place = F.col("rank") - F.col("first")
    placed = (ranked.join(F.broadcast(plan), "length").where((place >= 0) & (place < F.col("each") * F.col("n")))
              .select("key", "length", "step", F.floor(place / F.col("each")).alias("i"),
                      (place % F.col("each")).alias("slot")))
    return placed.join(taken_gaps, ["step", "i"]).select(
        F.col("key").alias(key), "sequence_id",
        (F.lit(capacity) - F.col("free") + F.col("slot") * F.col("length")).cast("long").alias("offset"))


def packed_documents(docs: DataFrame, tokenizer: str, capacity: int = 2048, text: str = "text",
                     id: str = "doc_id") -> DataFrame:
    """The pieces of all documents with their places: one row per piece.

    A null ``id`` is carried as it is; repeated rows are packed as often as they occur.
    """
    cut = token_pieces(docs.select(col(id).alias("doc_id"), col(text).alias("text")), tokenizer, capacity)
    rows = stage(cut.select("doc_id", F.inline("pieces")).withColumn("key", F.monotonically_increasing_id()),
                 "pack-pieces")
    places = pack(rows.select("key", "length"), "key", "length", capacity)
    return rows.join(places, "key").select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


def op3_bulk_best_fit(spark, sf_dir: str) -> DataFrame:
    import public_tokenizers

    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return packed_documents(docs, str(public_tokenizers.path("word_bpe_49k.json")))
