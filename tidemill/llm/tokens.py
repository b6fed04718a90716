"""Token counts of a byte-pair model with byte fallback, by heap-and-linked-list merging.

A text is cut into units across which the model can't merge (see ``PairMerges.units``).
Each unit is a doubly linked list of symbols; a heap holds the adjacent pairs the
vocabulary can join, and the lowest-rank pair (leftmost on ties) is merged until none is
left. The count is the initial symbols (a character outside the vocabulary counts as its
UTF-8 bytes) minus the merges; no identifier is made.

Units repeat, so their counts are kept in a memo of bounded size. It changes no result.
Rows are independent: no shuffle, and a lost task repeats its own rows only.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache
from heapq import heapify, heappop, heappush

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemill.llm.words import col, ship, slices

SCHEMA = "n_bytes long, n_tokens long, over_limit boolean"

#: The counts of so many units, of so many characters at most, are remembered.
MEMO_UNITS, MEMO_CHARS = 500_000, 40

#: Fixed values of the model file: the mark that stands for a space, and the kinds of pieces.
SPACE = "▁"
NORMAL, UNKNOWN, CONTROL, USER_DEFINED, UNUSED, BYTE = 1, 2, 3, 4, 5, 6


class _Memo(dict):
    """Counts by unit, made on demand."""

    def __init__(self, count):
        self.count = count

    def __missing__(self, unit: str) -> int:
        n = self.count(unit)
        if len(unit) <= MEMO_CHARS:
            if len(self) >= MEMO_UNITS:
                self.clear()
            self[unit] = n
        return n


class PairMerges:
    """The merges of a byte-pair vocabulary: ``ranks`` has each piece that a pair may become, lowest first."""

    def __init__(self, ranks: dict[str, int], single: set[str]):
        self.ranks, self.single = ranks, single
        crossing = [p for p in ranks if SPACE in p.lstrip(SPACE)]
        if crossing:
            raise ValueError(f"pieces cross a space: {crossing[:3]}")
        self.inner = {p[i:i + 2] for p in ranks for i in range(len(p) - 1)}
        self.memo = _Memo(self.count_unit)
        self.part_memo = _Memo(self.count_part)

    @classmethod
    def load(cls, path: str) -> PairMerges:
        """From a model file of the sentencepiece library (byte-pair kind, byte fallback, no normalisation)."""
        from sentencepiece import SentencePieceProcessor

        model = SentencePieceProcessor(model_file=path)
        plain = [i for i in range(model.get_piece_size())
                 if not (model.is_unknown(i) or model.is_control(i) or model.is_unused(i) or model.is_byte(i))]
        pieces = {model.id_to_piece(i): -model.get_score(i) for i in plain}
        order = {score: rank for rank, score in enumerate(sorted(set(pieces.values())))}
        return cls({p: order[s] for p, s in pieces.items() if len(p) > 1}, {p for p in pieces if len(p) == 1})

    def count_unit(self, unit: str) -> int:
        """Tokens of one unit (spaces already marked): the sum over parts whose border no piece spans."""
        inner, cut, tokens = self.inner, 0, 0
        for i in range(1, len(unit)):
            if unit[i - 1:i + 1] not in inner:
                tokens += self.part_memo[unit[cut:i]]
                cut = i
        return tokens + (self.part_memo[unit[cut:]] if cut else self.count_part(unit))

    def count_part(self, part: str) -> int:
        """Tokens of one part. Heap entries hold rank, place and joint length in one number."""
        get, single = self.ranks.get, self.single
        n = tokens = len(part)
        for c in part:
            if c not in single:
                tokens += len(c.encode()) - 1
        if n < 2:
            return tokens
        wide = n.bit_length()
        mask, shift = (1 << wide) - 1, 2 * wide
        heap = []
        for i in range(n - 1):
            r = get(part[i:i + 2])
            if r is not None:
                heap.append(r << shift | i << wide | 2)
        if not heap:
            return tokens
        heapify(heap)
        piece = list(part)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        while heap:
            entry = heappop(heap)
            i = entry >> wide & mask
            left, j = piece[i], after[i]
            if not left or j >= n or len(left) + len(piece[j]) != entry & mask:
                continue  # one of the two has been merged since
            left = piece[i] = left + piece[j]
            piece[j] = ""
            tokens -= 1
            k = after[i] = after[j]
            if k < n:
                before[k] = i
                both = left + piece[k]
                r = get(both)
                if r is not None:
                    heappush(heap, r << shift | i << wide | len(both))
            h = before[i]
            if h >= 0:
                both = piece[h] + left
                r = get(both)
                if r is not None:
                    heappush(heap, r << shift | h << wide | len(both))
        return tokens

    @staticmethod
    def units(text: str) -> list[str]:
        """Runs of marked spaces with the rest that follows; no piece but a run of spaces holds an inner one."""
        marked = SPACE + text.replace(" ", SPACE)
        if SPACE + SPACE in marked:
            return _UNIT.findall(marked)
        return [SPACE + rest for rest in marked.split(SPACE)[1:]]

    def count(self, text: str) -> int:
        """Tokens of a whole text; an empty one has none."""
        return sum(map(self.memo.__getitem__, self.units(text))) if text else 0


_UNIT = re.compile(f"{SPACE}+[^{SPACE}]*")


@lru_cache(maxsize=2)
def _merges(path: str) -> PairMerges:
    return PairMerges.load(path)


def token_counts(docs: DataFrame, model: str, text: str = "text", into: str = "tokens",
                 limit: int = 4096) -> DataFrame:
    """Add the struct column ``into``: ``n_bytes``, ``n_tokens`` and ``over_limit`` of each whole text.

    ``model``: the model file, at the same path on every executor. A null text counts as
    empty: no bytes, no tokens. Repeated rows get equal counts; an empty table stays empty;
    other columns are untouched (``into`` replaces a column of that name).
    """
    ship(docs.sparkSession)

    @F.arrow_udf(SCHEMA)
    def counts(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        merges = _merges(model)
        for batch in batches:
            n_bytes, n_tokens = [], []
            for part in slices(batch):
                for value in part.to_pylist():
                    n_bytes.append(len(value.encode()))
                    n_tokens.append(merges.count(value))
            yield pa.StructArray.from_arrays(
                [pa.array(n_bytes, pa.int64()), pa.array(n_tokens, pa.int64()),
                 pa.array([n > limit for n in n_tokens], pa.bool_())], ["n_bytes", "n_tokens", "over_limit"])

    return docs.withColumn(into, counts(col(text).cast("string")))


def op2_heap_merge_counts(spark, sf_dir: str) -> DataFrame:
    import public_tokenizers

    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    out = token_counts(docs, str(public_tokenizers.path("piece_bpe_32k.model")), into="t")
    return out.select("doc_id", F.col("t.n_bytes").alias("n_bytes"), F.col("t.n_tokens").alias("n_tokens"),
                      F.col("t.over_limit").alias("over_limit"))
