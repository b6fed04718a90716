"""Scores of documents under a hierarchical Pitman-Yor language model, seated by Gibbs sampling.

Two levels share one vocabulary: a parent restaurant over words, whose base is uniform over the
vocabulary and one unknown word, and a restaurant for each context, whose base is the parent.
A context is the word before, or the start of a text. Every table of a context restaurant is a
customer of the parent.

* Slices: texts are split once, into stored slices of ``SLICE_BYTES``: the slice's words as 64-bit
  hashes, and its tokens as places among them, compressed. The start of a text is the word that ends one.
* Words are dealt to parts by ranges of their hashes. All that slices, buckets and parts tell each other
  are rows of compressed arrays, one for each two of them.
* Counting: each slice sends its (word, context) cells to buckets, in which they are added up. A
  bucket holds whole contexts; the cells of the most frequent contexts are dealt over all buckets.
  A bucket remembers which of its cells each slice has.
* Gibbs sampling: a sweep gives each bucket its words' numbers, takes each cell's customers out and
  seats them again by the restaurant's predictive odds, given all the others. The tables are then
  added up by context in the bucket and by word in the parts, and seated in the parent. Buckets
  sweep in parallel, with the numbers of the sweep before; each sweep is a table in the shared folder.
  A cell's first ``SINGLE`` customers sit down one by one, later ones in blocks of a sixteenth
  of those seated: a block's new tables are drawn from a binomial, customer by customer. A cell of one customer has one possible seating and needs none of this.
* Predictive probabilities are averaged over the last sweeps of the sampled rounds.
* Scoring: the buckets answer each slice for its cells, in the order in which it sent them, and the parts for
  its words. What comes back is joined with the slice, which adds up its texts.
* A word is in at most one row for each slice or bucket in any shuffle, so that no common word gathers rows in one task.
* Each step is stored, and its shuffle files are freed when it is.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemill.llm.words import col, given_back, ship, slices, split_words
from tidemill.session import discard, freed_shuffles, staged

#: Contexts shown by ``Model.words``; most contexts that are dealt over all buckets; rounds of sampling, of which the first isn't averaged; sweeps a round.
CONTEXTS, HEAVY, ROUNDS, BURN_IN, SWEEPS = 64, 20_000, 3, 1, 2
#: Strength of both levels; their discounts are estimated from the counts of counts.
STRENGTH = 1.0
SINGLE = 64
#: Numbers drawn at once.
DRAWS = 1 << 20
SLICE_BYTES = 16 << 20
#: Training tokens of a bucket, at most, where there are more than two buckets for each shuffle partition.
BUCKET_TOKENS = 4 << 20
#: Words of all slices, each counted in every slice that has it, for a part, where there are more than four parts for each core.
PART_WORDS = 1 << 20
#: Dealt contexts whose tables travel in one row of a bucket.
DEALT = 128
#: The end of a text, as a word that no text holds.
END = b"\n"
#: splitmix64's constants.
MIX = [0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB]


def _uniform(h: np.ndarray, *salt) -> np.ndarray:
    """Numbers in [0, 1) that depend on the arguments alone, so that a repeated task draws the same."""
    x = h.astype(np.uint64)
    with np.errstate(over="ignore"):
        for s in salt:
            x = x + (np.asarray(s).astype(np.uint64) + np.uint64(1))
            x *= np.uint64(MIX[0])
            x ^= x >> np.uint64(30)
            x *= np.uint64(MIX[1])
            x ^= x >> np.uint64(27)
            x *= np.uint64(MIX[2])
            x ^= x >> np.uint64(31)
    return (x >> np.uint64(11)) / float(1 << 53)


def seat(n: np.ndarray, odds: np.ndarray, gain: np.ndarray, discount: float, draw) -> np.ndarray:
    """Tables of cells with ``n`` customers; a new table has weight ``odds + gain * tables``.

    ``draw(cells, i, j)``: numbers in [0, 1) for each of these cells (rows), with ``i`` customers seated, and
    each customer ``j`` of the next block (columns).
    """
    tables = np.minimum(n, 1).astype(np.float64)
    cells, i = np.flatnonzero(n > 1), 1
    while len(cells):
        size = 1 if i < SINGLE else i // 16
        block = np.minimum(size, n[cells] - i)
        new = odds[cells] + gain[cells] * tables[cells]
        p = new / (new + i - discount * tables[cells])
        for first in range(0, size, DRAWS):
            j = np.arange(first, min(size, first + DRAWS))
            step = max(1, DRAWS // len(j))
            for own in (slice(a, a + step) for a in range(0, len(cells), step)):
                fresh = (draw(cells[own], i, j) < p[own, None]) & (j < block[own, None])
                tables[cells[own]] += fresh.sum(axis=1)
        i += size
        cells = cells[n[cells] > i]
    return tables


_ZSTD = pa.Codec("zstd", 1)


def _packed(numbers: np.ndarray) -> bytes:
    """Whole numbers from 0 on, in as few planes of bytes as they need, compressed."""
    width = max(1, (int(numbers.max()).bit_length() + 7) // 8) if len(numbers) else 1
    planes = np.ascontiguousarray(numbers, "<u8").view(np.uint8).reshape(len(numbers), 8)[:, :width].T
    return bytes([width]) + len(numbers).to_bytes(8, "little") + _ZSTD.compress(
        np.ascontiguousarray(planes).tobytes(), asbytes=True)


def _unpacked(packed: bytes) -> np.ndarray:
    width, size = packed[0], int.from_bytes(packed[1:9], "little")
    out = np.zeros((size, 8), np.uint8)
    if size:
        flat = _ZSTD.decompress(packed[9:], decompressed_size=width * size)
        out[:, :width] = np.frombuffer(flat, np.uint8).reshape(width, size).T
    return out.view("<i8").ravel().astype(np.int64, copy=False)


def _ascending(packed: bytes) -> np.ndarray:
    """Places in their order, of which the steps are packed."""
    return np.cumsum(_unpacked(packed))


def _steps(places: np.ndarray) -> bytes:
    return _packed(np.diff(places, prepend=0))


def _hashes(packed: bytes) -> np.ndarray:
    return np.frombuffer(packed, np.int64)


def _places(found: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    """The place of each of ``wanted`` among ``found``, which are in order; -1: not there."""
    if not len(found):
        return np.full(len(wanted), -1)
    at = np.minimum(np.searchsorted(found, wanted), len(found) - 1)
    return np.where(found[at] == wanted, at, -1)


def _by_part(h: np.ndarray, parts: int) -> Iterator[tuple[int, slice]]:
    """The parts that some of these hashes belong to, and where these are; ``h`` is in order, and so are the parts."""
    part = np.minimum(((h / 2.0 ** 64 + 0.5) * parts).astype(np.int64), parts - 1)
    found, first = np.unique(part, return_index=True)
    yield from zip(found.tolist(), map(slice, first.tolist(), [*first[1:].tolist(), len(h)]), strict=True)


def _sums(places: np.ndarray, of: np.ndarray, size: int) -> np.ndarray:
    """Sums of whole numbers by place."""
    return np.bincount(places, of, size).astype(np.int64)


#: Columns of packed cells.
CELL = ("contexts", "per", "words", "k", "n")
CELLS = ", ".join(f"{c} binary" for c in CELL)


class Cells:
    """Cells of a slice or bucket, those of a context one after the other: places ``x`` and ``k`` among the hashes of
    their ``contexts`` and ``words``, and their customers ``n``."""

    def __init__(self, contexts: np.ndarray, words: np.ndarray, x: np.ndarray, k: np.ndarray, n: np.ndarray):
        self.contexts, self.words, self.x, self.k, self.n = contexts, words, x, k, n

    @classmethod
    def read(cls, row: dict) -> Cells:
        per = _unpacked(row["per"])
        return cls(_hashes(row["contexts"]), _hashes(row["words"]), np.repeat(np.arange(len(per)), per),
                   _unpacked(row["k"]), _unpacked(row["n"]))

    def row(self) -> dict:
        return {"contexts": self.contexts.tobytes(), "per": _packed(np.bincount(self.x, minlength=len(self.contexts))),
                "words": self.words.tobytes(), "k": _packed(self.k), "n": _packed(self.n)}

    def where(self, keep: np.ndarray) -> Cells:
        """Some of the cells, with their words and contexts only."""
        x, (ks, k) = self.x[keep], np.unique(self.k[keep], return_inverse=True)
        first = np.diff(x, prepend=-1) > 0
        return Cells(self.contexts[x[first]], self.words[ks], np.cumsum(first) - 1, k, self.n[keep])

    @classmethod
    def added(cls, parts: list[Cells]) -> Cells:
        """The cells of all ``parts``, each once, by the order of their hashes."""
        def place(name: str, at: str) -> tuple[np.ndarray, np.ndarray]:
            every = [getattr(p, name) for p in parts]
            found, places = np.unique(np.concatenate(every), return_inverse=True)
            start = np.cumsum([0, *map(len, every)])
            return found, np.concatenate([places[s + getattr(p, at)] for s, p in zip(start, parts, strict=False)])

        (contexts, x), (words, k) = place("contexts", "x"), place("words", "k")
        cell, places = np.unique(x * len(words) + k, return_inverse=True)
        return cls(contexts, words, *np.divmod(cell, max(1, len(words))),
                   _sums(places, np.concatenate([p.n for p in parts]), len(cell)))

    def find(self, other: Cells) -> np.ndarray:
        """The place of each of ``other``'s cells among these, which are in the order of :meth:`added`; -1: not there."""
        x, k = _places(self.contexts, other.contexts)[other.x], _places(self.words, other.words)[other.k]
        return _places(self.x * len(self.words) + self.k, np.where((x < 0) | (k < 0), -1, x * len(self.words) + k))


class Slice:
    """A stored slice of texts: ``token`` and ``context`` are places among the hashes of its ``words``, which are in order."""

    def __init__(self, row: dict):
        words, self.n_tokens = _hashes(row["words"]), _unpacked(row["lengths"])
        order = np.argsort(words)
        place = np.empty_like(order)
        place[order] = np.arange(len(order))
        self.words, self.token, self.train = words[order], place[_unpacked(row["codes"])], _unpacked(row["train"])
        self.context = np.roll(self.token, 1)  # the last token is an end

    def cells(self) -> np.ndarray:
        """A number for each token's (word, context)."""
        return self.context * len(self.words) + self.token

    def dealt(self, cell: np.ndarray, spread: np.ndarray, buckets: int) -> Iterator[tuple[int, np.ndarray]]:
        """Each bucket that some of these cells belong to, and the places of these."""
        x, k = np.divmod(cell, len(self.words))
        bucket = (_uniform(self.words, 0) * buckets).astype(np.int32)[x]
        wide = np.isin(self.words, spread)[x]
        bucket[wide] = (_uniform(self.words[x[wide]], self.words[k[wide]]) * buckets).astype(np.int32)
        order = np.argsort(bucket.astype(np.uint16) if buckets < 1 << 16 else bucket, kind="stable")
        found, first = np.unique(bucket[order], return_index=True)
        yield from zip(found.tolist(), np.split(order, first[1:]), strict=False)

    def sent(self, cell: np.ndarray, n: np.ndarray) -> Cells:
        """Numbered cells, ascending, as others read them."""
        x, k = np.divmod(cell, len(self.words))
        return Cells(self.words, self.words, x, k, n).where(slice(None))


def _rows(table: pa.Table | pa.RecordBatch) -> Iterator[dict]:
    for i in range(table.num_rows):
        yield {c: table.column(c)[i].as_py() for c in table.schema.names}


def _table(rows: list[dict], schema: pa.Schema) -> pa.Table:
    return pa.Table.from_pylist(rows, schema=schema)


ARROW = {"int": pa.int32(), "long": pa.int64(), "binary": pa.binary()}
ARROW |= {f"array<{k}>": pa.list_(v) for k, v in ARROW.items()}


def _schema(columns: str) -> pa.Schema:
    return pa.schema([(name, ARROW[kind]) for name, kind in map(str.split, columns.split(", "))])


def _told(df: DataFrame, make: Callable[[dict], Iterator[dict]], columns: str) -> DataFrame:
    """The rows that ``make`` gives for each row of ``df``."""
    schema = _schema(columns)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in _rows(batch):
                yield from _table(list(make(row)), schema).to_batches()

    return df.mapInArrow(lambda batches: given_back(run(batches)), columns)


def _met(left: DataFrame, right: DataFrame, by: str, make: Callable[[pa.Table, pa.Table], list[dict]], columns: str) -> DataFrame:
    """The rows that ``make`` gives for the rows of both sides of one ``by``, where ``left`` has any."""
    schema = _schema(columns)

    def run(ours: pa.Table, theirs: pa.Table) -> pa.Table:
        return _table(make(ours, theirs), schema) if ours.num_rows else schema.empty_table()

    return left.groupBy(by).cogroup(right.groupBy(by)).applyInArrow(_light(run), columns)


def _stored(df: DataFrame, label: str) -> tuple[DataFrame, str]:
    """:func:`staged`, after which the shuffle files are freed."""
    with freed_shuffles(df.sparkSession):
        return staged(df, label)


def split(docs: DataFrame, id: Column, text: Column, train: Column) -> tuple[DataFrame, str]:
    """The stored slices of ``docs``, and their folder; a null text counts as empty."""
    ship(docs.sparkSession)
    source = docs.select(F.monotonically_increasing_id().alias("slice"), id.alias("id"), text.cast("string").alias("text"),
                         train.alias("train"))
    kind = source.schema["id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = 0
            for part in slices(batch.column("text"), SLICE_BYTES):
                n = len(part)
                first, ids, train = (batch.column(c).slice(at, n) for c in ("slice", "id", "train"))
                at, train = at + n, train.to_numpy(zero_copy_only=False).astype(bool)
                codes, offsets, distinct = split_words(pc.ascii_lower(part))
                words = distinct.cast(pa.binary()).to_pylist() + [END]
                hashes = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words)).view(np.int64)
                n_tokens = np.diff(offsets) + 1
                token = np.full(len(codes) + n, len(words) - 1)
                inner = np.ones(len(token), dtype=bool)
                inner[np.cumsum(n_tokens) - 1] = False
                token[inner] = codes
                hashes, places = np.unique(hashes, return_inverse=True)
                token = places[token]
                often = np.argsort(-np.bincount(token, minlength=len(hashes)), kind="stable")
                rank = np.empty(len(often), np.int64)
                rank[often] = np.arange(len(often))
                token = rank[token]
                own = np.bincount(token[np.repeat(train, n_tokens)], minlength=len(hashes))
                yield pa.RecordBatch.from_arrays(
                    [first[:1], pa.ListArray.from_arrays(pa.array([0, n], pa.int32()), ids),
                     *(pa.array([b], pa.binary()) for b in (hashes[often].tobytes(), _packed(own), _packed(n_tokens),
                                                            _packed(token), _packed(train))),
                     pa.array([len(often)], pa.int64())], ["slice", "ids", "words", "own", "lengths", "codes", "train", "size"])

    return _stored(source.mapInArrow(lambda batches: given_back(run(batches)), f"slice long, ids array<{kind}>, words binary, own binary, "
                                     "lengths binary, codes binary, train binary, size long"), "lm-slices")


def _sent(texts: DataFrame, spread: np.ndarray, buckets: int) -> DataFrame:
    """The cells of the slices, with their customers in training texts, a row for each slice and bucket."""
    def run(row: dict) -> Iterator[dict]:
        s = Slice(row)
        mark, count = np.unique(2 * s.cells() + np.repeat(s.train, s.n_tokens), return_counts=True)
        cell, first = np.unique(mark >> 1, return_index=True)
        n = np.add.reduceat(count * (mark & 1), first)
        for bucket, places in s.dealt(cell, spread, buckets):
            yield s.sent(cell[places], n[places]).row() | {"bucket": bucket, "slice": row["slice"]}

    return _told(texts.select("slice", "words", "lengths", "codes", "train"), run, f"bucket int, slice long, {CELLS}")


#: Columns of a bucket: its packed cells; how many of them have two customers; the customers of all cells that were sent to it, and which of these each slice has.
BUCKET = f"bucket int, {CELLS}, twos long, every binary, slices array<long>, places array<binary>"


def _added(sent: DataFrame) -> DataFrame:
    """The buckets that the sent cells make; rows of no slice are cells without an asker."""
    schema = _schema(BUCKET)

    def add(table: pa.Table) -> pa.Table:
        slices, parts = table.column("slice").to_pylist(), [Cells.read(r) for r in _rows(table.select(CELL))]
        whole = Cells.added(parts)
        asked = [(slice_, _steps(whole.find(part))) for slice_, part in zip(slices, parts, strict=True) if slice_ is not None]
        return _table([(whole if whole.n.all() else whole.where(whole.n > 0)).row() | {
            "bucket": table.column("bucket")[0].as_py(), "twos": int((whole.n == 2).sum()), "every": _packed(whole.n),
            "slices": [a[0] for a in asked], "places": [a[1] for a in asked]}], schema)

    return sent.groupBy("bucket").applyInArrow(lambda table: next(iter(list(given_back(map(add, [table]))))), BUCKET)


def _light(make: Callable[..., pa.Table]) -> Callable[..., pa.Table]:
    """``make`` for a group, after which memory that the worker no longer uses goes back to the system."""
    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        return next(iter(list(given_back(make(*tables) for tables in [(left, right)]))))

    return run


def _columns(df: DataFrame, make: Callable[[dict], tuple], columns: str) -> DataFrame:
    """Rows of whole numbers that ``make`` gives, as arrays, for each row of ``df``."""
    schema = _schema(columns)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in _rows(batch):
                yield pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(make(row), schema.types, strict=True)], schema=schema)

    return df.mapInArrow(lambda batches: given_back(run(batches)), columns)


class Totals:
    """What all restaurants know of each other: a few numbers."""

    def __init__(self, size: int, tables: float, words: float, discount: float, discount_1: float):
        self.base, self.tables, self.words = 1 / (size + 1), tables, words
        self.discount, self.discount_1 = discount, discount_1

    def parent(self, c1, t1):
        """The parent's probability of words with ``c1`` customers at ``t1`` tables."""
        fresh = (STRENGTH + self.discount_1 * self.words) * self.base
        return (np.maximum(c1 - self.discount_1 * t1, 0) + fresh) / (STRENGTH + self.tables)


#: Columns of a sweep: a row of packed cells for each bucket, and of packed words for each part.
STATE = f"bucket int, {CELLS}, lone binary, t binary, ts binary"
WORDS = ("part int, h binary, c binary, lone binary, alone binary, c1 binary, t1 binary, c1s binary, t1s binary, buckets array<int>, "
         "places array<binary>, size long, customers long, tables long, single long, one long, two long")


def _start(cells: DataFrame) -> DataFrame:
    """The cells of several customers, each at one table."""
    def run(row: dict) -> Iterator[dict]:
        c = Cells.read(row)
        some = c.where(c.n > 1)
        lone = np.bincount(c.x[c.n == 1], minlength=len(c.contexts))[np.isin(c.contexts, some.contexts)]
        yield some.row() | {"bucket": row["bucket"], "lone": _packed(lone), "t": _packed(np.ones(len(some.x), np.int64))}

    return _told(cells, run, STATE)


def _counts(texts: DataFrame, parts: int) -> DataFrame:
    """``part, h, c, total``: the training texts' words with their counts."""
    def own(row: dict) -> Iterator[dict]:
        h, n = _hashes(row["words"]), _unpacked(row["own"])
        order = np.argsort(h)
        order = order[n[order] > 0]
        for part, at in _by_part(h[order], parts):
            yield {"part": part, "h": h[order[at]].tobytes(), "c": _packed(n[order[at]])}

    def add(table: pa.Table) -> pa.Table:
        rows = list(_rows(table))
        h, places = np.unique(np.concatenate([_hashes(r["h"]) for r in rows]), return_inverse=True)
        c = _sums(places, np.concatenate([_unpacked(r["c"]) for r in rows]), len(h))
        return _table([{"part": rows[0]["part"], "h": h.tobytes(), "c": _packed(c), "total": int(c.sum())}], schema)

    columns = "part int, h binary, c binary, total long"
    schema = _schema(columns)
    return _told(texts.select("words", "own"), own, "part int, h binary, c binary").groupBy("part").applyInArrow(add, columns)


def _first_words(counts: DataFrame, cells: DataFrame, parts: int) -> DataFrame:
    """The words of the parts, a table in the parent for each, with the places of the buckets' words of cells of several customers."""
    def known(row: dict) -> Iterator[dict]:
        c = Cells.read(row)
        c1, lone = (np.bincount(c.k[keep], minlength=len(c.words)) for keep in (c.n > 0, c.n == 1))
        alone = np.bincount(c.x[c.n == 1], minlength=len(c.contexts))
        contexts = dict(_by_part(c.contexts, parts))
        for part, at in _by_part(c.words, parts):
            own = contexts.pop(part, slice(0))
            yield {"part": part, "bucket": row["bucket"], "h": c.words[at].tobytes(), "c1": _packed(c1[at]), "lone": _packed(lone[at]),
                   "contexts": c.contexts[own].tobytes(), "alone": _packed(alone[own])}
        for part, own in contexts.items():
            yield {"part": part, "bucket": row["bucket"], "h": b"", "c1": _packed(c1[:0]), "lone": _packed(lone[:0]),
                   "contexts": c.contexts[own].tobytes(), "alone": _packed(alone[own])}

    def add(left: pa.Table, right: pa.Table) -> list[dict]:
        row = next(_rows(left))
        h, c = _hashes(row["h"]), _unpacked(row["c"])
        c1, lone, alone = (np.zeros(len(h), np.int64) for _ in range(3))
        places = {}
        for r in _rows(right):
            at, tables, single = np.searchsorted(h, _hashes(r["h"])), _unpacked(r["c1"]), _unpacked(r["lone"])
            c1[at] += tables
            lone[at] += single
            alone[np.searchsorted(h, _hashes(r["contexts"]))] += _unpacked(r["alone"])
            if (tables > single).any():
                places[r["bucket"]] = _steps(at[tables > single])
        return [{"part": row["part"], "h": row["h"], "c": row["c"], "lone": _packed(lone), "alone": _packed(alone), "c1": _packed(c1),
                 "t1": _packed(np.ones(len(h), np.int64)), "buckets": list(places), "places": list(places.values()), "size": len(h),
                 "customers": int(c1.sum()), "tables": len(h), "single": int(lone.sum()), "one": int((c1 == 1).sum()),
                 "two": int((c1 == 2).sum())}]

    return _met(counts, _told(cells.select("bucket", *CELL), known, "part int, bucket int, h binary, c1 binary, lone binary, "
                              "contexts binary, alone binary"), "part", add, WORDS)


def _dealt_tables(state: DataFrame, spread: np.ndarray) -> np.ndarray:
    """Tables of the dealt contexts at cells of several customers."""
    def own(row: dict) -> Iterator[dict]:
        contexts = _hashes(row["contexts"])
        x = np.repeat(np.arange(len(contexts)), _unpacked(row["per"]))
        at, t, every = _places(spread, contexts), _sums(x, _unpacked(row["t"]), len(contexts)), np.zeros(len(spread), np.int64)
        every[at[at >= 0]] = t[at >= 0]
        for first in range(0, len(spread), DEALT):
            yield {"first": first, "t": _packed(every[first:first + DEALT])}

    def add(table: pa.Table) -> pa.Table:
        rows = list(_rows(table))
        return _table([{"first": rows[0]["first"], "t": _packed(sum(_unpacked(r["t"]) for r in rows))}], _schema("first int, t binary"))

    out = np.zeros(len(spread), np.int64)
    if len(spread):
        told = _told(state.select("contexts", "per", "t"), own, "first int, t binary")
        for r in told.groupBy("first").applyInArrow(add, "first int, t binary").collect():
            out[r["first"]:r["first"] + DEALT] = _unpacked(r["t"])
    return out


def _sweep(state: DataFrame, words: DataFrame, spread: np.ndarray, tables: np.ndarray, total: Totals, seed: int,
           sample: bool) -> DataFrame:
    """The cells of ``state`` seated again, given all the others; ``tables``: of the dealt contexts."""
    def known(row: dict) -> Iterator[dict]:
        c1, t1 = _unpacked(row["c1"]), _unpacked(row["t1"])
        for bucket, places in zip(row["buckets"], row["places"], strict=True):
            at = _ascending(places)
            yield {"bucket": bucket, "part": row["part"], "c1": _packed(c1[at]), "t1": _packed(t1[at])}

    def seated(left: pa.Table, right: pa.Table) -> list[dict]:
        row = next(_rows(left))
        cells, lone, t = Cells.read(row), _unpacked(row["lone"]), _unpacked(row["t"])
        parts = sorted(_rows(right), key=lambda r: r["part"])
        c1, t1 = (np.concatenate([t[:0], *(_unpacked(r[c]) for r in parts)])[cells.k] for c in ("c1", "t1"))
        at = lone + _sums(cells.x, t, len(lone))
        wide = np.isin(cells.contexts, spread)
        at[wide] = tables[np.searchsorted(spread, cells.contexts[wide])]
        h, ctx, others = cells.words[cells.k], cells.contexts[cells.x], (c1 - t).astype(np.float64)
        odds = total.parent(others, np.minimum(t1, others))
        strength = STRENGTH + total.discount * (at[cells.x] - t)
        t = seat(cells.n, strength * odds, total.discount * odds, total.discount,
                 lambda places, i, j: _uniform(h[places, None], ctx[places, None], seed, i, j)).astype(np.int64)
        return [row | {"t": _packed(t), "ts": _joined(row["ts"], t) if sample else row["ts"]}]

    told = _told(words.select("part", "c1", "t1", "buckets", "places"), known, "bucket int, part int, c1 binary, t1 binary")
    return _met(state, told, "bucket", seated, STATE)


def _joined(packed: bytes | None, more: np.ndarray) -> bytes:
    return _packed(np.concatenate((_unpacked(packed), more)) if packed else more)


def _parents(words: DataFrame, state: DataFrame, parts: int, total: Totals, seed: int, sample: bool) -> DataFrame:
    """``words`` with their new customers ``c1`` of the parent, seated at ``t1`` tables."""
    def own(row: dict) -> Iterator[dict]:
        h = _hashes(row["words"])
        t = _sums(_unpacked(row["k"]), _unpacked(row["t"]), len(h))
        for part, at in _by_part(h, parts):
            yield {"part": part, "bucket": row["bucket"], "t": _packed(t[at])}

    def seated(left: pa.Table, right: pa.Table) -> list[dict]:
        row = next(_rows(left))
        h, c1, t1 = _hashes(row["h"]), _unpacked(row["lone"]).copy(), _unpacked(row["t1"])
        places = dict(zip(row["buckets"], row["places"], strict=True))
        for r in _rows(right):
            c1[_ascending(places[r["bucket"]])] += _unpacked(r["t"])
        odds = (STRENGTH + total.discount_1 * (total.words - t1)) * total.base
        t1 = seat(c1, odds, np.full(len(h), total.discount_1 * total.base), total.discount_1,
                  lambda cells, i, j: _uniform(h[cells, None], 1, seed, i, j)).astype(np.int64)
        now = {"c1": c1, "t1": t1}
        return [row | {c: _packed(v) for c, v in now.items()} | {"customers": int(c1.sum()), "tables": int(t1.sum())} | {
            f"{c}s": _joined(row[f"{c}s"], v) for c, v in now.items() if sample}]

    told = _told(state.select("bucket", "words", "k", "t"), own, "part int, bucket int, t binary")
    return _met(words, told, "part", seated, WORDS)


def _vocabulary(words: DataFrame, state: DataFrame, parts: int, samples: int) -> DataFrame:
    """``part, h, c, numbers``; ``numbers``: each sample's ``c1``, each one's ``t1``, each one's tables of the context."""
    def own(row: dict) -> Iterator[dict]:
        c = Cells.read(row)
        t = np.stack([_sums(c.x, ts, len(c.contexts)) for ts in _unpacked(row["ts"]).reshape(samples, -1)])
        for part, at in _by_part(c.contexts, parts):
            yield {"part": part, "contexts": c.contexts[at].tobytes(), "t": _packed(t[:, at].ravel())}

    def add(left: pa.Table, right: pa.Table) -> list[dict]:
        row = next(_rows(left))
        h, tables = _hashes(row["h"]), np.tile(_unpacked(row["alone"]), (samples, 1))
        for r in _rows(right):
            tables[:, np.searchsorted(h, _hashes(r["contexts"]))] += _unpacked(r["t"]).reshape(samples, -1)
        return [{"part": row["part"], "h": row["h"], "c": row["c"], "numbers": _packed(np.concatenate(
            (_unpacked(row["c1s"]), _unpacked(row["t1s"]), tables.ravel())))}]

    told = _told(state.select(*CELL, "ts"), own, "part int, contexts binary, t binary")
    return _met(words.select("part", "h", "c", "alone", "c1s", "t1s"), told, "part", add, "part int, h binary, c binary, numbers binary")


def _discount(one: int, two: int) -> float:
    """From how often something was seen once and twice."""
    return min(0.95, max(0.05, one / (one + 2 * two))) if one else 0.5


class Model:
    """A fitted model, distributed: packed ``buckets`` of cells, the ``seated`` cells of several customers, and packed ``parts``
    of words, which are also the contexts.
    """

    def __init__(self, buckets: DataFrame, seated: DataFrame, parts: DataFrame, totals: list[Totals], n: int, size: int,
                 spread: np.ndarray, number: int, n_parts: int, places: list[str]):
        self.buckets, self.seated, self.parts, self.totals, self.n, self.size = buckets, seated, parts, totals, n, size
        self.spread, self.number, self.n_parts, self.places, self.discount = spread, number, n_parts, places, totals[0].discount
        self.unknown = np.array([float(t.parent(0, 0)) for t in totals])

    def shares(self, c: np.ndarray, numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """By sample: the parent's probability of words, and what they as contexts leave to the parent; unknown words have zeros."""
        c1, t1, tables = numbers.reshape(3, len(self.totals), len(c))
        return (np.stack([t.parent(c1[i], t1[i]) for i, t in enumerate(self.totals)]),
                (STRENGTH + self.discount * tables) / (STRENGTH + c))

    @property
    def vocabulary(self) -> DataFrame:
        """``h, c, parent, weight``; ``parent`` and ``weight`` have a value for each sample."""
        plain, names = _plain(self), ["h", "c", "parent", "weight"]

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for row in _rows(batch):
                    c = _unpacked(row["c"])
                    yield pa.RecordBatch.from_arrays([pa.array(_hashes(row["h"])), pa.array(c), *(
                        pa.array(list(v.T), pa.list_(pa.float64())) for v in plain.shares(c, _unpacked(row["numbers"])))], names)

        return self.parts.mapInArrow(run, "h long, c long, parent array<double>, weight array<double>")

    @property
    def contexts(self) -> DataFrame:
        """``ctx, customers, weight``."""
        return self.vocabulary.select(F.col("h").alias("ctx"), F.col("c").alias("customers"), "weight")

    @property
    def cells(self) -> DataFrame:
        """``h, ctx, n, seats``: ``seats`` is the sum of the cell's tables over the samples."""
        samples, schema = len(self.totals), pa.schema([(c, pa.int64()) for c in ("h", "ctx", "n", "seats")])

        def run(left: pa.Table, right: pa.Table) -> pa.Table:
            c = Cells.read(next(_rows(left)))
            return pa.table([c.words[c.k], c.contexts[c.x], c.n, _seats(c.n, right, samples)], schema=schema)

        return self.buckets.select("bucket", *CELL).groupBy("bucket").cogroup(self.seated.groupBy("bucket")).applyInArrow(
            run, "h long, ctx long, n long, seats long")

    def direct(self) -> Column:
        """What a cell's own customers give it, on average over the samples."""
        return (F.col("n") - self.discount * F.col("seats") / len(self.unknown)) / (STRENGTH + F.col("customers"))

    def mixed(self, parent: Column, weight: Column) -> Column:
        """What the parent gives a cell, on average over the samples."""
        return F.aggregate(F.zip_with(parent, weight, lambda p, w: p * w), F.lit(0.0), lambda a, x: a + x) / len(self.unknown)

    def probabilities(self) -> DataFrame:
        """``h, ctx, c, p`` of all cells."""
        cells = self.cells.join(self.contexts, "ctx").join(self.vocabulary.drop("weight"), "h")
        return cells.select("h", "ctx", "c", (self.direct() + self.mixed(F.col("parent"), F.col("weight"))).alias("p"))

    def _shown(self) -> list:
        return self.contexts.orderBy(F.desc("customers"), "ctx").limit(CONTEXTS).collect()

    @property
    def weights(self) -> np.ndarray:
        """The parent's weight by sample and context, for the ``CONTEXTS`` most frequent contexts."""
        weights = np.zeros((len(self.unknown), CONTEXTS))
        for i, r in enumerate(self._shown()):
            weights[:, i] = r["weight"]
        return weights

    @property
    def words(self) -> DataFrame:
        """``h, c, parent, ctx, direct`` of each word; ``ctx``: numbers of the ``CONTEXTS`` most frequent contexts."""
        number = self.vocabulary.sparkSession.createDataFrame(
            [(r["ctx"], i, r["customers"]) for i, r in enumerate(self._shown())], "ctx long, number int, customers long")
        cells = self.cells.join(F.broadcast(number), "ctx").groupBy("h").agg(
            F.array_sort(F.collect_list(F.struct("number", self.direct().alias("direct")))).alias("x"))
        return self.vocabulary.join(cells, "h", "left").select(
            "h", "c", "parent", F.coalesce("x.number", F.array().cast("array<int>")).alias("ctx"),
            F.coalesce("x.direct", F.array().cast("array<double>")).alias("direct"))


def _plain(model: Model) -> Model:
    """The model's numbers without its tables, for tasks."""
    return Model(None, None, None, model.totals, model.n, model.size, model.spread, model.number, model.n_parts, [])


def _base(c: np.ndarray, n: int, size: int) -> np.ndarray:
    """The base score of tokens with these counts, among ``n`` of ``size`` kinds."""
    return np.log10((c + 0.1) / (n + 0.1 * (size + 1)))


def _seats(n: np.ndarray, seated: pa.Table, samples: int) -> np.ndarray:
    """The tables of a bucket's cells, added up over the samples."""
    seats = np.where(n > 0, samples, 0)
    for r in _rows(seated):
        seats[n > 1] = _unpacked(r["ts"]).reshape(samples, -1).sum(axis=0)
    return seats


def fit(training: DataFrame, text: str = "text") -> Model:
    """Seat the training texts' tokens; see the module's text. A null text counts as empty."""
    texts, place = split(training, F.lit(None).cast("int"), col(text), F.lit(True))
    model = fit_slices(texts)
    discard(training.sparkSession, place)
    return model


def fit_slices(texts: DataFrame) -> Model:
    """:func:`fit`, on the training texts of stored slices; the model's buckets know the cells of all their texts."""
    spark = texts.sparkSession
    sizes = texts.agg(F.sum("size")).first()[0] or 0
    parts = max(4 * spark.sparkContext.defaultParallelism, -(-sizes // PART_WORDS))
    counts, at_counts = _stored(_counts(texts, parts), "lm-counts")
    n = counts.agg(F.sum("total")).first()[0] or 0
    buckets = max(2 * int(spark.conf.get("spark.sql.shuffle.partitions")), -(-n // BUCKET_TOKENS))

    def often(row: dict) -> tuple:
        return (_hashes(row["h"])[_unpacked(row["c"]) * min(HEAVY, 8 * buckets) >= n],)

    spread = np.array(sorted(r["h"] for r in _columns(counts.select("h", "c"), often, "h long").collect()), np.int64)
    cells, at_cells = _stored(_added(_sent(texts, spread, buckets)), "lm-cells")
    words, at_words = _stored(_first_words(counts, cells, parts), "lm-words")
    discard(spark, at_counts)
    found = words.agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("size", "customers", "single", "one", "two")]).first()
    discounts = _discount(found["single"], cells.agg(F.sum("twos")).first()[0] or 0), _discount(found["one"], found["two"])

    def left_alone(row: dict) -> tuple:
        h = _hashes(row["h"])
        wide = np.isin(h, spread)
        return h[wide], _unpacked(row["alone"])[wide]

    alone = {r["h"]: r["alone"] for r in _columns(words.select("h", "alone"), left_alone, "h long, alone long").collect()}
    alone = np.array([alone[h] for h in spread.tolist()], np.int64)

    size = found["size"]
    total, totals = Totals(size, float(found["customers"]), float(size), *discounts), []
    state, at_state = _stored(_start(cells.select("bucket", *CELL)), "lm-sweep")
    for sweep in range(ROUNDS * SWEEPS):
        sample = sweep >= BURN_IN * SWEEPS and sweep % SWEEPS == SWEEPS - 1
        tables = alone + _dealt_tables(state, spread)
        before = at_state, at_words
        state, at_state = _stored(_sweep(state, words, spread, tables, total, sweep, sample), "lm-sweep")
        words, at_words = _stored(_parents(words, state, parts, total, sweep, sample), "lm-words")
        for place in before:  # no table reads the sweep before any more
            discard(spark, place)
        now = words.agg(F.sum("customers").alias("customers"), F.sum("tables").alias("tables")).first()
        total = Totals(size, float(now["customers"] or 0), float(now["tables"] or 0), *discounts)
        totals += [total] * sample
    vocabulary, at_vocabulary = _stored(_vocabulary(words, state, parts, len(totals)), "lm-vocabulary")
    seated, at_seated = _stored(state.select("bucket", "ts"), "lm-seated")
    for place in (at_words, at_state):
        discard(spark, place)
    return Model(cells, seated, vocabulary, totals, n, size, spread, buckets, parts, [at_cells, at_seated, at_vocabulary])


def score(docs: DataFrame, model: Model, id: str = "doc_id", text: str = "text") -> DataFrame:
    """``id, n_tokens, n_known, base_score, score`` for each row of ``docs``."""
    texts, _ = split(docs, col(id), col(text), F.lit(False))
    asked = _sent(texts, model.spread, model.number).unionByName(model.buckets.select("bucket", *CELL), allowMissingColumns=True)
    buckets, place = _stored(_added(asked), "lm-asked")
    found, _ = _stored(_answers(buckets, model), "lm-found")
    discard(docs.sparkSession, place)
    return score_slices(texts, found, model, id)


def _answers(buckets: DataFrame, model: Model) -> DataFrame:
    """``slice, bucket, n, seats`` of the cells of all slices that the buckets know."""
    samples = len(model.unknown)

    def answer(left: pa.Table, right: pa.Table) -> list[dict]:
        row = next(_rows(left))
        n = _unpacked(row["every"])
        seats = _seats(n, right, samples)
        rows = []
        for slice_, places in zip(row["slices"], row["places"], strict=True):
            at = _ascending(places)
            rows.append({"slice": slice_, "bucket": row["bucket"], "n": _packed(n[at]), "seats": _packed(seats[at])})
        return rows

    return _met(buckets.select("bucket", "every", "slices", "places"), model.seated, "bucket", answer,
                "slice long, bucket int, n binary, seats binary")


def score_slices(texts: DataFrame, found: DataFrame, model: Model, id: str) -> DataFrame:
    """:func:`score`, for stored slices and the answers to their cells."""
    plain, samples = _plain(model), len(model.unknown)

    def wanted(row: dict) -> Iterator[dict]:
        h = np.sort(_hashes(row["words"]))
        for part, at in _by_part(h, plain.n_parts):
            yield {"part": part, "slice": row["slice"], "h": h[at].tobytes()}

    def tell(left: pa.Table, right: pa.Table) -> list[dict]:
        known = next(_rows(right)) if right.num_rows else {"h": b"", "c": _packed(np.zeros(0)), "numbers": _packed(np.zeros(0))}
        h = _hashes(known["h"])
        numbers = np.zeros((1 + 3 * samples, len(h) + 1), np.int64)  # the last: of words that no part knows
        numbers[0, :-1], numbers[1:, :-1] = _unpacked(known["c"]), _unpacked(known["numbers"]).reshape(3 * samples, -1)
        return [{"slice": r["slice"], "part": r["part"], "numbers": _packed(numbers[:, _places(h, _hashes(r["h"]))].ravel())}
                for r in _rows(left)]

    words = _met(_told(texts.select("slice", "words"), wanted, "part int, slice long, h binary"), model.parts, "part", tell,
                 "slice long, part int, numbers binary")
    replies = found.unionByName(words, allowMissingColumns=True).groupBy("slice")
    kind = texts.schema["ids"].dataType.elementType.simpleString()
    names = ["id", "n_tokens", "n_known", "base_score", "score"]

    def add(left: pa.Table, right: pa.Table) -> pa.Table:
        s = Slice(next(_rows(left.drop_columns(["ids"]))))
        told = sorted(_rows(right.filter(pc.is_valid(right.column("part"))).select(["part", "numbers"])), key=lambda r: r["part"])
        numbers = np.concatenate([_unpacked(r["numbers"]).reshape(1 + 3 * samples, -1) for r in told], axis=1)
        c, (parents, weights) = numbers[0], plain.shares(numbers[0], numbers[1:])
        text, size, cell = np.repeat(np.arange(len(s.n_tokens)), s.n_tokens), len(s.n_tokens), s.cells()
        s.token = s.context = None  # at most a few arrays of all tokens at a time
        order = np.argsort(cell)
        text, cell = text[order], cell[order]
        first = np.diff(cell, prepend=-1) > 0
        cell, places, order = cell[first], np.cumsum(first) - 1, None
        n, seats = np.zeros(len(cell), np.int64), np.zeros(len(cell), np.int64)
        x, k = np.divmod(cell, len(s.words))
        dealt = dict(s.dealt(cell, plain.spread, plain.number))
        for r in _rows(right.filter(pc.is_valid(right.column("n"))).select(["bucket", "n", "seats"])):
            n[dealt[r["bucket"]]], seats[dealt[r["bucket"]]] = _unpacked(r["n"]), _unpacked(r["seats"])
        p = (n - plain.discount * seats / samples) / (STRENGTH + c[x])
        for parent, weight in zip(parents, weights, strict=True):
            p += parent[k] * weight[x] / samples
        ids = pc.list_flatten(left.column("ids").combine_chunks())
        sums = (np.bincount(text, v[places], size) for v in (c[k] > 0, _base(c, plain.n, plain.size)[k], np.log10(p)))
        return pa.table([ids, pa.array(s.n_tokens), pa.array(next(sums).astype(np.int64)), *map(pa.array, sums)], names)

    out = texts.select("slice", "ids", "words", "lengths", "codes", "train").groupBy("slice").cogroup(replies).applyInArrow(
        _light(add), f"id {kind}, n_tokens long, n_known long, base_score double, score double")
    return out.withColumnRenamed("id", id)


def held_out(id: Column) -> Column:
    """One document in ten, by its id alone; a null id is held out."""
    return F.coalesce(F.crc32(id.cast("string")) % 10 == 0, F.lit(True))


def corpus_scores(docs: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """Fit on the documents that aren't held out, score all: one row for each row of ``docs``.

    Null and empty texts have the end as their one token. Repeated rows are tokens of their own
    and get equal scores; an empty table gives no rows. Scores are log10 probabilities.
    """
    with freed_shuffles(docs.sparkSession):
        texts, at_texts = split(docs, col(id), col(text), ~held_out(col(id)))
        model = fit_slices(texts)
        found, at_found = _stored(_answers(model.buckets, model), "lm-found")
        at_cells, at_seated, at_vocabulary = model.places
        for place in (at_cells, at_seated):  # the slices have what they need of them
            discard(docs.sparkSession, place)
        out, _ = _stored(score_slices(texts, found, model, "id"), "lm-scores")
        for place in (at_texts, at_found, at_vocabulary):
            discard(docs.sparkSession, place)
    return out.select(F.col("id").alias(id), held_out(F.col("id")).alias("held_out"), "n_tokens", "n_known",
                      F.lit(model.n).cast("long").alias("train_tokens"), "base_score", "score")


def op7_pitman_yor_scores(spark, sf_dir: str) -> DataFrame:
    return corpus_scores(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text"))
