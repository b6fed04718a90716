"""Near-duplicate vectors by binary codes of randomly rotated vectors.

1. Equal vectors are one class from here on (known by a 128-bit hash of their values).
2. A class's direction is turned by a few random rotations. The signs of the turned components are its
   code; a correction factor, stored with it for each rotation, is the code's inner product with the direction it stands for.
3. Bands of code bits are buckets: two vectors of the least similarity agree in one bit with a known chance, so
   the number of bands follows from the recall asked for, and the bits of a band from the number of vectors.
4. In a bucket, a code times the other vector's turned components, rounded at random to four bits, over
   the factor, is an unbiased estimate of the inner product: a few AND and population counts. Only if
   its upper confidence bound reaches the similarity is the cosine worked out in double precision,
   by the first bucket that the two share. Nothing is linked by an estimate alone.
5. A bucket of more than ``BLOCK`` classes is dealt into blocks, and every two blocks meet in a task of their own.
   Tasks return sums by vector and a forest of links: rows grow with the members, not with their pairs.
6. Components of the forests' links, and sums of the links.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemill.llm.neardup import components
from tidemill.llm.words import col, ship
from tidemill.session import stage

#: Share of the pairs at the least similarity that some band must bring together, vectors that share a bucket by
#: chance, and standard deviations of the confidence bound (one estimate in 30,000 is further off).
RECALL, BY_CHANCE, SIGMAS = 0.999, 8, 4.0
#: Classes of a block; pairs looked at together; numbers of vectors multiplied together.
BLOCK, PAIRS, NUMBERS = 4096, 1 << 17, 1 << 21
#: Bits of a rounded component.
PLANES = 4


def bands_for(n: int, similarity: float, recall: float = RECALL) -> tuple[int, int]:
    """Bands, and bits of each, for ``n`` vectors.

    >>> bands_for(500, 0.95), bands_for(10**9, 0.95)
    ((13, 8), (120, 27))
    """
    bits = max(8, math.ceil(math.log2(max(n, 1) / BY_CHANCE)))
    agree = 1 - math.acos(similarity) / math.pi
    return math.ceil(math.log(1 - recall) / math.log1p(-agree ** bits)), bits


@lru_cache(maxsize=64)
def _rotation(dim: int, number: int) -> tuple[np.ndarray, np.ndarray]:
    """A random rotation and the thresholds of its random rounding, the same wherever they are made."""
    rng = np.random.default_rng([dim, number])
    q, r = np.linalg.qr(rng.standard_normal((dim, dim)))
    return q * np.where(np.diag(r) < 0, -1, 1), rng.random(dim)


def _packed(bits: np.ndarray) -> np.ndarray:
    """Rows of bits as rows of 64-bit words."""
    n, width = bits.shape
    padded = np.zeros((n, -(-width // 64) * 64), dtype=bool)
    padded[:, :width] = bits
    return np.packbits(padded, axis=1, bitorder="little").view("<u8")


class Codes:
    """Codes of vectors of equal length (rows of doubles that aren't zero)."""

    def __init__(self, vectors: np.ndarray, bands: int, bits: int):
        n, self.dim = vectors.shape
        _, power = np.frexp(np.abs(vectors).max(axis=1))
        self.vectors = np.ldexp(vectors, -power[:, None])  # a power of two: no rounding, no overflow
        self.norms = np.sqrt(np.einsum("ij,ij->i", self.vectors, self.vectors))
        self.unit = self.vectors / self.norms[:, None]
        self.rotations = -(-bands * bits // self.dim)
        self.bands, self.bits = bands, bits

    def signs(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Code words, correction factors and buckets (a column for each band)."""
        words, factors, signs = [], [], []
        for i in range(self.rotations):
            turned = self.unit @ _rotation(self.dim, i)[0]
            signs.append(turned > 0)
            words.append(_packed(signs[-1]))
            factors.append(np.abs(turned).sum(axis=1) / math.sqrt(self.dim))
        flat = np.concatenate(signs, axis=1)[:, :self.bands * self.bits].reshape(-1, self.bands, self.bits)
        return np.concatenate(words, axis=1), np.stack(factors, axis=1), flat @ (1 << np.arange(self.bits, dtype=np.int64))

    def rounded(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Bit planes (rows, planes, words) of the turned components, and by rotation: least, step, sum."""
        planes, least, step, total = [], [], [], []
        for i in range(self.rotations):
            rotation, threshold = _rotation(self.dim, i)
            turned = self.unit @ rotation
            low = turned.min(axis=1)
            width = np.maximum(turned.max(axis=1) - low, 1e-300) / ((1 << PLANES) - 1)
            whole = np.floor((turned - low[:, None]) / width[:, None] + threshold).astype(np.int64)
            planes.append(np.stack([_packed((whole >> k & 1).astype(bool)) for k in range(PLANES)], axis=1))
            least.append(low)
            step.append(width)
            total.append(whole.sum(axis=1))
        return np.concatenate(planes, axis=2), *(np.stack(x, axis=1) for x in (least, step, total))


class Bucketed:
    """Classes of equal length, sorted by the task they meet in."""

    def __init__(self, vectors: np.ndarray, words: np.ndarray, factors: np.ndarray, bands: int, bits: int):
        self.codes = Codes(vectors, bands, bits)
        self.words, self.factors = words, factors
        self.ones = np.bitwise_count(words).reshape(len(words), factors.shape[1], -1).sum(axis=2, dtype=np.int64)
        self.planes, self.least, self.step, self.total = self.codes.rounded()
        self.buckets = self._buckets()

    def _buckets(self) -> np.ndarray:
        c = self.codes
        bits = np.unpackbits(self.words.view(np.uint8).reshape(len(self.words), -1), axis=1, bitorder="little")
        bits = bits.reshape(len(bits), c.rotations, -1)[:, :, :c.dim].reshape(len(bits), -1)[:, :c.bands * c.bits]
        return bits.reshape(-1, c.bands, c.bits).astype(np.int64) @ (1 << np.arange(c.bits, dtype=np.int64))

    def may_reach(self, a: np.ndarray, b: np.ndarray, similarity: float) -> np.ndarray:
        """Whether the upper bound of the estimate, from ``a``'s codes and ``b``'s rounded components, reaches the similarity."""
        dim, rotations = self.codes.dim, self.codes.rotations
        each = self.words.shape[1] // rotations
        estimate, variance = np.zeros(len(a)), np.zeros(len(a))
        for i in range(rotations):
            inner = np.zeros(len(a), dtype=np.int64)
            for w in range(i * each, (i + 1) * each):
                code = self.words[a, w]
                for k in range(PLANES):
                    inner += np.bitwise_count(code & self.planes[b, k, w]).astype(np.int64) << k
            step, low, f = self.step[b, i], self.least[b, i], self.factors[a, i]
            product = (step * (2 * inner - self.total[b, i]) + low * (2 * self.ones[a, i] - dim)) / math.sqrt(dim)
            estimate += product / f
            variance += (np.maximum(1 - f * f, 0) / max(dim - 1, 1) + step * step / 4) / (f * f)
        return (estimate + SIGMAS * np.sqrt(variance)) / rotations >= similarity - 1e-9

    def linked(self, a: np.ndarray, b: np.ndarray, band: np.ndarray, similarity: float) -> np.ndarray:
        """Which of these pairs are links that no earlier band has."""
        near = np.flatnonzero(self.may_reach(a, b, similarity))
        out, c = np.zeros(len(a), dtype=bool), self.codes
        earlier = np.arange(c.bands)
        for i in range(0, len(near), max(1, NUMBERS // max(c.dim, c.bands))):
            own = near[i:i + max(1, NUMBERS // max(c.dim, c.bands))]
            x, y = a[own], b[own]
            new = ~((self.buckets[x] == self.buckets[y]) & (earlier < band[own, None])).any(axis=1)
            own, x, y = own[new], x[new], y[new]
            cosine = np.einsum("ij,ij->i", c.vectors[x], c.vectors[y]) / (c.norms[x] * c.norms[y])
            out[own] = cosine >= similarity
        return out


def _pairs(group: np.ndarray, side: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs of rows of equal ``group`` (sorted), some at a time; in a group of two sides, of different sides."""
    n = len(group)
    if not n:
        return
    first = np.flatnonzero(np.concatenate(([True], group[1:] != group[:-1])))
    size = np.diff(np.append(first, n))
    two = np.repeat(np.minimum.reduceat(side, first) != np.maximum.reduceat(side, first), size)
    end = np.repeat(first + size, size)
    rows, k, left, right, held = np.arange(n), 1, [], [], 0
    while len(rows):
        rows = rows[rows + k < end[rows]]
        own = rows[~two[rows] | (side[rows] != side[rows + k])]
        left.append(own)
        right.append(own + k)
        held += len(own)
        k += 1
        if held >= PAIRS or not len(rows):
            yield np.concatenate(left), np.concatenate(right)
            left, right, held = [], [], 0


def _forest(root: np.ndarray, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of the links ``a, b`` those that join parts, one for each joining; ``root`` has each row's part and follows."""
    keep_a, keep_b = [], []
    while len(a):
        low, high = np.minimum(root[a], root[b]), np.maximum(root[a], root[b])
        apart = low != high
        a, b, low, high = a[apart], b[apart], low[apart], high[apart]
        hooked, at = np.unique(high, return_index=True)
        keep_a.append(a[at])
        keep_b.append(b[at])
        to = np.arange(len(root))
        to[hooked] = low[at]
        while (to[to] != to).any():
            to = to[to]
        root[:] = to[root]
    return (np.concatenate(keep_a), np.concatenate(keep_b)) if keep_a else (a, b)


def _meet(rows: pa.Table, bands: int, bits: int, similarity: float) -> Iterator[pa.RecordBatch]:
    """Links of the tasks in ``rows`` (whole tasks, sorted): sums by node, and forests."""
    task = [rows.column(c).to_numpy() for c in ("dim", "band", "bucket", "low", "high")]
    new = np.ones(rows.num_rows, dtype=bool)
    new[1:] = np.any([t[1:] != t[:-1] for t in task], axis=0)
    group, (dim, band) = np.cumsum(new), task[:2]
    node, n, side = (rows.column(c).to_numpy() for c in ("node", "n", "block"))
    for d in np.unique(dim):
        own = np.flatnonzero(dim == d)
        part = rows.take(pa.array(own)).combine_chunks()
        vectors = part.column("vector").combine_chunks().flatten().to_numpy().astype(np.float64).reshape(-1, d)
        words = np.frombuffer(b"".join(part.column("words").to_pylist()), "<u8").reshape(len(own), -1)
        factors = np.frombuffer(b"".join(part.column("factors").to_pylist()), "<f8").reshape(len(own), -1)
        table = Bucketed(vectors, words, factors, bands, bits)
        root, links = np.arange(len(own)), np.zeros(len(own), dtype=np.int64)
        for a, b in _pairs(group[own], side[own]):
            found = table.linked(a, b, band[own][a], similarity)
            a, b = a[found], b[found]
            np.add.at(links, a, n[own][b])
            np.add.at(links, b, n[own][a])
            x, y = _forest(root, a, b)
            if len(x):
                yield pa.RecordBatch.from_arrays([pa.array(node[own][x]), pa.array(node[own][y]),
                                                  pa.array(np.zeros(len(x), np.int64))], ["node", "other", "links"])
        some = np.flatnonzero(links)
        if len(some):
            yield pa.RecordBatch.from_arrays([pa.array(node[own][some]), pa.nulls(len(some), pa.int64()),
                                              pa.array(links[some])], ["node", "other", "links"])


def _coded(rows: DataFrame, bands: int, bits: int) -> DataFrame:
    """Add ``c``: fingerprint, code words, factors and buckets of ``vector``, or null where it is null."""
    @F.arrow_udf("fingerprint binary, words binary, factors binary, buckets array<long>")
    def coded(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            m = len(batch)
            prints, words, factors, buckets = [None] * m, [None] * m, [None] * m, [None] * m
            size = np.array([len(x) if x.is_valid else 0 for x in batch])
            for d in np.unique(size[size > 0]):
                at = np.flatnonzero(size == d)
                vectors = batch.take(pa.array(at)).flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, d)
                vectors = vectors + 0.0  # no negative zeros
                step = max(1, NUMBERS // d)
                for i in range(0, len(at), step):
                    w, f, b = Codes(vectors[i:i + step], bands, bits).signs()
                    for j, k in enumerate(at[i:i + step].tolist()):
                        prints[k] = xxhash.xxh3_128_digest(vectors[i + j].tobytes())
                        words[k], factors[k], buckets[k] = w[j].tobytes(), f[j].tobytes(), b[j]
            yield pa.StructArray.from_arrays(
                [pa.array(prints, pa.binary()), pa.array(words, pa.binary()), pa.array(factors, pa.binary()),
                 pa.array(buckets, pa.list_(pa.int64()))], ["fingerprint", "words", "factors", "buckets"])

    return rows.withColumn("c", coded(F.col("vector")))


def near_vectors(vectors: DataFrame, id: str = "vec_id", vector: str = "embedding", similarity: float = 0.95,
                 recall: float = RECALL, block: int = BLOCK) -> DataFrame:
    """``id, n_links, component_id, kept`` for each row: other rows of at least this cosine, and the smallest id reachable.

    A vector that is null, empty, zero, or has a null or non-finite component has no links; vectors of
    different lengths aren't linked. Every row is a vector: repeated rows are linked with
    each other. A null id comes after all others, so a component has a null ``component_id`` only
    if it has no other id. An empty table gives no rows. Every link is confirmed by its cosine in double
    precision; ``recall`` is the share of links at just that similarity that is found on average, and
    nearer pairs are found more surely. ``similarity`` must be over 0.
    """
    spark = vectors.sparkSession
    ship(spark)
    kind = vectors.select(col(vector)).schema[0].dataType.simpleString()
    values = col(vector) if kind in ("array<float>", "array<double>") else col(vector).cast("array<double>")
    bad = F.exists("vector", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    right = ~bad & F.exists("vector", lambda x: x != 0)
    rows = vectors.select(col(id).alias("id"), values.alias("vector"))
    rows = rows.withColumn("vector", F.when(right, F.col("vector")))
    bands, bits = bands_for(vectors.count(), similarity, recall)
    rows = stage(_coded(rows, bands, bits).select("id", "vector", "c.*"), "codes-rows")

    one = F.struct(F.col("id").isNull().alias("no_id"), "id")
    classes = stage(rows.where("fingerprint is not null").groupBy("fingerprint").agg(
        F.min(one).alias("one"), F.count(F.lit(1)).alias("n"),
        *[F.first(c).alias(c) for c in ("vector", "words", "factors", "buckets")])
        .withColumn("node", F.monotonically_increasing_id()), "codes-classes")

    bucket = ["dim", "band", "bucket"]
    held = classes.select("node", F.size("vector").alias("dim"), F.posexplode("buckets").alias("band", "bucket"))
    sizes = held.groupBy(bucket).agg(F.count(F.lit(1)).alias("size")).where("size > 1")
    blocks = F.ceil(F.col("size") / block).cast("int")
    met = held.join(sizes, bucket).withColumn("blocks", blocks).withColumn(
        "block", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
    met = met.select("node", *bucket, "block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other"))
    met = met.select("node", *bucket, "block", F.least("block", "other").alias("low"), F.greatest("block", "other").alias("high"))
    task = [*bucket, "low", "high"]
    met = met.join(classes.select("node", "n", "vector", "words", "factors"), "node")

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept = None
        for batch in batches:
            rows = pa.Table.from_batches([batch])
            rows = pa.concat_tables([kept, rows]) if kept is not None else rows
            last = np.ones(rows.num_rows, dtype=bool)  # the rows of the last task, which may go on
            for c in task:
                values = rows.column(c).to_numpy()
                last &= values == values[-1]
            begin = rows.num_rows - int(last.sum())
            if begin:
                yield from _meet(rows.slice(0, begin), bands, bits, similarity)
            kept = rows.slice(begin)
        if kept is not None:
            yield from _meet(kept, bands, bits, similarity)

    found = stage(met.repartition(*task).sortWithinPartitions(*task).mapInArrow(
        meet, "node long, other long, links long"), "codes-links")
    links = found.where("other is null").groupBy("node").agg(F.sum("links").alias("links"))
    parts = components(found.where("other is not null").select("node", F.col("other")), "node", "other")
    joined = classes.select("node", "fingerprint", "one", "n").join(parts, "node", "left").join(links, "node", "left").select(
        "fingerprint", "one", F.coalesce("component", "node").alias("component"),
        (F.coalesce("links", F.lit(0)) + F.col("n") - 1).alias("n_links"))
    joined = stage(joined, "codes-parts")
    least = joined.groupBy("component").agg(F.min("one").alias("least"))
    result = joined.join(least, "component").select("fingerprint", "n_links", "least")
    out = rows.select("id", "fingerprint").join(result, "fingerprint", "left").withColumn("least", F.coalesce("least", one))
    return out.select(F.col("id").alias(id), F.coalesce("n_links", F.lit(0)).alias("n_links"),
                      F.col("least.id").alias("component_id"), F.col("id").eqNullSafe(F.col("least.id")).alias("kept"))


def op12_rotation_codes(spark, sf_dir: str) -> DataFrame:
    return near_vectors(spark.read.parquet(f"{sf_dir}/embeddings.parquet").select("vec_id", "embedding"))


#: All pairs, and reachability.
OP12_SQL = """
WITH RECURSIVE v AS MATERIALIZED (
  SELECT vec_id, embedding::DOUBLE[] AS e FROM embeddings
  WHERE len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
l AS MATERIALIZED (
  SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.vec_id <> b.vec_id AND len(a.e) = len(b.e)
  WHERE list_cosine_similarity(a.e, b.e) >= 0.95),
r(vec_id, other) AS (SELECT vec_id, vec_id FROM embeddings UNION SELECT r.vec_id, l.b FROM r JOIN l ON r.other = l.a),
c AS (SELECT vec_id, min(other) AS component_id FROM r GROUP BY vec_id),
n AS (SELECT a AS vec_id, count(*) AS n FROM l GROUP BY a)
SELECT vec_id, coalesce(n, 0) AS n_links, component_id, vec_id = component_id AS kept FROM c LEFT JOIN n USING (vec_id)
"""
