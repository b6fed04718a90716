"""The prefix trie of conversations from padded matrices of turn ids.

``sequences`` orders each conversation's turns and gives every turn an id: 128 bits of the hash of
its role and text. ``prefix_trie`` returns one row for each distinct sequence of first turns:

1. Conversations are range-partitioned by their ids (then conv_id) and sorted, so a run of equal
   conversations may fill many partitions. Each partition is worked through in blocks of
   ``BLOCK`` turns.
2. In a block, turn ids become small numbers in a matrix, padded with zeros, a row for each
   conversation. It is made ``WIDTH`` columns at a time, of the rows that reach so far only: one
   long conversation pads no others. ``numpy.lexsort`` orders the rows.
3. Where a column differs from the row above, and in all columns after it (OR-accumulated), a row
   starts new nodes. ``reduceat`` between the starts sums up every depth.
4. Only nodes of a block's first or last conversation can go on in the next block. All figures are sums over
   conversations once starts and leaves are counted right, so a block takes its first conversation for all new and its
   last for a leaf; two blocks' touching conversations then tell what was counted twice, and pieces
   and corrections of a node are added up by a hash of its turns.

Member lists are hashed block by block; those of nodes that fill several blocks go through one
running hash, a thousand ids at a time. A conversation is one value: 48 bytes for each of its turns.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemill.llm.words import col, ship
from tidemill.session import stage

#: Turns and conversations that a block may hold (a longer conversation is a block of its own), columns of a
#: matrix, and member ids that go to the running hash at once.
BLOCK, WIDTH, CHUNK = 500_000, 16, 1_000

EMPTY = hashlib.sha256(b"").hexdigest()

_PIECE = ("kind string, block long, side int, depth long, key binary, parent_key binary, conv_id long,"
          " parent_conv_id long, parent_side int, n_convs long, n_children long, n_leaves long, saved_tokens long,"
          " ends string, last_turn binary, ids binary, sizes array<long>")
_FIELDS = pa.schema([("kind", pa.string()), ("block", pa.int64()), ("side", pa.int32()), ("depth", pa.int64()),
                     ("key", pa.binary()), ("parent_key", pa.binary()), ("conv_id", pa.int64()),
                     ("parent_conv_id", pa.int64()), ("parent_side", pa.int32()), ("n_convs", pa.int64()),
                     ("n_children", pa.int64()), ("n_leaves", pa.int64()), ("saved_tokens", pa.int64()),
                     ("ends", pa.string()), ("last_turn", pa.binary()), ("ids", pa.binary()),
                     ("sizes", pa.list_(pa.int64()))])


def _panel(codes: np.ndarray, at: np.ndarray, rows: np.ndarray, start: int) -> np.ndarray:
    """The columns from ``start`` on of these rows' padded matrix."""
    place = at[rows][:, None] + start + np.arange(WIDTH)
    inside = place < at[rows + 1][:, None]
    return np.where(inside, codes[np.minimum(place, len(codes) - 1)] if len(codes) else 0, 0)


def ordered(codes: np.ndarray, at: np.ndarray, ids: np.ndarray) -> np.ndarray:
    """Row numbers in the order of their sequences, shorter ones first, equal ones by ``ids``."""
    order = np.argsort(ids, kind="stable")
    group = np.zeros(len(ids), dtype=np.int64)
    n, place, start = np.diff(at), np.arange(len(ids)), 0
    while len(place):
        rows = order[place]
        panel = _panel(codes, at, rows, start)
        by = np.lexsort((*panel.T[::-1], group[place]))
        order[place], panel, old = rows[by], panel[by], group[place]
        new = np.ones(len(place), dtype=bool)
        new[1:] = (old[1:] != old[:-1]) | (panel[1:] != panel[:-1]).any(axis=1)
        first = np.flatnonzero(new)
        size = np.diff(np.append(first, len(place)))
        group[place] = np.repeat(place[first], size)
        start += WIDTH
        place = place[np.repeat(size > 1, size) & (panel[:, -1] > 0)]
    return order


def shared_depth(codes: np.ndarray, at: np.ndarray, order: np.ndarray) -> np.ndarray:
    """For each row in order: first turns in common with the row above (-1 for the first row).

    A row starts a node at every greater depth that it has.
    """
    n = np.diff(at)[order]
    same = np.zeros(len(order), dtype=np.int64)
    changed = np.zeros(len(order), dtype=bool)
    changed[:1] = True
    start, place = 0, np.flatnonzero(n > 0)
    while len(place):
        panel = _panel(codes, at, order[place], start)
        above = np.zeros_like(panel)
        follows = np.flatnonzero(np.diff(place) == 1) + 1  # a row above that ends earlier is all padding here
        above[follows] = panel[follows - 1]
        change = panel != above
        change[:, 0] |= changed[place]
        change = np.logical_or.accumulate(change, axis=1)
        changed[place] = change[:, -1]
        same[place] += WIDTH - change.sum(axis=1)
        start += WIDTH
        place = place[n[place] > start]
    same = np.minimum(same, n)
    same[:1] = -1
    return same


def _keys(ids: bytes, depth: int) -> list[bytes]:
    """A hash of the first 0, 1, ... ``depth`` turns."""
    h = hashlib.sha256()
    keys = [h.digest()]
    for d in range(depth):
        h.update(ids[16 * d:16 * d + 16])
        keys.append(h.digest())
    return keys


def _batch(n: int, **columns) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(columns[f.name], f.type) if f.name in columns else pa.nulls(n, f.type) for f in _FIELDS], schema=_FIELDS)


def block_nodes(number: int, conv: np.ndarray, ids: list[bytes], sizes: np.ndarray) -> Iterator[pa.RecordBatch]:
    """Nodes, pieces of nodes and the first and last conversation of a block; ``sizes``: bytes of all turns."""
    n = np.fromiter(map(len, ids), np.int64, len(ids)) // 16
    at = np.concatenate(([0], np.cumsum(n)))
    whole = np.frombuffer(b"".join(ids), ">u8").astype(np.uint64).reshape(-1, 2)
    by = np.lexsort((whole[:, 1], whole[:, 0]))
    new = np.ones(len(by), dtype=bool)
    new[1:] = (whole[by][1:] != whole[by][:-1]).any(axis=1)
    codes = np.zeros(len(by), dtype=np.int32)
    codes[by] = np.cumsum(new)

    order = ordered(codes, at, conv)
    same = shared_depth(codes, at, order)
    conv, n, at = conv[order], n[order], at[:-1][order]
    total = np.concatenate(([0], np.cumsum(sizes)))
    leaf = np.ones(len(order), dtype=bool)
    leaf[:-1] = same[1:] < n[:-1]
    first, last = ids[order[0]], ids[order[-1]]
    paths = _keys(first, int(n[0])), _keys(last, int(n[-1]))

    for row, name in ((0, "head"), (len(order) - 1, "tail")):
        own = ids[order[row]]
        yield _batch(1, kind=[name], block=[number], ids=[own], sizes=[sizes[at[row]:at[row] + n[row]].tolist()])

    rows, depth = np.arange(len(order)), 0
    least, side, node_of = None, None, np.zeros(len(order), dtype=np.int64)
    while len(rows):
        begins = same[rows] < depth
        s = np.flatnonzero(begins)
        m = len(s)
        low = np.minimum.reduceat(conv[rows], s)
        figures = {
            "n_convs": np.diff(np.append(s, len(rows))),
            "n_children": np.add.reduceat((same[rows] <= depth) & (n[rows] > depth), s, dtype=np.int64),
            "n_leaves": np.add.reduceat(leaf[rows], s, dtype=np.int64),
            "saved_tokens": np.add.reduceat(np.where(same[rows] >= depth, total[at[rows] + np.maximum(same[rows], 0)]
                                                     - total[at[rows] + max(depth - 1, 0)], 0), s)}
        ending = np.add.reduceat(n[rows] == depth, s, dtype=np.int64)
        sides = np.full(m, -1)
        if rows[-1] == len(order) - 1:
            sides[-1] = 1
        if rows[0] == 0:
            sides[0] = 0
        parent = node_of[rows[s]]
        up = least[parent] if depth else np.zeros(m, dtype=np.int64)
        up_side = side[parent] if depth else np.full(m, -1)
        turn = [ids[i][16 * depth - 16:16 * depth] if depth else None for i in order[rows[s]].tolist()]
        closed = np.flatnonzero(sides < 0)
        ends = []
        for i in closed.tolist():
            own = conv[rows[s[i]:s[i] + ending[i]]].tolist()
            ends.append(hashlib.sha256(",".join(map(str, own)).encode()).hexdigest() if own else EMPTY)
        k = len(closed)
        if k:
            yield _batch(k, kind=["node"] * k, block=np.full(k, number), depth=np.full(k, depth), conv_id=low[closed],
                         parent_conv_id=pa.array(up[closed], mask=up_side[closed] >= 0),
                         parent_side=pa.array(up_side[closed].astype(np.int32), mask=up_side[closed] < 0), ends=ends,
                         last_turn=[turn[i] for i in closed.tolist()], **{c: v[closed] for c, v in figures.items()})
        for i in np.flatnonzero(sides >= 0).tolist():
            path = paths[sides[i]]
            names = {"block": [number], "depth": [depth], "key": [path[depth]]}
            yield _batch(1, kind=["piece"], side=[int(sides[i])], parent_key=[path[depth - 1] if depth else None],
                         conv_id=[low[i]], last_turn=[turn[i]], **names, **{c: [v[i]] for c, v in figures.items()})
            own = conv[rows[s[i]:s[i] + ending[i]]].tolist()
            for j in range(0, len(own), CHUNK):
                part = own[j:j + CHUNK]
                yield _batch(1, kind=["ends"], conv_id=[part[0]], ends=[",".join(map(str, part))], **names)
        node_of[rows] = np.cumsum(begins) - 1
        least, side, depth = low, sides, depth + 1
        rows = rows[n[rows] >= depth]


def _blocks(batches: Iterator[pa.RecordBatch], most: int) -> Iterator[pa.RecordBatch]:
    """The nodes of a sorted partition's blocks, numbered in order; a block holds ``most`` turns and conversations."""
    number = TaskContext.get().partitionId() << 32
    conv, ids, sizes, held = [], [], [], 0

    def done() -> Iterator[pa.RecordBatch]:
        small = block_nodes(number, np.array(conv, dtype=np.int64), ids, np.concatenate(sizes))
        kept = []
        for b in small:  # most are of one row
            kept.append(b)
            if len(kept) == 1000:
                yield from pa.Table.from_batches(kept).combine_chunks().to_batches()
                kept = []
        if kept:
            yield from pa.Table.from_batches(kept).combine_chunks().to_batches()

    for batch in batches:
        rows = zip(batch.column("conv_id").to_pylist(), batch.column("ids").to_pylist(), batch.column("sizes"))
        for c, i, z in rows:
            if conv and held + 1 + len(i) // 16 > most:
                yield from done()
                number, conv, ids, sizes, held = number + 1, [], [], [], 0
            conv.append(c)
            ids.append(i)
            sizes.append(z.values.to_numpy(zero_copy_only=False).astype(np.int64))
            held += 1 + len(i) // 16
    if conv:
        yield from done()


def _corrections(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """What two touching blocks counted twice, by node."""
    for batch in batches:
        for r in batch.to_pylist():
            a, b, n = r["ids"], r["next_ids"], min(len(r["ids"]), len(r["next_ids"])) // 16
            x, y = (np.frombuffer(z, np.uint8)[:16 * n].reshape(-1, 16) for z in (a, b))
            differ = np.flatnonzero((x != y).any(axis=1))
            c = int(differ[0]) if len(differ) else n
            total = np.concatenate(([0], np.cumsum(np.array(r["sizes"][:c], dtype=np.int64))))
            depth = np.arange(c + 1)
            yield _batch(c + 1, kind=["piece"] * (c + 1), depth=depth, key=_keys(a, c), n_convs=np.zeros(c + 1),
                         n_children=-(depth < c).astype(np.int64), n_leaves=np.full(c + 1, -int(16 * c == len(a))),
                         saved_tokens=total[c] - total[np.maximum(depth - 1, 0)])


def _hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``key, ends``: the hash of each key's ids, which come in order."""
    key, h = None, None
    for batch in batches:
        keys, out = [], []
        for k, text in zip(batch.column("key").to_pylist(), batch.column("ends").to_pylist()):
            if k != key:
                if key is not None:
                    keys.append(key)
                    out.append(h.hexdigest())
                key, h = k, hashlib.sha256(text.encode())
            else:
                h.update(b"," + text.encode())
        yield pa.RecordBatch.from_arrays([pa.array(keys, pa.binary()), pa.array(out, pa.string())], ["key", "ends"])
    if key is not None:
        yield pa.RecordBatch.from_arrays([pa.array([key], pa.binary()), pa.array([h.hexdigest()], pa.string())], ["key", "ends"])


def sequences(turns: DataFrame, id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """``conv_id, turns``: each conversation's turns in order, as structs of ``id`` (hex) and ``size`` (bytes of text).

    Null turn numbers come first; turns of equal number are ordered by their ids. A null role
    or text counts as empty. Rows without a conversation id belong to none and are left out.
    Repeated rows are turns of their own.
    """
    said, who = F.coalesce(col(text).cast("string"), F.lit("")), F.coalesce(col(role).cast("string"), F.lit(""))
    key = F.substring(F.sha2(F.concat(F.length(who).cast("string"), F.lit(":"), who, said), 256), 1, 32)
    rows = turns.select(col(id).cast("long").alias("conv_id"), F.struct(
        col(turn).isNotNull().alias("numbered"), col(turn).alias("turn"), key.alias("id"),
        F.octet_length(said).cast("long").alias("size")).alias("t"))
    return rows.where("conv_id is not null").groupBy("conv_id").agg(
        F.transform(F.array_sort(F.collect_list("t")), lambda t: F.struct(t["id"], t["size"])).alias("turns"))


def prefix_trie(conversations: DataFrame, id: str = "conv_id", turns: str = "turns", block: int = BLOCK) -> DataFrame:
    """One row for each node of the trie of ``turns`` (as of :func:`sequences`), the textless root included.

    ``conv_id`` (smallest member), ``depth``, ``parent_conv_id`` (null for the root), ``n_convs``, ``n_children``,
    ``n_leaves``, ``saved_tokens`` (over the subtree, bytes of each node's last text for all members but one),
    ``ends_sha256`` (of the ids of the conversations that end here, ascending), ``last_turn`` (binary id). ``id`` must
    be unique and not null; null ``turns`` count as none. A conversation without turns is a member of the root. An
    empty table has no nodes.
    """
    spark = conversations.sparkSession
    ship(spark)
    own = F.coalesce(col(turns), F.array().cast("array<struct<id: string, size: bigint>>"))
    rows = conversations.select(col(id).cast("long").alias("conv_id"),
                                F.unhex(F.array_join(F.transform(own, lambda t: t["id"]), "")).alias("ids"),
                                F.transform(own, lambda t: t["size"]).alias("sizes"))
    rows = rows.repartitionByRange("ids", "conv_id").sortWithinPartitions("ids", "conv_id")
    found = stage(rows.mapInArrow(partial(_blocks, most=block), _PIECE), "trie-blocks")

    # blocks that touch; what is collected is one number for each block
    numbers = sorted(r["block"] for r in found.where("kind = 'tail'").select("block").collect())
    follows = spark.createDataFrame(list(zip(numbers, numbers[1:])), "block long, next long")
    heads = found.where("kind = 'head'").select(F.col("block").alias("next"), F.col("ids").alias("next_ids"))
    touching = found.where("kind = 'tail'").select("block", "ids", "sizes").join(follows, "block").join(heads, "next")
    twice = touching.select("ids", "sizes", "next_ids").mapInArrow(_corrections, _PIECE)

    sums = ["n_convs", "n_children", "n_leaves", "saved_tokens"]
    pieces = found.where("kind = 'piece'")
    ends = (found.where("kind = 'ends'").select("key", "block", "conv_id", "ends").repartition("key")
            .sortWithinPartitions("key", "block", "conv_id").drop("block", "conv_id")
            .mapInArrow(_hashed, "key binary, ends string"))
    split = pieces.unionByName(twice).groupBy("key", "depth").agg(
        F.min("conv_id").alias("conv_id"), F.max("parent_key").alias("parent_key"), F.max("last_turn").alias("last_turn"),
        *[F.sum(c).alias(c) for c in sums])
    split = stage(split.join(ends, "key", "left").fillna(EMPTY, ["ends"]), "trie-split")

    names = ["conv_id", "depth", "parent_conv_id", *sums, "ends", "last_turn"]
    parents = split.select(F.col("key").alias("parent_key"), F.col("conv_id").alias("parent_conv_id"))
    out = split.join(parents, "parent_key", "left").select(*names)
    nodes = found.where("kind = 'node'")
    above = pieces.select("block", F.col("side").alias("parent_side"), "key", (F.col("depth") + 1).alias("depth")).join(
        split.select("key", F.col("conv_id").alias("above")), "key")
    below = nodes.where("parent_side is not null").join(above.drop("key"), ["block", "parent_side", "depth"])
    out = out.unionByName(nodes.where("parent_side is null").select(*names)).unionByName(
        below.drop("parent_conv_id").withColumnRenamed("above", "parent_conv_id").select(*names))
    return out.withColumnRenamed("ends", "ends_sha256")


def branched(conversations: DataFrame) -> DataFrame:
    """``conv_id, turns``: each conversation with the first turns of the one that heads its five, as many as its id's CRC says."""
    own, n = F.col("conv_id"), F.crc32(F.col("conv_id").cast("string")) % 9
    heads = conversations.where("conv_id % 5 = 0").select(F.col("conv_id").alias("head"), F.slice("turns", 1, 8).alias("first"))
    n = n.cast("int")
    return conversations.join(heads, F.col("head") == own - own % 5, "left").select("conv_id", F.concat(
        F.coalesce(F.slice("first", F.lit(1), n), F.slice("turns", 1, 0)),
        F.slice("turns", n + 1, F.size("turns"))).alias("turns"))


def op11_turn_id_trie(spark, sf_dir: str) -> DataFrame:
    turns = spark.read.parquet(f"{sf_dir}/conversations.parquet").select("conv_id", "turn", "role", "text")
    return prefix_trie(branched(sequences(turns))).drop("last_turn")


#: The CRC is worked out bit by bit; nodes are lists of turns.
OP11_SQL = """
WITH t AS (
  SELECT conv_id, turn, sha256(length(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, '')) AS id,
         strlen(coalesce(text, '')) AS size FROM conversations WHERE conv_id IS NOT NULL),
s AS (
  SELECT conv_id, list({'id': id, 'size': size} ORDER BY turn NULLS FIRST, id) AS turns,
         list_reduce(flatten(list_transform(string_split(conv_id::VARCHAR, ''),
                     lambda x: [ord(x)::UBIGINT, 256, 256, 256, 256, 256, 256, 256, 256])),
                     lambda c, x: CASE WHEN x < 256 THEN xor(c, x)
                     ELSE xor(c >> 1, CASE WHEN c & 1 = 1 THEN 3988292384 ELSE 0 END) END,
                     4294967295::UBIGINT) AS crc
  FROM t GROUP BY conv_id),
h AS (SELECT conv_id, turns, (xor(crc, 4294967295::UBIGINT) % 9)::BIGINT AS n FROM s),
r AS (
  SELECT h.conv_id, list_concat(coalesce(g.turns, [])[1:h.n], h.turns[h.n + 1:]) AS turns
  FROM h LEFT JOIN h g ON g.conv_id = h.conv_id - h.conv_id % 5),
p AS (
  SELECT conv_id, len(turns) AS n, d AS depth, turns[1:d] AS node, CASE WHEN d > 0 THEN turns[1:d - 1] END AS up,
         CASE WHEN d > 0 THEN turns[d].size ELSE 0 END AS size
  FROM r, unnest(range(0, len(turns) + 1)) AS u(d)),
n AS (
  SELECT node, depth, any_value(up) AS up, any_value(size) AS size, min(conv_id) AS conv_id, count(*) AS n_convs,
         sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (n = depth), '')) AS ends_sha256
  FROM p GROUP BY node, depth),
c AS (SELECT up AS node, depth - 1 AS depth, count(*) AS n_children FROM n WHERE depth > 0 GROUP BY ALL),
w AS (SELECT n.node, n.depth, (n_convs - 1) * size AS saved, CASE WHEN c.node IS NULL THEN 1 ELSE 0 END AS leaf
      FROM n LEFT JOIN c ON c.node = n.node AND c.depth = n.depth),
a AS (
  SELECT node[1:d] AS node, d AS depth, sum(leaf)::BIGINT AS n_leaves, sum(saved)::BIGINT AS saved_tokens
  FROM w, unnest(range(0, w.depth + 1)) AS u(d) GROUP BY ALL)
SELECT n.conv_id, n.depth, q.conv_id AS parent_conv_id, n.n_convs, coalesce(c.n_children, 0) AS n_children, a.n_leaves,
       a.saved_tokens, n.ends_sha256
FROM n JOIN a ON a.node = n.node AND a.depth = n.depth LEFT JOIN c ON c.node = n.node AND c.depth = n.depth
LEFT JOIN n q ON q.node = n.up AND q.depth = n.depth - 1
"""
