"""Fill-in-middle cuts, conversation tries and embedding links against plain Python versions."""

import hashlib
import random
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tidemill.llm import infill, rotation_codes, turn_trie


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


# fill in the middle

PARTS = ["the cat sat on the mat ", "é", "漢字", " ", "<", "abc" * 500, "\n", "Xyz", "0", "😀", "<M>", "<P", "S>"]
LONG = ["a" * 70000, "-" * 70000, "é" * 40000, "ab é" * 50000]


def infilled(id, text, seed=1):
    """n, form, characters of prefix and middle, output."""
    text = text or ""
    w = re.findall("[A-Za-z]+|[^A-Za-z]", text)
    d = hashlib.sha256(f"{seed}:{'' if id is None else id}".encode()).hexdigest()
    h = [int(d[i:i + 8], 16) for i in range(0, 32, 8)]
    a, b = sorted((h[0] % (len(w) + 1), h[1] % (len(w) + 1)))
    p, m, s = "".join(w[:a]), "".join(w[a:b]), "".join(w[b:])
    if not text or any(x in text for x in ("<P>", "<S>", "<M>")) or h[2] % 100 >= 90:
        return len(w), "plain", None, None, text
    if h[3] % 100 < 20:
        return len(w), "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}"
    return len(w), "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}"


@pytest.fixture(scope="module")
def mixed(spark):
    rng = random.Random(3)
    texts = [None, "", "a", "é", "\n", *LONG]
    texts += ["".join(rng.choice(PARTS) for _ in range(rng.randrange(60))) for _ in range(300)]
    rows = [(None if i == 7 else i // 2 if i < 6 else i, t, "x", "y", i) for i, t in enumerate(texts)] * 2
    return spark.createDataFrame(rows, "doc_id long, text string, infill string, form string, `_drawn` long").repartition(3)


def test_infill_cuts_between_the_tokens(mixed):
    out = infill.fill_in_middle(mixed, into="f")
    assert out.columns == [*mixed.columns, "f"]
    rows = out.withColumn("back", infill.restored(F.col("f.output"), F.col("f.form"))).collect()
    assert len(rows) == 2 * 309 and {r["f"]["form"] for r in rows} == {"plain", "psm", "spm"}
    for r in rows:
        assert tuple(r["f"]) == infilled(r["doc_id"], r["text"]), (r["text"] or "")[:50]
        assert r["back"] == (r["text"] or "")


def test_infill_of_no_rows_and_of_a_full_cache(spark, mixed):
    assert infill.fill_in_middle(mixed.limit(0)).count() == 0
    texts = pa.array([r["text"] or "" for r in mixed.select("text").collect()])
    one, two = infill.Summaries(), infill.Summaries(100)
    for _ in range(2):
        a, b = infill.Tokens(texts, one), infill.Tokens(texts, two)
        assert (a.counts == b.counts).all() and two.held < 100 + infill.LONGEST
        for x, y in zip(a.places(a.counts // 2), b.places(a.counts // 2)):
            assert (x == y).all()


def test_infill_finds_every_token(mixed):
    rng = random.Random(4)
    texts = ["".join(rng.choice(PARTS) for _ in range(40)) for _ in range(30)]
    t = infill.Tokens(pa.array(texts), infill.Summaries())
    words = [re.findall("[A-Za-z]+|[^A-Za-z]", x) for x in texts]
    for k in range(0, max(map(len, words)) + 1, 7):
        byte, char = t.places(np.array([min(k, len(w)) for w in words]))
        assert char.tolist() == [len("".join(w[:k])) for w in words]
        assert byte.tolist() == [len("".join(w[:k]).encode()) for w in words]


def test_equal_passages_fall_into_equal_chunks():
    rng = random.Random(5)
    passage = "".join(rng.choice("abcdefgh ,.é") for _ in range(20000))
    texts = [passage, "0123" * 7 + passage, passage[:50] + "!" + passage]
    data = [np.frombuffer(t.encode(), np.uint8) for t in texts]
    cut = [infill.chunk_ends(d, np.array([0, len(d)])) for d in data]
    found = [{bytes(d[i:j]) for i, j in zip(e[:-1], e[1:])} for d, e in zip(data, cut)]
    assert len(found[0]) > 20 and len(found[0] & found[1] & found[2]) > 0.9 * len(found[0])


# tries of conversations

def trie(conversations):
    """The rows of prefix_trie, without last turns, from {conv_id: [(role, text), ...]}."""
    nodes = {}
    for c, turns in conversations.items():
        for d in range(len(turns) + 1):
            nodes.setdefault(tuple(turns[:d]), []).append(c)
    children, leaves, saved = ({k: 0 for k in nodes} for _ in range(3))
    for k in nodes:
        if k:
            children[k[:-1]] += 1
    for k, members in nodes.items():
        for d in range(len(k) + 1):
            leaves[k[:d]] += not children[k]
            saved[k[:d]] += (len(members) - 1) * len(k[-1][1].encode()) if k else 0
    return sorted((min(m), len(k), min(nodes[k[:-1]]) if k else None, len(m), children[k], leaves[k], saved[k],
                   sha(",".join(str(c) for c in sorted(m) if conversations[c] == list(k)))) for k, m in nodes.items())


def logged(turns):
    """{conv_id: [(role, text), ...]} of (conv_id, turn, role, text) with different turns."""
    out = {}
    for c, _, role, text in sorted((r for r in turns if r[0] is not None), key=lambda r: (r[0], r[1] is not None, r[1] or 0)):
        out.setdefault(c, []).append((role or "", text or ""))
    return out


def rebuilt(own):
    out = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 9
        out[c] = own.get(c - c % 5, [])[:h] + turns[h:]
    return out


COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def found(df):
    return sorted((tuple(r[c] for c in COLUMNS) for r in df.collect()), key=lambda r: (r[0], r[1], r[7]))


@pytest.fixture(scope="module")
def turns(spark):
    rng = random.Random(6)
    rows = []
    for c in rng.sample(range(5000), 400):
        n = rng.choice([1, 2, 3, 5, 8, 20, 45])
        rows += [(c, t or None, rng.choice(["user", "", None]), rng.choice(["", None, "é", "hello there"]) if t > 1 else "hi")
                 for t in range(n)]
    rows += [(10_000 + c, t, "user", f"the same {t}") for c in range(300) for t in range(4)]  # copies
    rows += [(20_000, t, "user", "the same 0" if t == 0 else "x" * 3000) for t in range(700)]  # long
    rows += [(None, 1, "user", "lost")]
    rng.shuffle(rows)
    return rows, spark.createDataFrame([(*r, "a", b"b", 1) for r in rows], "conv_id long, turn long, role string, text string,"
                                       " turns string, ids binary, block int").repartition(3)


@pytest.mark.parametrize("block", [3, 900])
def test_trie_is_the_same_over_any_blocks(turns, block):
    rows, df = turns
    own = logged(rows)
    got = found(turn_trie.prefix_trie(turn_trie.sequences(df), block=block))
    assert got == sorted(trie(own), key=lambda r: (r[0], r[1], r[7]))


def test_rebuilt_conversations(turns, spark, tmp_path):
    rows, df = turns
    df.write.parquet(f"{tmp_path}/conversations.parquet")
    got = found(turn_trie.op11_turn_id_trie(spark, str(tmp_path)))
    assert got == sorted(trie(rebuilt(logged(rows))), key=lambda r: (r[0], r[1], r[7]))


def test_trie_of_repeated_and_of_no_turns(spark, turns):
    none = turn_trie.prefix_trie(turn_trie.sequences(turns[1].limit(0)))
    assert none.count() == 0 and none.columns == [*COLUMNS, "last_turn"]
    twice = spark.createDataFrame([(1, 2, "a", "b")] * 2 + [(1, 1, "a", "z"), (1, None, "b", "q")], "conv_id int, turn int, role string, text string")
    got = found(turn_trie.prefix_trie(turn_trie.sequences(twice)))
    assert got == trie({1: [("b", "q"), ("a", "z"), ("a", "b"), ("a", "b")]})
    bare = spark.createDataFrame([(7, None), (3, [])], "conv_id long, turns array<struct<id: string, size: long>>")
    assert found(turn_trie.prefix_trie(bare)) == [(3, 0, None, 2, 0, 1, 0, sha("3,7"))]


# links of vectors

def links_of(rows, similarity=0.95):
    """(id, links, smallest id reachable) of each row; nulls last."""
    def good(v):
        return v is not None and all(x is not None and np.isfinite(x) for x in v) and any(v)

    vectors = [np.array(v, dtype=np.float64) if good(v) else None for _, v in rows]
    part, n = list(range(len(rows))), [0] * len(rows)
    for i, x in enumerate(vectors):
        for j in range(i):
            y = vectors[j]
            if x is not None and y is not None and len(x) == len(y):
                x_, y_ = x / np.abs(x).max(), y / np.abs(y).max()
                if x_ @ y_ / (np.linalg.norm(x_) * np.linalg.norm(y_)) >= similarity:
                    n[i], n[j] = n[i] + 1, n[j] + 1
                    low, high = sorted((part[i], part[j]))
                    part = [low if p == high else p for p in part]
    least = {}
    for (k, _), p in zip(rows, part):
        least[p] = min(least.get(p, (True, 0)), (k is None, k or 0))
    return [(k, m, None if least[p][0] else least[p][1]) for (k, _), m, p in zip(rows, n, part)]


def ordered(rows):
    return sorted(rows, key=repr)


@pytest.mark.parametrize("block", [7, 4096])
def test_links_of_odd_vectors(spark, block):
    rng = np.random.default_rng(7)
    centre = rng.standard_normal((12, 24))
    vectors = [list(map(float, centre[i % 12] * rng.choice([0.5, 1, 1e200]) + rng.standard_normal(24) * 0.05 * (i % 12 < 9)))
               for i in range(90)]
    vectors = [v if max(map(abs, v)) < 1e100 else [x * 1.0 for x in v] for v in vectors]
    vectors += [vectors[0]] * 25 + [None, [], [0.0] * 24, [None] + [1.0] * 23, [float("nan")] * 24, [float("inf")] * 24]
    vectors += [[-0.0, 1.0], [0.0, 2.0], [1.0], [3.0], [-2.0], [1e-300, 1e-300, 0.0], [1.0, 1.0, 0.0]]
    rows = [(None if i in (3, 100, 117) else i // 2 if i < 6 else 900 - i, v) for i, v in enumerate(vectors)]
    df = spark.createDataFrame([(*r, 1, "x") for r in rows], "vec_id long, embedding array<double>, n int, vector string").repartition(3)
    out = rotation_codes.near_vectors(df, block=block).collect()
    assert ordered((r["vec_id"], r["n_links"], r["component_id"]) for r in out) == ordered(links_of(rows))
    assert all(r["kept"] == (r["vec_id"] == r["component_id"]) for r in out)
    assert rotation_codes.near_vectors(df.limit(0)).count() == 0


def test_recall_of_links_near_the_threshold(spark):
    rng = np.random.default_rng(8)
    x = rng.standard_normal((700, 32))
    x /= np.linalg.norm(x, axis=1)[:, None]
    away = rng.standard_normal((700, 32))
    away -= (away * x).sum(axis=1)[:, None] * x
    away /= np.linalg.norm(away, axis=1)[:, None]
    cosine = rng.uniform(0.949, 0.953, 700)[:, None]
    both = np.concatenate([x, cosine * x + np.sqrt(1 - cosine ** 2) * away])
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(both)], "vec_id long, embedding array<double>")
    found = {r["vec_id"]: r["n_links"] for r in rotation_codes.near_vectors(df).collect()}
    true = (both @ both.T >= 0.95).sum(axis=1) - 1
    assert all(found[i] <= true[i] for i in found)
    assert sum(found.values()) >= 0.99 * true.sum() > 700


def test_estimates_are_unbiased_and_bounded():
    rng = np.random.default_rng(9)
    x = rng.standard_normal((4000, 64))
    x[1::2] = x[::2] + 0.3 * rng.standard_normal((2000, 64))
    words, factors, _ = rotation_codes.Codes(x, 24, 13).signs()
    table = rotation_codes.Bucketed(x, words, factors, 24, 13)
    a, b = np.arange(0, 4000, 2), np.arange(1, 4000, 2)
    true = (table.codes.unit[a] * table.codes.unit[b]).sum(axis=1)
    assert table.may_reach(a, b, 0.95)[true >= 0.95].all() and (true >= 0.95).sum() > 500
    assert not table.may_reach(a, np.roll(b, 1), 0.95).any()
