"""Counts, packing, scores and rules on documents against plain Python versions."""

import math
import random
import re
import time
import zlib
from collections import Counter
from pathlib import Path

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from tidemill.llm import language_model as lm
from tidemill.llm import packing, repetition, tokens
from tidemill.session import work_dir

PIECES = str(public_tokenizers.path("piece_bpe_32k.model"))
WORDS = str(public_tokenizers.path("word_bpe_49k.json"))
SCHEMA = "doc_id long, text string, n_tokens long, `row` long, repetition string, pieces string"

TEXTS = [None, "", " ", "\n\t ", "the", "The the THE, the!", "a" * 3000, "the cat " * 900, "é漢😀́ ñ\x00\x01",
         "<s></s><unk><0x41>▁▁", "<|startoftext|>x<|endoftext|> <|STARTOFTEXT|>", "x.y,z a“. İ' K. Ab.",
         "one line here\none line here\n\n two\n\n#*$%&|<>", " ".join(str(i) for i in range(4000))]


def ascii_lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def words(text):
    return [w for w in re.split("[\x20\x09-\x0d]+", text or "") if w]


@pytest.fixture(scope="module")
def docs(spark):
    rng = random.Random(5)
    parts = ["the", " ", "  ", "\n", "ing", "▁", "é", "漢", "<s>", "#", "a", "b", ",", "Zeitung", "0", "́"]
    made = ["".join(rng.choice(parts) for _ in range(rng.randrange(60))) for _ in range(120)]
    texts = TEXTS + made + made[:5]
    rows = [(None if i == 3 else i // 2 if i < 6 else i, t, i, i, "x", "y") for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, SCHEMA).repartition(3).cache()


def test_token_counts_are_the_librarys(docs):
    from sentencepiece import SentencePieceProcessor
    model = SentencePieceProcessor(model_file=PIECES)
    for r in tokens.token_counts(docs, PIECES, into="t").select("text", "t.*").collect():
        text = r["text"] or ""
        assert (r["n_bytes"], r["n_tokens"]) == (len(text.encode()), len(model.encode(text))), text[:40]
        assert r["over_limit"] == (r["n_tokens"] > 4096)


def test_token_counts_of_no_rows_and_a_full_memo(docs, monkeypatch):
    assert tokens.token_counts(docs.limit(0), PIECES).count() == 0
    merges = tokens.PairMerges.load(PIECES)
    before = [merges.count(t or "") for t in TEXTS]
    monkeypatch.setattr(tokens, "MEMO_UNITS", 3)
    assert [tokens.PairMerges.load(PIECES).count(t or "") for t in TEXTS] == before


def check_places(rows, capacity):
    by = {}
    for r in rows:
        by.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for places in by.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= capacity
    return len(by)


def test_packing_keeps_every_piece(docs):
    from tokenizers import Tokenizer
    tokenizer = Tokenizer.from_file(WORDS)
    expected = Counter()
    for r in docs.select("doc_id", "text").collect():
        ids = np.array(tokenizer.encode(r["text"] or "", add_special_tokens=False).ids + [0], dtype="<u4")
        for k in range(0, len(ids), 256):
            own = ids[k:k + 256]
            expected[r["doc_id"], k // 256, k, len(own), zlib.crc32(own.tobytes())] += 1
    rows = packing.packed_documents(docs, WORDS, 256).collect()
    assert Counter((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in rows) == expected
    total = sum(n * k[3] for k, n in expected.items())
    assert check_places(rows, 256) <= math.ceil(total / 256) + 2
    assert packing.packed_documents(docs.limit(0), WORDS, 256).count() == 0


@pytest.mark.parametrize("lengths", [[1] * 500, [7] * 100 + [93] * 100, list(range(1, 101)) * 3, [100] * 5, [51] * 9])
def test_packing_is_tight(spark, lengths):
    pieces = spark.createDataFrame([(i, n) for i, n in enumerate(lengths)], "key long, length long")
    rows = packing.pack(pieces, "key", "length", 100).join(pieces, "key").collect()
    assert sorted(r["key"] for r in rows) == list(range(len(lengths)))
    least = max(math.ceil(sum(lengths) / 100), sum(n > 50 for n in lengths))
    assert check_places(rows, 100) <= least + 1


def test_words_are_encoded_many_at_once():
    """Words of letters go to the library in joint texts, and the memo stays within its bytes without changing an id."""
    import pyarrow as pa

    words = ["a", "xyz", "\u00e9t\u00e9", "stra\u00dfe", "\u00ff" * 30, "q" * 3000, "hello"] + [f"w{chr(97 + i % 26)}{'ab' * (i % 7)}" for i in range(1500)]
    words = list(dict.fromkeys(words))
    ids_of = packing.WordIds(WORDS)
    calls = []
    letters = ids_of.letters

    class Counted:
        def encode_batch_fast(self, texts, **kw):
            calls.append(len(texts))
            return letters.encode_batch_fast(texts, **kw)

    ids_of.letters = Counted()
    flat, n = ids_of._joined(pa.array(words))
    want = ids_of._each(pa.array(words))
    assert flat.tolist() == want[0].tolist() and n.tolist() == want[1].tolist()
    assert sum(calls) == -(-len(words) // packing.TEXT_WORDS)
    texts = pa.array(["Hello, xyz! it's 20 \u00e9t\u00e9", "", "xyz xyz stra\u00dfe <|endoftext|> a", " ".join(words), "\u00c9T\u00c9 e\u0301 x\u00b2"])
    found = [list(ids_of.ids(texts, memo)) for memo in (packing.Memo(), packing.Memo(0), packing.Memo(100)) for _ in range(2)]
    assert all(f == found[0] for f in found)
    library = ids_of.tokenizer.encode_batch(texts.to_pylist(), add_special_tokens=False)
    assert [np.frombuffer(b, "<u4").tolist() for b in found[0]] == [e.ids for e in library]
    memo = packing.Memo(100)
    list(ids_of.ids(texts, memo))
    assert 0 <= memo.left < 100 and len(memo.words) == len(memo.n) == len(memo.first) < 5


def test_packing_rejects_lengths_over_capacity(spark):
    with pytest.raises(ValueError):
        packing.pack(spark.createDataFrame([(1, 101)], "key long, length long"), "key", "length", 100)


def test_longest_repeats_against_all_pairs():
    rng = random.Random(1)
    for _ in range(150):
        texts = [[rng.randrange(rng.choice([1, 2, 5])) for _ in range(rng.randrange(25))] for _ in range(4)]
        expected = []
        for t in texts:
            for i in range(len(t)):
                best = 0
                for j in range(len(t)):
                    k = 0
                    while i != j and max(i, j) + k < len(t) and t[i + k] == t[j + k]:
                        k += 1
                    best = max(best, k)
                expected.append(best)
        codes = np.array(sum(texts, []), dtype=np.int64)
        owner = np.repeat(np.arange(4), [len(t) for t in texts])
        assert repetition.longest_repeats(codes, owner).tolist() == expected


def test_repetition_rules(docs):
    for r in repetition.repetition(docs, into="q").select("text", "q.*").collect():
        text, w = r["text"] or "", words(r["text"])
        seen, dup = set(), 0
        for line in text.split("\n"):
            if words(line):
                dup += line in seen
                seen.add(line)
        count = Counter(zip(w, w[1:], w[2:]))
        hit = {i + j for i, t in enumerate(zip(w, w[1:], w[2:])) if count[t] > 1 for j in range(3)}
        assert (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"]) == (
            len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text), dup, len(hit)), text[:60]
        assert r["base_failed"] == (len(w) < 50 or 100 * len(hit) > 50 * len(w))
        assert not (r["kept"] and r["base_failed"])
        assert sum(s["stop"] - s["start"] for s in r["spans"]) == r["covered_words"]
    assert repetition.repetition(docs.limit(0)).count() == 0


def test_repetition_verdict(spark):
    fresh = [" ".join(f"w{i}" for i in range(200)), " ".join([f"w{i}" for i in range(100)] + [f"w{i}" for i in range(12)])]
    bad = [" ".join([f"w{i}" for i in range(45)] * 2 + [f"x{i}" for i in range(100)])]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(fresh + bad)], "doc_id long, text string")
    assert sorted(r["doc_id"] for r in repetition.clean(df).collect()) == [0, 1]
    assert repetition.clean(df).columns == df.columns


def test_pasted_paragraph_is_rejected(spark):
    """One paragraph twice (40 % covered) fails these limits but not the base rule."""
    fresh = [f"x{i}" for i in range(120)]
    pasted, short = ([f"w{i}" for i in range(n)] for n in (40, 20))
    texts = [pasted + fresh + pasted, short + fresh + short]
    df = spark.createDataFrame([(i, " ".join(t)) for i, t in enumerate(texts)], "doc_id long, text string")
    out = {r["doc_id"]: r["q"] for r in repetition.repetition(df, into="q").collect()}
    assert not out[0]["base_failed"] and not out[0]["kept"] and out[1]["kept"]


def test_language_model(docs):
    rows = {}
    for r in docs.select("doc_id", "text").collect():
        rows.setdefault(r["doc_id"], []).append([*words(ascii_lower(r["text"])), "\n"])
    held = {i: i is None or zlib.crc32(str(i).encode()) % 10 == 0 for i in rows}
    c = Counter(w for i, texts in rows.items() if not held[i] for t in texts for w in t)
    n, v = sum(c.values()), len(c)
    got = {}
    for r in lm.corpus_scores(docs).collect():
        assert r["held_out"] == held[r["doc_id"]] and r["train_tokens"] == n and r["score"] < 0
        got.setdefault(r["doc_id"], []).append((r["n_tokens"], r["n_known"], round(r["base_score"], 6)))
    for i, texts in rows.items():
        assert sorted(got[i]) == sorted((len(t), sum(c[w] > 0 for w in t), round(sum(
            math.log10((c[w] + 0.1) / (n + 0.1 * (v + 1))) for w in t), 6)) for t in texts)
    assert lm.corpus_scores(docs.limit(0)).count() == 0


def test_language_model_probabilities_sum_to_one(spark):
    rng = random.Random(3)
    texts = [" ".join(rng.choice("abcdefgh") + rng.choice("xy") for _ in range(30)) for _ in range(40)]
    model = lm.fit(spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string"))
    total = np.zeros(lm.CONTEXTS)
    for r in model.words.collect():
        p = np.array(r["parent"]) @ model.weights / len(model.unknown)
        p[r["ctx"]] += r["direct"]
        total += p
    total += model.unknown @ model.weights / len(model.unknown)
    used = {0} | {k for r in model.words.collect() for k in r["ctx"]}
    assert all(abs(total[k] - 1) < 0.02 for k in used), total


def test_language_model_beats_the_base(spark):
    out = lm.op7_pitman_yor_scores(spark, "/root/testdata/sf0.001").where("held_out")
    r = out.agg(F.sum("score").alias("s"), F.sum("base_score").alias("b")).first()
    assert r["s"] > r["b"]


def test_language_model_contexts_are_whole_words(spark):
    """Words of equal endings are contexts of their own, and there are as many contexts as words."""
    texts = ["pling dog", "tling cat"] * 30 + [f"w{i}ing z{i}" for i in range(200)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    model = lm.fit(df)
    assert model.contexts.count() == 405
    total = Counter()
    weight = {r["ctx"]: r["weight"] for r in model.contexts.collect()}
    parents = [np.array(r["parent"]) for r in model.vocabulary.collect()] + [model.unknown]
    for r in model.probabilities().join(model.vocabulary.select("h", "parent"), "h").collect():
        total[r["ctx"]] += r["p"] - np.mean(np.array(r["parent"]) * weight[r["ctx"]])
    for k, w in weight.items():
        assert abs(total[k] + np.mean(sum(parents) * np.array(w)) - 1) < 1e-6
    probe = spark.createDataFrame([(0, "pling dog"), (1, "tling dog")], "doc_id long, text string")
    score = {r["doc_id"]: r["score"] for r in lm.score(probe, model).collect()}
    assert score[0] > score[1] + 1


def test_blocks_spread_as_single_customers_do(monkeypatch):
    n, h = np.full(4000, 600), np.arange(4000)

    def seated(seed):
        return lm.seat(n, np.full(4000, 20.0), np.zeros(4000), 0.0, lambda cells, i, *j: lm._uniform(
            h[cells, None] if j else h[cells], seed, i, *j))

    blocks = seated(1)
    monkeypatch.setattr(lm, "SINGLE", 1000)
    single = seated(2)
    assert abs(blocks.mean() / single.mean() - 1) < 0.03
    assert abs(blocks.std() / single.std() - 1) < 0.1


def test_heavy_and_rare_words_get_the_same_scores(docs, monkeypatch):
    usual = sorted((r["n_tokens"], r["n_known"], round(r["score"], 4)) for r in lm.corpus_scores(docs).collect())
    monkeypatch.setattr(lm, "HEAVY", 0)
    assert sorted((r["n_tokens"], r["n_known"], round(r["score"], 4)) for r in lm.corpus_scores(docs).collect()) == usual


def stored(spark, texts):
    """Bytes that scoring these texts leaves in the shared folder."""
    def size():
        folder = work_dir(spark).removeprefix("file:")
        return sum(f.stat().st_size for f in Path(folder).glob("lm-*/*"))

    df, before = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), size()
    assert lm.corpus_scores(df).count() == len(texts)
    return size() - before


def test_language_model_stores_less_than_its_texts(spark):
    rng = random.Random(8)
    texts = [" ".join(f"word{int(2 ** (rng.random() * 14))}" for _ in range(300)) for _ in range(400)]
    assert stored(spark, texts) < sum(map(len, texts))


def test_scores_do_not_depend_on_slices_and_buckets(docs, monkeypatch):
    def scores():
        return sorted((r["n_tokens"], r["n_known"], round(r["base_score"], 6), round(r["score"], 6))
                      for r in lm.corpus_scores(docs).collect())

    usual = scores()
    monkeypatch.setattr(lm, "BUCKET_TOKENS", 100)
    monkeypatch.setattr(lm, "SLICE_BYTES", 2000)
    assert scores() == usual


def test_cells_are_added_and_found():
    rng = np.random.default_rng(2)
    parts, count = [], Counter()
    for _ in range(3):
        contexts, words = (rng.choice(np.arange(-50, 50), 20, replace=False) for _ in range(2))
        x, k = np.divmod(np.sort(rng.choice(400, 90, replace=False)), 20)
        parts.append(lm.Cells.read(lm.Cells(contexts, words, x, k, rng.integers(1, 500, 90)).row()))
        count.update(dict(zip(zip(contexts[x].tolist(), words[k].tolist()), parts[-1].n.tolist())))
    whole = lm.Cells.added(parts)
    keys = list(zip(whole.contexts[whole.x].tolist(), whole.words[whole.k].tolist()))
    assert keys == sorted(count) and dict(zip(keys, whole.n.tolist())) == count
    some = lm.Cells.added(parts[:1])
    for of, asked in ((whole, some), (some, whole)):
        at = of.find(asked)
        have = {c: i for i, c in enumerate(zip(of.contexts[of.x].tolist(), of.words[of.k].tolist()))}
        assert at.tolist() == [have.get(c, -1) for c in zip(asked.contexts[asked.x].tolist(), asked.words[asked.k].tolist())]


def test_language_model_frees_its_steps(spark):
    """Of all its tables and shuffles, only the scores stay on disk."""
    def left():
        env = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get()
        shuffles = [f for d in env.blockManager().diskBlockManager().localDirs() for f in Path(d.getPath()).glob("*/shuffle_*.data")]
        return set(shuffles), set(Path(work_dir(spark).removeprefix("file:")).glob("lm-*"))

    df = spark.createDataFrame([(i, f"the w{i % 90} of w{i % 70}") for i in range(300)], "doc_id long, text string")
    shuffles, tables = left()
    out = lm.corpus_scores(df)
    assert [f.name[:10] for f in left()[1] - tables] == ["lm-scores-"]
    until = time.time() + 20
    while left()[0] - shuffles and time.time() < until:
        time.sleep(0.2)
    assert not left()[0] - shuffles
    assert out.count() == 300


def test_dealt_tables_travel_in_few_rows(spark, monkeypatch):
    rng, rows, want = np.random.default_rng(4), [], Counter()
    for bucket in range(5):
        contexts, t = np.sort(rng.choice(np.arange(-500, 500), 400, replace=False)), rng.integers(1, 9, 400)
        want.update(dict(zip(contexts.tolist(), t.tolist())))
        rows.append((contexts.tobytes(), lm._packed(np.ones(400, np.int64)), lm._packed(t)))
    state = spark.createDataFrame(rows, "contexts binary, per binary, t binary")
    spread, made, told = np.arange(-500, 500, 3), [], lm._told
    monkeypatch.setattr(lm, "_told", lambda *args: made.append(told(*args)) or made[-1])
    assert lm._dealt_tables(state, spread).tolist() == [want[h] for h in spread.tolist()]
    assert made[0].count() == 5 * -(-len(spread) // lm.DEALT)
