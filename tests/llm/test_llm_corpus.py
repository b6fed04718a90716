"""Operators over many documents, chat logs, pages and the pipeline against plain Python versions."""

import base64
import gzip
import hashlib
import math
import random
import re
from collections import Counter
from itertools import combinations

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tidemill.llm import chat, decontaminate, neardup, privacy, ranges, repetition, url_lists, warc

SF = "/root/testdata/sf0.001"


def ascii_lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


# near duplicates

def shingles(text, size):
    w = [x for x in re.split("[\x20\x09-\x0d]+", ascii_lower(text)) if x]
    return {tuple(w[i:i + size]) for i in range(max(1, len(w) - size + 1))} if w else set()


def linked(rows, size=4, percent=80):
    """(id, n_shingles, smallest id reachable) of each row; nulls last."""
    sets = [shingles(t, size) for _, t in rows]
    parent = list(range(len(rows)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, j in combinations(range(len(rows)), 2):
        if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= percent * len(sets[i] | sets[j]):
            parent[root(i)] = root(j)
    least = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            least[root(i)] = min(least.get(root(i), d), d)
    return Counter((d, len(sets[i]), least.get(root(i))) for i, (d, _) in enumerate(rows))


def near_texts(rng):
    """Groups of copies edited to all degrees, texts that share a long passage, short ones."""
    word = lambda: "".join(rng.choice("abcdef") for _ in range(5))
    passage, texts = [word() for _ in range(40)], []
    for _ in range(6):
        base = [word() for _ in range(rng.choice([12, 60, 150]))]
        for _ in range(14):
            copy = list(base)
            for _ in range(rng.randrange(0, 9)):
                copy[rng.randrange(len(copy))] = word()
            texts.append(" ".join(copy))
    texts += [" ".join(passage + [word() for _ in range(rng.randrange(30))]) for _ in range(25)]
    texts += [" ".join(word() for _ in range(n)) for n in (1, 2, 3, 4, 5)] + ["A b c d", "a B c D", "x", "X"]
    return texts


@pytest.mark.parametrize("seed", [1, 2])
def test_near_duplicates(spark, seed):
    rng = random.Random(seed)
    rows = list(enumerate(near_texts(rng))) + [(900, None), (901, ""), (902, " \n"), (903, "q"), (903, "q")]
    rows = [(i * 7 % 1009, t) for i, t in rows]
    df = spark.createDataFrame([(i, t, 1, "z") for i, t in rows], "doc_id long, text string, node long, sketch string")
    out = neardup.near_duplicates(df).collect()
    assert Counter((r["doc_id"], r["n_shingles"], r["component_id"]) for r in out) == linked(rows)
    assert all(r["kept"] == (r["doc_id"] == r["component_id"]) for r in out)
    kept = neardup.one_of_each(df)
    assert kept.columns == df.columns
    assert Counter(r["doc_id"] for r in kept.collect()) == Counter({c for _, _, c in linked(rows)})


def test_near_duplicates_of_long_texts(spark, monkeypatch):
    """Sets below, at and above the size up to which they go along whole, edited to around the limit."""
    monkeypatch.setattr(neardup, "FRONT", 16)
    rng = random.Random(3)
    word = lambda: "".join(rng.choice("abcdef") for _ in range(6))
    texts = []
    for n in (neardup.SHARP - 20, neardup.SHARP + 3, 2 * neardup.SHARP + 100):
        base = [word() for _ in range(n)]
        for _ in range(12):
            copy = list(base)
            for at in rng.sample(range(n), n * rng.choice([1, 2, 3, 4]) // 100):
                copy[at] = word()
            texts.append(" ".join(copy))
    texts += [" ".join(word() for _ in range(20_000))] * 2
    rows = list(enumerate(texts))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    out = neardup.near_duplicates(df).collect()
    assert Counter((r["doc_id"], r["n_shingles"], r["component_id"]) for r in out) == linked(rows)
    assert 3 < len({r["component_id"] for r in out}) < len(rows) - 1


def test_near_duplicates_without_ids_and_rows(spark):
    rows = [(1, "a b c d e"), (1, "a b c d e"), (None, "a b c d e"), (None, "x"), (None, "x"), (None, "y"), (1, "z")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    found = Counter((r["doc_id"], r["component_id"], r["chosen"]) for r in neardup.near_duplicates(df).collect())
    assert found == Counter({(1, 1, True): 3, (None, 1, False): 1, (None, None, True): 3})
    assert Counter(tuple(r) for r in neardup.one_of_each(df).collect()) == Counter(
        [(1, "a b c d e"), (None, "x"), (None, "y"), (1, "z")])
    assert neardup.near_duplicates(df.limit(0)).count() == 0 == neardup.one_of_each(df.limit(0)).count()


def test_components_of_long_chains(spark):
    edges = [(i, i + 1) for i in range(100, 160)] + [(7, 3), (3, 9)]
    got = {r["node"]: r["component"] for r in neardup.components(
        spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**{i: 100 for i in range(100, 161)}, 7: 3, 3: 3, 9: 3}


# benchmark decontamination

WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")


def hits(docs, items):
    windows = {}
    for i, t in items:
        w = WORD.findall(ascii_lower(t))
        for k in range(max(1, len(w) - 12) if w else 0):
            windows.setdefault(tuple(w[k:k + 13]), set()).add("" if i is None else str(i))
    out = Counter()
    for d, t in docs:
        w, hit, found = WORD.findall(ascii_lower(t)), set(), set()
        for n in {len(x) for x in windows}:
            for k in range(len(w) - n + 1):
                if own := windows.get(tuple(w[k:k + n])):
                    found |= own
                    hit.update(range(k, k + n))
        out[d, len(w), len(hit), tuple(sorted(found)), 0 < len(hit) and 20 * len(hit) >= len(w)] += 1
    return out


def test_contamination(spark):
    rng = random.Random(4)
    word = lambda: rng.choice(["a", "b", "É", "zz", "t1"])
    items = [(i, " ".join(word() for _ in range(rng.choice([0, 1, 2, 5, 13, 14, 30])))) for i in range(12)]
    items += [(None, "é q"), (3, None), (3, "A b,c"), (98, items[4][1]), (99, items[4][1])]
    docs = [(i, "-".join(word() for _ in range(rng.randrange(80)))) for i in range(40)]
    docs += [(50 + i, f"x {t}! y " + "pad " * n) for i, (_, t) in enumerate(items) for n in (0, 400)]
    docs += [(None, "k é q"), (None, None), (1, ""), docs[3], docs[3], (77, "Éa É é.q")]
    df = spark.createDataFrame([(i, t, 1, "o") for i, t in docs], "doc_id long, text string, w long, own string")
    bench = spark.createDataFrame(items, "item_id long, text string")

    def found(docs_, items_):
        return Counter((r["doc_id"], r["n_words"], r["n_hit"], tuple(r["item_ids"]), r["contaminated"])
                       for r in decontaminate.contamination(docs_, items_).collect())

    expected = hits(docs, items)
    assert found(df, bench) == expected
    clean = decontaminate.decontaminated(df, bench)
    assert clean.columns == df.columns
    assert clean.count() == sum(n for k, n in expected.items() if not k[4])
    assert not found(df.limit(0), bench)
    assert found(df, bench.limit(0)) == hits(docs, [])


# personal data

BASE = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
        "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def luhn(digits):
    total = 0
    for i, c in enumerate(reversed(digits)):
        v = int(c) * (1 + i % 2)
        total += v - 9 * (v > 9)
    return total % 10 == 0


def base_spans(text):
    out = []
    for n, (kind, pattern) in enumerate(BASE.items()):
        for m in re.finditer(pattern, text or ""):
            digits = re.sub("[^0-9]", "", m[0])
            if {"email": True, "ip": all(int(x) <= 255 for x in re.findall("[0-9]+", m[0])),
                    "card": 12 <= len(digits) <= 19 and luhn(digits), "phone": 9 <= len(digits) <= 15}[kind]:
                out.append((m.start(), n, m.end()))
    return tuple(sorted(out))


def test_base_spans(spark):
    rng = random.Random(3)

    def card():
        digits = "".join(rng.choice("0123456789") for _ in range(rng.randrange(11, 19)))
        digits += next(c for c in "0123456789" if luhn(digits + c))
        return rng.choice(["", " ", "-"]).join(digits[i:i + 4] for i in range(0, len(digits), 4))

    parts = [*"a1.@- +()%_é漢😀\n0259", "a@b.c", "1.2.3.4", "255.0.1.9", "+49 ", ".com", "@x", "000255"]
    texts = [None, "", "a." * 3000 + "@b.c", "1" * 4000, "x@" + "y." * 2000 + "z", "+1" + " 2" * 3000]
    texts += ["".join(rng.choice(parts) if rng.random() < 0.95 else card() for _ in range(rng.randrange(40)))
              for _ in range(1500)]
    df = spark.createDataFrame([(i, t, "k", 1) for i, t in enumerate(texts)],
                               "doc_id long, text string, kind string, `row` long").repartition(4)
    got = {r["doc_id"]: tuple((s["start"], s["kind"], s["stop"]) for s in r["spans"] if s["kind"] < 4)
           for r in privacy.personal_data(df).collect()}
    assert got == {i: base_spans(t) for i, t in enumerate(texts)}
    assert privacy.personal_data(df.limit(0)).count() == 0


def test_disclosing_terms_are_masked(spark):
    docs = [(1, "mail jane.doe@x.org of Acme now"), (2, "mail JANE.doe@x.org of Acme now ok"), (None, None), (3, ""),
            (None, "call +49 (30) 123-4567 or 4111 1111 1111 1111 +1.2.3.4 x"), (4, "é😀 1.2.3.4, z@y.de.")]
    docs += [(i, "plain mail of now here") for i in range(10, 60)] + [(10, "plain mail of now here")]
    df = spark.createDataFrame([(i, t, 1) for i, t in docs], "doc_id long, text string, spans long")
    out = Counter((r["doc_id"], r["text"]) for r in privacy.sanitised(df).collect())
    expected = {1: "mail [EMAIL] of  now", 2: "mail [EMAIL] of  now ok", 4: "é😀 [IP], [EMAIL]."}
    assert out == Counter((i, "call [PHONE] or [CARD] +[IP] x" if i is None and t else expected.get(i, t)) for i, t in docs)
    assert privacy.sanitised(df).columns == df.columns


def test_entity_of_one_document_has_disclosing_terms(spark):
    docs = [(0, "ask Marisol via bob@x.com about plain things")]
    docs += [(i, "ask about plain things via mail") for i in range(1, 1200)]
    df = spark.createDataFrame([(i, t, len(t)) for i, t in docs], "doc_id long, text string, n_chars long")
    out = {r["doc_id"]: (r["text"], r["n_chars"]) for r in corpus_pipeline.privacy(spark, df, SF).collect()}
    assert out[0] == (t := "ask [TERM] via [EMAIL] about plain things", len(t))
    assert out[7] == (docs[7][1], len(docs[7][1]))


def test_disclosing_terms_of_whole_texts(spark):
    """Against counts of whole texts; terms stand far from the entity, first, last, and only as copies elsewhere."""
    rng = random.Random(8)
    far = "plain words here " * 20
    texts = ["Marisol bob@x.com", f"bob@x.com {far}Marisol", f"Zürich, {far}😀 eve@y.org and marisol! {far}Zürich",
             f"eve@y.org zürich {far}", "Zürich: nobody here"] + [f"ada{i}@z.de sign{i} {far}Sign{i}" for i in range(5)]
    common = ["plain", "words", "here", *(f"topic{c}" for c in "abcdefgh"), "abcd", "efgh", "ijkl"]
    texts += [" ".join(rng.choice(common) for _ in range(rng.randrange(30))) for _ in range(1500)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(5)
    term = re.compile(r"(?<!\S)[^\W\d_]{4,}(?=[,;:.!?]?(?:\s|$))")
    own = {i: {m[0].lower() for m in term.finditer(t)} for i, t in enumerate(texts)}
    entities = {i: {t[a:b].lower() for a, k, b in base_spans(t) if k == 0} for i, t in enumerate(texts)}
    n_t, n_e = Counter(t for x in own.values() for t in x), Counter(e for x in entities.values() for e in x)
    n_et = Counter((e, t) for i in own for e in entities[i] for t in own[i])

    def share(e, t):
        n = len(texts)
        return math.log2(n * n_et[e, t] / (n_e[e] * (n_t[t] + (n_et[e, t] < 2)))) / math.log2(n / n_e[e])

    expected = {}
    for i, t in enumerate(texts):
        for m in term.finditer(t):
            best = max((share(e, m[0].lower()) for e in entities[i]), default=0)
            if best >= 0.9:
                expected[i, m.start(), m.end()] = round(best, 6)
    assert len(expected) >= 5
    got = {(r["doc_id"], s["start"], s["stop"]): round(s["share"], 6)
           for r in privacy.personal_data(df).collect() for s in r["spans"] if s["kind"] == 4}
    assert got == expected


def test_no_python_on_the_native_paths(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    for df in (privacy.op4_information_sanitising(spark, SF), decontaminate.op8_prefix_filtered_windows(spark, SF),
               privacy.base_matches(docs, "doc_id", "text"), privacy.sanitised(docs)):
        plan = df._jdf.queryExecution().toString()
        assert not re.search("Python|Pandas|Arrow", plan)


# chat logs

def test_snapshots_collapse(spark):
    rng = random.Random(6)
    convs = [[("user", rng.choice("ab")) if i % 2 == 0 else (rng.choice(["assistant", None]), rng.choice(["x", None, ""]))
              for i in range(rng.randrange(1, 6))] for _ in range(60)]
    rows = [(c, t, r, x, 1) for c, turns in enumerate(convs) for t, (r, x) in enumerate(turns)]
    rows += rows[:9] + [(None, 0, "user", "lone", 1), (None, 0, "user", "lone", 1)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, `key` long").repartition(3)
    plain = {c: tuple((r or "unknown", x or "") for r, x in turns) for c, turns in enumerate(convs)}
    best = {}
    for c, turns in plain.items():
        if not any(len(o) > len(turns) and o[:len(turns)] == turns for o in plain.values()):
            best.setdefault(turns, c)
    best[("user", "lone"),] = None
    expected = {(c, len(t), "".join(f"<|im_start|>{r}\n{x}<|im_end|>\n" for r, x in t)) for t, c in best.items()}
    assert {tuple(r) for r in chat.rendered(df).collect()} == expected
    assert chat.rendered(df.limit(0)).count() == 0


def test_running_values_cross_partitions(spark):
    rows = [(k, i, i if i % 7 == 0 else None) for k, n in ((None, 40), (1, 900), (2, 3)) for i in range(n)]
    df = spark.createDataFrame(rows, "k long, i long, v long").repartition(5)
    out = ranges.running(df, ["k"], ["i"], sums={"total": F.col("i")}, lasts={"last": F.col("v")}).collect()
    assert len(out) == len(rows)
    for r in out:
        assert (r["total"], r["last"]) == (r["i"] * (r["i"] + 1) // 2, r["i"] // 7 * 7)


# pages

def test_warc_derivatives(spark, tmp_path):
    page = "<!-- n --><html lang='de'><title>T &amp; t</title><script>x<p></script><p>a&eacute; <b>b</b><br>c < d<p><a href=x>l"
    rows = [(1, "http://a/", page, 1), (1, "http://a/", page, 1), (None, None, None, 1), (2, "x\ny", "<style>q", 1),
            (3, "u", "<" * 20000, 1), (4, "v", "<script>" * 5000, 1)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string, record string")
    out = warc.derivatives(df).collect()
    assert len(out) == 2 * len(rows)
    for r in out:
        data = r["block"].encode()
        assert r["content_length"] == len(data)
        assert r["block_digest"] == "sha1:" + base64.b32encode(hashlib.sha1(data).digest()).decode()
        head, block = r["record"].split("\r\n\r\n", 1)
        assert block == r["block"] and f"WARC-Refers-To: {r['refers_to']}" in head and r["source_digest"] in head
    mine = [r for r in out if r["page_id"] == 1]
    assert len({r["record_id"] for r in mine}) == 2 and len({r["refers_to"] for r in out}) == 5
    assert [r["block"] for r in mine if r["record_type"] == "conversion"] == ["T & t\naé b\nc < d\nl"] * 2
    meta = next(r["block"] for r in mine if r["record_type"] == "metadata")
    assert "title: T & t\r\nlanguage: de\r\noutlinks: 1\r\n" in meta
    assert warc.derivatives(df.limit(0)).count() == 0
    warc.write_records(warc.derivatives(df), str(tmp_path / "w"))
    stored = b"".join(gzip.open(f).read() for f in (tmp_path / "w").glob("*.gz"))
    at = n = 0
    while at < len(stored):
        head = stored[at:stored.index(b"\r\n\r\n", at)]
        assert head.startswith(b"WARC/1.1\r\n")
        at += len(head) + 4 + int(re.search(rb"Content-Length: (\d+)", head)[1])
        assert stored[at:at + 4] == b"\r\n\r\n"
        at, n = at + 4, n + 1
    assert n == 2 * len(rows)


def test_warc_source_headers_are_kept(spark):
    given = {"WARC-IP-Address": "10.0.0.1", "warc-type": "response", "Content-Length": "7", "X-Odd\r\nA": "b\r\nc",
             "WARC-Payload-Digest": "sha1:HEAD", "WARC-Record-ID": "<urn:uuid:head>", "WARC-Date": "2020-01-01T00:00:00Z"}
    rows = [(1, "http://a/", "<p>x", "<urn:uuid:own>", "sha1:OWN", "2021-02-03T04:05:06Z", given),
            (2, "http://a/", "<p>x", None, None, None, given), (3, "http://a/", "<p>x", None, None, None, None)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string, own string, sum string, at string,"
                                     " head map<string,string>")
    out = warc.derivatives(df, date="at", record_id="own", payload_digest="sum", headers="head").collect()
    for r in out:
        lines = r["record"].split("\r\n\r\n", 1)[0].split("\r\n")[1:]
        head = {k.lower(): v for k, v in (x.split(": ", 1) for x in lines)}
        assert len(head) == len(lines) and head["warc-type"] == r["record_type"]
        assert int(head["content-length"]) == r["content_length"] == len(r["block"].encode())
        assert (head["warc-refers-to"], head["warc-source-payload-digest"]) == (r["refers_to"], r["source_digest"])
        if r["page_id"] < 3:
            assert (r["refers_to"], r["source_digest"], head["warc-date"]) == (
                ("<urn:uuid:own>", "sha1:OWN", "2021-02-03T04:05:06Z") if r["page_id"] == 1 else
                ("<urn:uuid:head>", "sha1:HEAD", "2020-01-01T00:00:00Z"))
            assert head["warc-ip-address"] == "10.0.0.1" and head["x-odd a"] == "b c"
    assert len(out) == 6
    assert "record" in warc.op5_warc_derivatives(spark, SF).columns


def test_temporal_lists(spark):
    rng = random.Random(8)
    hosts = ["a.com", "x.a.com", "y.x.a.com", "b.org", "ba.com"]
    entries = [(rng.choice(["l1", "l2"]), rng.choice(hosts[:4]).upper(), rng.choice([True, False, None]), rng.randrange(50))
               for _ in range(60)] + [(None, "a.com", True, 1), ("l1", None, True, 1), ("l1", "a.com", True, None)]
    captures = [(i, f"HTTP://u@{rng.choice(hosts)}:80/p?a.com", rng.randrange(-5, 60), 1) for i in range(200)]
    captures += captures[:3] + [(None, "nothing", 3, 1), (7, None, 3, 1), (8, "http://a.com", None, 1)]
    df = spark.createDataFrame(captures, "id long, url string, t long, part long").repartition(3)
    lists = spark.createDataFrame(entries, "list string, domain string, listed boolean, date long")
    state = {}
    for name, domain, on, date in entries:
        if name and domain and date is not None:
            key = (name, domain.lower(), date)
            state[key] = state.get(key, False) or bool(on)
    expected = Counter()
    for i, url, t, _ in captures:
        host = (re.match(r"https?://(?:[^/]*@)?([^/:]+)", url or "", re.I) or [None, None])[1]
        found = []
        for name in ("l1", "l2"):
            for domain in hosts if host and t is not None else ():
                if host == domain or host.endswith("." + domain):
                    dates = [d for n, x, d in state if (n, x) == (name, domain) and d <= t]
                    if dates:
                        found.append((name, state[name, domain, max(dates)]))
        on = sorted({n for n, x in found if x})
        expected[i, host, len(found), ",".join(on), bool(on)] += 1
    got = Counter(tuple(r) for r in url_lists.judged(df, lists, "id", "url", "t").collect())
    assert got == expected
    spans = url_lists.intervals(lists).collect()
    assert len(spans) == len(state) and all(r["valid_to"] is None or r["valid_from"] < r["valid_to"] for r in spans)
    assert url_lists.judged(df.limit(0), lists, "id", "url", "t").count() == 0
    assert url_lists.judged(df, lists.limit(0), "id", "url", "t").where("blocked").count() == 0


# the pipeline

def test_pipeline_against_plain_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    bench = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    assert all(r["n_chars"] == len(r["text"]) for r in docs.collect())
    ok = {r["doc_id"] for r in repetition.repetition(docs, into="q").where("q.kept").collect()}
    rows = [r for r in rows if r[0] in ok]
    first = {c for _, _, c in linked(rows, 5)}
    rows = [r for r in rows if r[0] in first]
    clean = {k[0] for k in hits(rows, bench) if not k[4]}
    out = corpus_pipeline.run(spark, SF).collect()
    assert {r["doc_id"] for r in out} == clean
    assert len(out) == len({(r["sequence_id"], r["offset"]) for r in out})


def test_pipeline_stages_take_odd_rows(spark):
    docs = [(None, None, "en", "s", 0), (1, "", "en", "s", 0), (2, "w " * 60, None, None, None)]
    docs += [(3, " ".join(f"w{i}" for i in range(70)) + " mail a@b.c", "en", "s", 5)] * 2
    docs += [(None, " ".join(f"v{i}" for i in range(60)), "en", "s", 9)]
    df = spark.createDataFrame(docs, "doc_id long, text string, lang string, source string, n_chars long")
    for frame, left in ((df, 2), (df.limit(0), 0)):
        for _, step in corpus_pipeline.STAGES[:-1]:
            frame_ = step(spark, frame, SF)
            assert frame_.columns == df.columns
            frame = frame_
        rows = frame.collect()
        assert len(rows) == left
        assert all(r["n_chars"] == len(r["text"]) and "@" not in r["text"] for r in rows)
        assert corpus_pipeline.STAGES[-1][1](spark, frame, SF).count() == left
