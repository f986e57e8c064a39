"""The corpus operators against brute force, and the cases their docstrings define."""
from __future__ import annotations

import base64
import collections
import hashlib
import random
import re
import zlib
from array import array
from pathlib import Path

import numpy as np
import public_tokenizers
import pytest
import xxhash
from pyspark.sql import functions as F

from ledgerlake.llm import (classifier, components, fingerprints, knn, lines, mixing, packing, pii, queries, runs,
                            simhash, tokens, warc)
from ledgerlake.session import ensure_checkpoint_dir

SF = "/root/testdata/sf0.001"
DOC = "doc_id bigint, text string, lang string, source string, n_chars bigint"
LONG = " ".join(f"w{i * 7919 % 4001}" for i in range(40_000))
ODD = [(1, "", "en", "b", 0), (2, None, None, None, None), (3, " \t\n", "en", "a", 3), (4, "one", "en", "a", 3),
       (4, "one", "en", "a", 3), (5, LONG, "en", "b", len(LONG)), (6, LONG + " end", "en", "b", None),
       (None, "some words without an id at all here", "en", "c", 36), (7, "ünï çode wörds ß", "de", "a", 16)]


def words_of(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


@pytest.fixture(scope="module")
def rows(docs):
    return [(r.doc_id, r.text) for r in docs.collect()]


@pytest.fixture(scope="module")
def odd(spark):
    return spark.createDataFrame(ODD, DOC).withColumns(
        {c: F.lit("x") for c in ("score", "predicted", "copies", "size", "fp", "root", "line", "_id", "rank", "value")})


class Groups:
    def __init__(self, n):
        self.p = list(range(n))

    def find(self, x):
        while self.p[x] != x:
            x = self.p[x]
        return x

    def join(self, a, b):
        a, b = self.find(a), self.find(b)
        self.p[max(a, b)] = min(a, b)


# ---- 1 quality ---------------------------------------------------------------

def test_network_gradients_match_differences():
    r = np.random.default_rng(1)
    texts = [bytes(r.integers(32, 127, n, dtype=np.uint8)) for n in (10, 300, 700)]
    ch, n = classifier.chunks_of(texts)
    assert n.tolist() == [1, 2, 4] and all(t in b"".join(bytes(x) for x in ch) or len(t) > 256 for t in texts)
    net, label, weight = classifier.Network(3), np.array([0, 1, 0], np.float32), np.array([1, 2, 1], np.float32)
    grads = net.gradients(ch, n, label, weight)

    def loss():
        p = net.scores(ch, n)
        return float((-weight * (label * np.log(p) + (1 - label) * np.log(1 - p))).mean())
    for i, at in ((0, (5, 3)), (2, (4, 2)), (3, (1,)), (4, (2,)), (5, (0,))):
        keep = net.w[i][at]
        net.w[i][at] = keep + 1e-2
        up = loss()
        net.w[i][at] = keep - 1e-2
        down = loss()
        net.w[i][at] = keep
        assert abs((up - down) / 2e-2 - grads[i][at]) < 2e-2


def test_quality_on_held_out_rows(spark):
    sf = SF.replace("0.001", "0.1")
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    got = queries.op1_quality(spark, sf).join(labels, "doc_id").where("held_out").collect()
    assert all(zlib.crc32(str(r.doc_id).encode()) % 5 == 0 for r in got) and len(got) > 500
    assert np.mean([r.predicted == r.quality for r in got]) > 0.95
    assert all(r.predicted == int(r.score >= 0.3) and 0 <= r.score <= 1 for r in got)


def test_quality_odd_rows(spark, odd):
    labels = spark.createDataFrame([(4, 1), (5, 0), (6, 0), (7, 1), (4, 0), (None, 1)], "doc_id bigint, quality int")
    model = classifier.train(odd, labels)
    kept = classifier.classify(odd, model)
    assert kept.count() == len(ODD)
    s = {(r["_row"].doc_id, r["_row"].text): r.score for r in kept.collect()}
    assert s[1, ""] == s[2, None]
    none = classifier.train(odd, labels.limit(0))
    assert classifier.keep_good(odd, none).columns == odd.columns and classifier.keep_good(odd, none).count() == len(ODD)
    assert classifier.keep_good(odd.limit(0), model).count() == 0


# ---- 2 fingerprints ------------------------------------------------------------

def test_sketch_estimates():
    r = random.Random(1)
    a = [f"w{r.randrange(10 ** 6)}" for _ in range(3000)]
    b = a[:2000] + [f"v{r.randrange(10 ** 6)}" for _ in range(1000)]
    sa, sb = (fingerprints.sketch_of(" ".join(x), 256) for x in (a, b))
    full = [set(map(int, fingerprints.shingle_hashes(" ".join(x)))) for x in (a, b)]
    assert abs(fingerprints.resemblance(sa, sb, 256) - len(full[0] & full[1]) / len(full[0] | full[1])) < 0.1
    assert abs(fingerprints.containment(sa, sb, 256) - len(full[0] & full[1]) / len(full[0])) < 0.15
    assert abs(fingerprints.distinct_count(sa, 256) / len(full[0]) - 1) < 0.2
    assert fingerprints.merge(sa, sb, 256).tolist() == sorted(full[0] | full[1])[:256]
    assert fingerprints.decode(fingerprints.encode(sa)).tolist() == sa.tolist()


def test_merged_parts_equal_whole(spark):
    parts = [" ".join(f"w{i}" for i in range(a, a + 300)) for a in (0, 200, 400)]
    df = spark.createDataFrame([(1, p) for p in parts] + [(2, "")], "g int, t string")
    got = {r.g: r.f for r in fingerprints.merge_fingerprints(
        df.select("g", fingerprints.fingerprint(F.col("t")).alias("f")), ["g"], "f").collect()}
    hashes = np.concatenate([fingerprints.shingle_hashes(p) for p in parts])
    assert got[1] == fingerprints.encode(fingerprints.bottom_k(hashes)) and got[2] == ""


def check_edited(got, texts):
    order = sorted(texts, key=lambda i: (i is not None, i or 0), reverse=True)
    assert len(got) == len(order)
    for a, b in zip(order, order[1:] + order[:1]):
        t, nxt = texts[a] or "", texts[b] or ""
        half = len(t) // 2
        edited = t[:len(t) - half] + nxt[:half]
        r = got[a]
        assert r.n_chars == len(t) and r.edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        own, new, other = (fingerprints.sketch_of(x) for x in (t, edited, nxt))
        assert (r.fingerprint, r.edited_fingerprint) == (fingerprints.encode(own), fingerprints.encode(new))
        assert (r.near_edited, r.near_next) == (fingerprints.resemblance(own, new), fingerprints.resemblance(own, other))


@pytest.mark.parametrize("per_range", [16, 4096])
def test_edited_texts(spark, docs, rows, per_range):
    got = {r.doc_id: r for r in fingerprints.compare_edited(docs, rows_per_range=per_range).collect()}
    check_edited(got, dict(rows))


def test_edited_odd_rows(spark, odd):
    unique = odd.dropDuplicates(["doc_id"])
    got = {r.doc_id: r for r in fingerprints.compare_edited(unique, rows_per_range=2).collect()}
    check_edited(got, {r[0]: r[1] for r in ODD})
    assert fingerprints.compare_edited(odd).count() == len(ODD)
    assert fingerprints.compare_edited(odd.limit(0)).count() == 0
    assert fingerprints.compare_edited(odd.where("doc_id = 7")).first().near_next == 1.0


# ---- 3 top k -------------------------------------------------------------------

def brute_top(data, asks, k):
    vecs = [(i, [int(np.floor(64.0 * float(x))) for x in v]) for i, v in data
            if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)]
    out = set()
    for q, a in {(i, tuple(v)) for i, v in vecs if asks(i)}:
        score = {(-sum(x * y for x, y in zip(a, v)), i) for i, v in vecs if i != q}
        out |= {(q, n + 1, i, -s) for n, (s, i) in enumerate(sorted(score)[:k])}
    return out


@pytest.mark.parametrize("spread", [0.05, 1.0])
def test_top_k_is_exact(spark, spread, monkeypatch):
    monkeypatch.setattr(knn, "POINTS_PER_CENTRE", 64)
    monkeypatch.setattr(knn, "BLOCK", 100)
    monkeypatch.setattr(knn, "QUERY_CHUNK", 16)
    r = np.random.default_rng(2)
    hubs = r.normal(0, 1, (6, 8))
    data = [(i, [float(x) for x in hubs[i % 6] + r.normal(0, spread, 8)]) for i in range(700)]
    data += [(1000 + i, data[7][1]) for i in range(150)]  # one vector many times
    df = spark.createDataFrame(data, "vec_id bigint, embedding array<float>")
    data = [(x.vec_id, x.embedding) for x in df.collect()]
    got = {tuple(x) for x in knn.top_k(df, F.col("vec_id") % 20 == 0, k=7).collect()}
    assert got == brute_top(data, lambda i: i % 20 == 0, 7)


def test_top_k_keeps_ties_of_very_negative_scores():
    # one-point nodes whose bounds equal the worst score: the tie with the smaller id is not pruned
    for score in (-900.0, -5000.0, -1e9):
        assert knn.with_slack(score) > score and not knn.with_slack(score) < np.float64(score)
    data = np.array([[-100.0], [-100.0], [-100.0]])
    reach = knn.with_slack(np.array([[100.0]]) @ data.T)
    assert (reach >= -10000.0).all()


def test_top_k_odd_rows(spark):
    data = [(0, [1.0, 2.0]), (0, [1.0, 2.0]), (1, None), (2, [None, 1.0]), (3, [float("nan"), 1.0]), (4, [1.0]),
            (None, [1.0, 1.0]), (20, [1e12, -1e12]), (5, [float("inf"), 0.0]), (6, [])]
    df = spark.createDataFrame(data, "vec_id bigint, embedding array<double>").withColumn("rank", F.lit(1))
    got = sorted(tuple(x) for x in knn.top_k(df, F.col("vec_id") % 20 == 0).collect() if x.query_id == 0)
    assert [(g[1], g[2]) for g in got] == [(1, 4), (2, 6), (3, 20)] and got[0][3] == 64 * 64
    assert knn.top_k(df.limit(0), F.lit(True)).count() == 0


# ---- 4 tokens --------------------------------------------------------------------

def greedy(word, vocabulary, longest):
    n = at = 0
    while at < len(word):
        end = min(len(word), at + longest)
        while word[at:end] not in vocabulary:
            end -= 1
        at, n = end, n + 1
    return n


def test_automaton_counts_greedy_pieces(spark, odd, rows):
    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    vocabulary = tokens.read_vocabulary(path)
    known, longest = set(vocabulary), max(map(len, vocabulary))
    r = random.Random(3)
    auto = tokens.LongestMatch([bytes([b]) for b in range(256)] + [b"ab", b"abc", b"abcde", b"bcd", b"cdx", b"dd"])
    small = {bytes([b]) for b in range(256)} | {b"ab", b"abc", b"abcde", b"bcd", b"cdx", b"dd"}
    for _ in range(3000):
        w = bytes(r.choice(b"abcdex") for _ in range(r.randrange(1, 14)))
        assert auto.count(w) == greedy(w, small, 5)
    counted = {r.doc_id: (r.n_words, r.n_tokens) for r in queries.op4_token_counts(spark, SF).collect()}
    for i, t in rows:
        w = words_of(t)
        assert counted[i] == (len(w), sum(greedy(b" " + x.encode(), known, longest) for x in w))
    got = [(r.doc_id, r.c.n_words) for r in odd.select("doc_id", tokens.token_counts(F.col("text"), path).alias("c")).collect()]
    assert sorted(got, key=str) == sorted(((i, len(words_of(t))) for i, t, *_ in ODD), key=str)
    assert odd.limit(0).select(tokens.token_counts(F.col("text"), path)).count() == 0
    with pytest.raises(ValueError):
        tokens.LongestMatch([b"a"])


# ---- 5 personal data ---------------------------------------------------------------

BASE = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
        "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def base_spans(t):
    out = []
    for kind, pattern in BASE.items():
        for m in re.finditer(pattern, t):
            d = [int(c) for c in m.group() if c.isdigit()]
            if kind == "ip" and any(int(p) > 255 for p in m.group().split(".")):
                continue
            if kind == "card" and not (13 <= len(d) <= 19 and sum(
                    x if i % 2 == 0 else sum(divmod(2 * x, 10)) for i, x in enumerate(reversed(d))) % 10 == 0):
                continue
            if kind == "phone" and not 9 <= len(d) <= 15:
                continue
            out.append((kind, m.start(), m.end()))
    return out


def test_base_spans_equal_plain_patterns(rows):
    r = random.Random(4)
    made = ["".join(r.choice("a1.@ +-(29 é4") for _ in range(r.randrange(60))) for _ in range(4000)]
    made += ["a@b@c.com x.y@z.com@w.org", "1.2.3.4.5.6.7.8", "0001.2.3.255", "4111 1111-1111 1111", "+49 (30) 1234-567 ",
             "9" * 4000 + ".1.1.1"]
    for t in made + [t for _, t in rows]:
        assert [s[:3] for s in pii.find_spans(t) if s[0] in pii.BASE_KINDS] == base_spans(t)


def test_added_kinds_and_scores():
    t = "pay to IBAN DE89 3704 0044 0532 0130 00 or DE89 3704 0044 0532 0130 01; ssn 123-45-6789, 987-65-4321"
    found = [(k, t[a:b]) for k, a, b, _ in pii.find_spans(t) if k not in pii.BASE_KINDS]
    assert found == [("iban", "DE89 3704 0044 0532 0130 00"), ("ssn", "123-45-6789")]
    assert not pii.find_spans("number 123-45-6789") and pii.find_spans("ssn 123-45-6789")
    plain, near = pii.find_spans("x a@b.co")[0], pii.find_spans("mail a@b.co")[0]
    assert near[3] > plain[3]
    assert pii.find_spans("1" * 200_000) == [] and pii.find_spans("a" * 200_000 + "@") == []


def test_pii_rows(spark, odd):
    got = odd.select("doc_id", pii.pii_summary(F.col("text")).alias("s"), pii.pii_spans(F.col("text")).alias("p")).collect()
    assert len(got) == len(ODD) and all(r.s.base_sha256 == hashlib.sha256(b"").hexdigest() and r.p == [] for r in got)
    assert pii.redact(odd, "text").count() == len(ODD)
    one = spark.createDataFrame([("call +49 30 1234567 or a@b.co",), (None,)], "text string")
    assert [r.text for r in pii.redact(one).collect()] == ["call <phone> or <email>", None]
    assert odd.limit(0).select(pii.pii_summary(F.col("text"))).count() == 0


# ---- 6 packing -----------------------------------------------------------------------

def check_packed(got, texts):
    from tokenizers import Tokenizer
    tok = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    want = collections.Counter()
    for i, t in texts:
        ids = tok.encode(t or "", add_special_tokens=False).ids + [0]
        for n, s in enumerate(range(0, len(ids), 2048)):
            want[i, n, s, len(ids[s:s + 2048]), zlib.crc32(array("I", ids[s:s + 2048]).tobytes())] += 1
    assert collections.Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in got) == want
    by = collections.defaultdict(list)
    for r in got:
        by[r.sequence_id].append((r.offset, r.length))
    for places in by.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= 2048
    return len(by), -(-sum(r.length for r in got) // 2048)


def test_packing(spark, rows, odd):
    used, bound = check_packed(queries.op6_packing(spark, SF).collect(), rows)
    assert used <= bound + 1
    path = public_tokenizers.path("word_bpe_49k.json")
    strange = spark.createDataFrame([(50, "<|endoftext|> Ω İ ½ ² \x1c x y ＡＢ 'S don't it'll 12.5 é é", None, None, 1)], DOC)
    texts = [(r[0], r[1]) for r in ODD] + [(r.doc_id, r.text) for r in strange.collect()]
    check_packed(packing.pack(odd.select("doc_id", "text").union(strange.select("doc_id", "text")), path).collect(), texts)
    assert packing.pack(odd.limit(0), path).count() == 0


def test_plans_are_whole_and_near_optimal():
    for seed in range(8):
        r = random.Random(seed)
        low, high = ((1, 2048), (300, 700), (680, 760), (500, 1025), (1, 60), (1000, 1100), (600, 1448), (2048, 2048))[seed]
        h = collections.Counter(r.randint(low, high) for _ in range(600))
        plan = packing.plan_packing(h, max_nodes=600)
        used = collections.Counter()
        for filling, times in plan:
            assert sum(filling) <= 2048 and times > 0
            for x in filling:
                used[x] += times
        assert used == h
        assert sum(t for _, t in plan) <= sum(t for _, t in packing.best_fit(h, 2048))
    # best fit needs three sequences here, bin completion two
    tricky = {6: 1, 5: 1, 4: 2, 3: 1, 2: 1}
    assert sum(t for _, t in packing.plan_packing(tricky, 12)) == 2
    assert packing.plan_packing({}) == []
    assert packing.dominates((6,), (3, 3)) and packing.dominates((5, 4), (3, 2, 4)) and not packing.dominates((3, 3), (4,))


# ---- 7 WARC ---------------------------------------------------------------------------

def test_warc_round_trip(spark):
    html = [(1, "u", "a\r\n\r\nWARC/1.0 x"), (2, "u\r\nX: y", "a\r\n\r\nWARC/1.0 x"), (3, "é", "x" * 300_000), (4, None, None),
            (5, "u", ""), (9, "u", "ü"), (8, "u", "ü"), (7, "u", "ü")]
    df = spark.createDataFrame(html, "page_id bigint, url string, html string").withColumn("payload", F.lit(1))
    got = {r.page_id: r for r in warc.round_trip(df).collect()}
    first = {}
    for i, _, h in sorted(html):
        first.setdefault(h or "", i)
    assert len(got) == len(html)
    for i, _, h in html:
        b = (h or "").encode()
        own = first[h or ""] == i
        assert (got[i].payload_bytes, got[i].payload_digest) == (len(b), base64.b32encode(hashlib.sha1(b).digest()).decode())
        assert (got[i].record_type, got[i].refers_to) == (("response", None) if own else ("revisit", first[h or ""]))
        assert got[i].has_request
    assert warc.round_trip(df.limit(0)).count() == 0
    again = df.where("page_id in (4, 5)").union(df.where("page_id = 5")).union(df.where("page_id = 5").withColumn("page_id", F.lit(None)))
    kinds = sorted((str(r.page_id), r.record_type, r.refers_to) for r in warc.round_trip(again).collect())
    assert kinds == [("4", "response", None), ("5", "revisit", 4), ("5", "revisit", 4), ("None", "revisit", 4)]


def test_warc_small_payloads_and_blocks(spark, tmp_path):
    df = spark.createDataFrame([(1, "u", "ab"), (2, "u", "ab"), (3, "u", "abc"), (4, "u", "abc")], "page_id int, url string, html string")
    captures, size = warc.plan_captures(df, min_payload=3)
    assert {r.page_id: r.record_type for r in captures.collect()} == {1: "response", 2: "response", 3: "response", 4: "revisit"}
    warc.write_archives(captures, str(tmp_path / "w"), size)
    nested = warc.assemble(warc.read_archives(spark, str(tmp_path / "w"))).collect()
    assert len(nested) == 4
    assert all(r.request.record_type == "request" and len(r.metadata) == 1 and r.capture.block.startswith(b"HTTP/1.1 200") for r in nested)


# ---- runs of equal keys ---------------------------------------------------------------

def test_compare_runs_meets_every_pair(spark, monkeypatch):
    other_side = runs.other_side

    def all_pairs(cols, starts):
        """Every pair of a run that is not all on one side."""
        a, b = [], []
        for s, e in zip(starts, np.append(starts[1:], len(cols["id"]))):
            i, j = np.triu_indices(e - s, 1)
            side = other_side(cols, s, e)
            use = np.ones(len(i), bool) if side is None else side[i] != side[j]
            a.append(cols["id"][s:e][i[use]])
            b.append(cols["id"][s:e][j[use]])
        return np.concatenate(a), np.concatenate(b)

    monkeypatch.setattr(runs, "LIMIT", 8)
    monkeypatch.setattr(runs, "BLOCK", 4)
    # runs that end within a batch, span batches, and end their partition; one partition and several
    lengths = [1, 3, 8, 9, 11, 12, 13, 25, 2, 40, 16, 17, 5, 23, 10]
    keys = [k for k, n in enumerate(lengths) for _ in range(n)]
    want = {(i, j) for j in range(len(keys)) for i in range(j) if keys[i] == keys[j]}
    df = spark.createDataFrame(list(zip(keys, range(len(keys)))), "key bigint, id bigint")
    for batch, parts in ((7, 1), (10, 1), (30, 3)):
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", batch)
        try:
            got = runs.compare_runs(df, ["key"], all_pairs, parts).collect()
        finally:
            spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
        assert {(min(r), max(r)) for r in got} == want


# ---- 8 lines ---------------------------------------------------------------------------

def edit_table(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a):
        prev, row[0] = row[0], i + 1
        for j, y in enumerate(b):
            prev, row[j + 1] = row[j + 1], min(row[j + 1] + 1, row[j] + 1, prev + (x != y))
    return row[-1]


def test_edit_distance():
    r = random.Random(5)
    for _ in range(500):
        a, b = (bytes(r.choice(b"abc") for _ in range(r.randrange(0, 90))) for _ in "ab")
        assert lines.edit_distance(a, b) == edit_table(a, b)


def plain_line(x):
    """A line as it is compared, and whether it is long enough to be compared with others."""
    low = "".join("0" if "0" <= c <= "9" else c for c in x.lower() if not ("!" <= c <= "~" and not c.isalnum()))
    low = b" ".join(low.encode().split()).decode()
    return (low, True) if len(low) >= lines.MIN_CHARS else (x.strip(), False)


def brute_lines(texts):
    """Every pair of different lines by edit distance alone, but for those their letter counts rule out."""
    occ = collections.defaultdict(list)
    for i, t in sorted(set(texts), key=lambda x: (x[0] is not None, x[0] or 0)):
        for k, x in enumerate((t or "").split("\n")):
            if plain_line(x)[0]:
                occ[plain_line(x)].append(((i is not None, i or 0), k))
    keys = list(occ)
    g = Groups(len(keys))
    order = sorted((i for i, k in enumerate(keys) if k[1]), key=lambda i: len(keys[i][0]))
    size = np.array([len(keys[i][0]) for i in order])
    letters = np.array([np.bincount([ord(c) % 128 for c in keys[i][0]], minlength=128) for i in order], np.int16)
    for at, i in enumerate(order):
        end = np.searchsorted(size, size[at] / 0.8, "right")
        common = np.minimum(letters[at], letters[at + 1:end]).sum(1)
        for k in np.flatnonzero(size[at + 1:end] - common <= 0.2 * size[at + 1:end]) + at + 1:
            j = order[k]
            if g.find(i) != g.find(j) and lines.similar(keys[i][0], keys[j][0]):
                g.join(i, j)
    groups = collections.defaultdict(list)
    for i, k in enumerate(keys):
        groups[g.find(i)] += occ[k]
    drop = {x for o in groups.values() for x in sorted(o)[1:]}
    return {(i, t): t if t is None else "\n".join(
        x for k, x in enumerate(t.split("\n")) if ((i is not None, i or 0), k) not in drop) for i, t in texts}


def test_line_dedup(spark, docs, rows, monkeypatch):
    r = random.Random(6)
    base = " ".join(f"word{r.randrange(900)}" for _ in range(60))
    near = [(10_000 + i, f"{base} {i}\nshort\n{base.upper()}!") for i in range(5)]
    near += [(20_000 + i, base.replace("word1", "wurd1", i % 3 + 1)) for i in range(4)]
    df = docs.select("doc_id", "text").union(spark.createDataFrame(near, "doc_id bigint, text string"))
    want = brute_lines(rows + near)
    for limit in (2048, 4):  # the second compares block by block
        monkeypatch.setattr(runs, "LIMIT", limit)
        monkeypatch.setattr(runs, "BLOCK", limit // 2)
        got = {r["_row"].doc_id: r.text for r in lines.with_dropped(df).collect()}
        assert got == {i: t for (i, _), t in want.items()}


def test_line_dedup_finds_changed_words(spark):
    r = random.Random(16)
    word = lambda: "".join(r.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(r.choice((2, 3, 3, 4, 5, 6, 7, 8, 9, 10))))
    common = ["the", "of", "and", "to", "in"]
    texts, want = [], []
    for n, changed in ((8, 1), (12, 1), (20, 1), (20, 2), (40, 2), (100, 5), (200, 4)):
        for _ in range(200):
            a = [r.choice(common) if r.random() < 0.4 else word() for _ in range(n)]
            b = list(a)
            for i in r.sample([i for i, w in enumerate(a) if w not in common], changed):
                b[i] = word()
            pair = [" ".join(x).encode() for x in (a, b)]
            if min(map(len, pair)) >= lines.MIN_CHARS and lines.similar(*pair):  # what an all-pairs check finds
                want.append((n, changed, len(texts) + 1))
                texts += [x.decode() for x in pair]
    han = [chr(0x4E00 + r.randrange(3000)) for _ in range(40)]
    texts += ["".join(han), "".join(han[:20] + ["山"] + han[21:])]
    got = {x["_row"].doc_id: x.n_dropped for x in lines.with_dropped(
        spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")).collect()}
    assert got[len(texts) - 1] == 1 and sum(got.values()) <= len(want) + 1
    for n, changed in {x[:2] for x in want}:
        found = [got[i] for a, b, i in want if (a, b) == (n, changed)]
        assert sum(found) >= 0.9 * len(found), (n, changed, sum(found), len(found))


def test_edits_by_words_bound_the_edit_distance():
    r = random.Random(7)
    for _ in range(300):
        a = [r.choice(("ab", "abc", "b", "cab")) for _ in range(r.randrange(1, 12))]
        b = [w if r.random() < 0.8 else r.choice(("c", "ab", "bb")) for w in a if r.random() < 0.9] or ["a"]
        assert lines.edits_by_words(a, b, 10**9) >= lines.edit_distance(" ".join(a), " ".join(b))
    a = "one two three four five six".split()
    assert lines.edits_by_words(a, a, 1) == 0 and lines.edits_by_words(a, a[:2] + a[3:], 9) == 6
    assert lines.edits_by_words(a, a[:3] + ["x"] + a[3:], 9) == 2


def test_line_dedup_compares_near_lines_only_and_leaves_nothing(spark, tmp_path):
    r = random.Random(17)
    letters = lambda n: "".join(r.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(n))
    common = [letters(7) for _ in range(30)]  # two fifths of every line: SimHashes come within MAX_BITS by chance

    def line():
        return " ".join(r.choice(common) if r.random() < 0.4 else letters(6) for _ in range(80))
    base = [line() for _ in range(120)]
    norm = [lines.normalised_lines(x)[0] for x in base]
    wide, sim = lines.wide_hashes(norm), lines.sketches(norm, np.array([len(x) for x in norm]))[0]
    i, j = np.triu_indices(len(base), 1)
    near = np.bitwise_count(sim[i] ^ sim[j]) <= lines.MAX_BITS
    both = near & (np.bitwise_count(wide[i] ^ wide[j]).sum(1) <= lines.MAX_WIDE_BITS)
    assert near.sum() > 500 and both.sum() < 0.2 * near.sum()
    texts = [(k, x) for k, x in enumerate(base)] + [(500 + k, f"{base[0]} {chr(97 + k % 26) * (1 + k // 26)}") for k in range(40)]
    root = Path(ensure_checkpoint_dir(spark).removeprefix("file:"))
    before = set(root.glob("llm-*"))
    df = spark.createDataFrame(texts, "doc_id bigint, text string")
    got = {x["_row"].doc_id: x.n_dropped for x in lines.with_dropped(df).collect()}
    assert [got[500 + k] for k in range(40)] == [1] * 40 and sum(got[k] for k in range(120)) == 0
    assert len(set(root.glob("llm-*")) - before) <= 4  # the result, and groups that hold two numbers a line


def test_runs_of_crowded_keys_and_columns_named_n(spark, monkeypatch):
    monkeypatch.setattr(runs, "LIMIT", 4)
    monkeypatch.setattr(runs, "BLOCK", 2)
    df = spark.range(30).select((F.col("id") % 3).alias("key"), F.col("id").alias("h"), F.lit(1).alias("n"))
    df = df.where("key < 2 or id < 7")  # 10, 10 and 2 rows

    def chain(cols, starts):
        return cols["h"][1:], cols["h"][:-1]
    all_rows = runs.compare_runs(df, ["key"], chain, 2, crowded=lambda cols: (cols["key"], cols["h"])).collect()
    assert {(r[0], r[1]) for r in all_rows} >= {(k, h) for k in (0, 1) for h in range(k, 30, 3)}
    assert len(all_rows) in (21, 22)
    assert runs.compare_runs(df, ["key"], lambda cols, starts: (cols["h"], cols["h"]), 2).distinct().count() == 22


def test_line_dedup_odd_rows(spark, odd):
    out = lines.dedup_lines(odd)
    assert out.columns == odd.columns and out.count() == len(ODD)
    # equal lines within a text: the first stays; equal rows count as one
    t = "a line that is long enough to be counted\nx\nA line that is long enough, to be counted!"
    df = spark.createDataFrame([(1, t), (1, t), (None, t)], "doc_id bigint, text string")
    got = sorted((str(r.doc_id), r.text) for r in lines.dedup_lines(df).collect())
    assert got == [("1", ""), ("1", ""), ("None", t.split("\n")[0] + "\nx")]
    # short lines: exact repeats only, white space at the ends aside; blank lines stay
    short = [(1, "Share this\n\n1."), (2, " Share this \n\n2."), (3, "share this\n \n1.")]
    got = {r.doc_id: r.text for r in lines.dedup_lines(spark.createDataFrame(short, "doc_id bigint, text string")).collect()}
    assert got == {1: short[0][1], 2: "\n2.", 3: "share this\n "}
    assert lines.dedup_lines(odd.limit(0)).count() == 0


# ---- 9 mixing ---------------------------------------------------------------------------

def brute_targets(sizes, share=1.5, top=2.0):
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    w = {s: (5, 2, 1)[i % 3] for i, s in enumerate(order)}
    target, open_, left = {}, set(order), share * sum(sizes.values())
    while open_:
        total = sum(w[s] for s in open_)
        over = {s for s in open_ if left * w[s] / total > top * sizes[s]}
        if not over:
            return target | {s: left * w[s] / total for s in open_}
        for s in over:
            target[s] = top * sizes[s]
        left -= sum(target[s] for s in over)
        open_ -= over
    return target


@pytest.mark.parametrize("seed", range(4))
def test_mix_targets(spark, seed):
    r = random.Random(seed)
    sizes = {f"s{i}": r.choice([0, 1, 10, 200, 5000]) for i in range(12)} | {None: 30}
    df = spark.createDataFrame([(i, s, n) for i, (s, n) in enumerate(sizes.items())], "doc_id long, source string, n long")
    got = {r._mx_source: r.target for r in mixing.source_targets(df, F.col("n"))[0].collect()}
    want = brute_targets(sizes)
    assert got.keys() == want.keys() and all(abs(got[s] - want[s]) < 1e-6 for s in want)


def test_mix_copies(spark, odd):
    out = mixing.mix_sources(odd)
    assert out.columns == odd.columns
    counted = mixing.with_copies(odd.select("doc_id", "source", "text")).collect()
    assert len(counted) == len(ODD) and sum(r.copies for r in counted) == out.count()
    assert all(0 <= r.copies <= 2 for r in counted)
    assert mixing.mix_sources(odd.limit(0)).count() == 0
    many = spark.range(4000).select(F.col("id").alias("doc_id"), F.when(F.col("id") % 3 == 0, "a").otherwise("b").alias("source"),
                                    F.lit("five words in each text").alias("text"))
    first, second = ({r.doc_id: r.copies for r in mixing.with_copies(many).collect()} for _ in "ab")
    assert first == second
    per = mixing.with_copies(many).groupBy("source", "target").agg(F.sum(F.col("copies") * 5).alias("t")).collect()
    assert all(abs(r.t / r.target - 1) < 0.05 for r in per)


# ---- 10 SimHash ---------------------------------------------------------------------------

def plain_simhash(text):
    w = words_of("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    if not w:
        return 0
    parts = [" ".join(w[i:i + 3]) for i in range(len(w) - 2)] or [" ".join(w)]
    ones = [0] * 64
    for s in parts:
        h = xxhash.xxh64_intdigest(s.encode(), 42)
        for k in range(64):
            ones[k] += h >> k & 1
    return sum(1 << k for k in range(64) if 2 * ones[k] > len(parts))


def test_simhash_values(spark, rows):
    for _, t in rows + [(0, x) for x in ("", None, " ", "A", "a B", "É é X y", "a a a a a")]:
        assert simhash.simhash(t) == plain_simhash(t)
    one = spark.createDataFrame([("Some words here",)], "t string")
    assert one.select(F.xxhash64(F.lit("some words here")), simhash.fingerprint(F.col("t"))).first()[0] == \
        one.select(simhash.fingerprint(F.col("t"))).first()[0]


@pytest.mark.parametrize("max_bits", [0, 1, 3, 4, 5])
def test_anchors_cover(max_bits):
    """Any two values within the threshold in all have a piece where one's home is an anchor of the other."""
    r = np.random.default_rng(max_bits)
    x = r.integers(0, 2 ** 63, 300, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    y = x.copy()
    for i in range(len(y)):
        for b in r.choice(64, max_bits, replace=False):
            y[i] ^= np.uint64(1) << np.uint64(b)
    met = np.zeros(len(x), bool)
    for at, width in simhash.pieces_of(max_bits):
        mask = np.uint64((1 << width) - 1)
        a, b = ((v >> np.uint64(at)) & mask for v in (x, y))
        home, near = simhash.anchors_of(a, width)[:, :1], simhash.anchors_of(b, width)
        assert (np.bitwise_count(home[:, 0] ^ a) <= 1).all() and (np.bitwise_count(near ^ b[:, None]) <= 2).all()
        met |= (home == near).any(1)
    assert met.all()


def brute_groups(texts, max_bits=3):
    fp = np.array([simhash.simhash(t) for _, t in texts], np.uint64)
    g = Groups(len(fp))
    for i in range(len(fp)):
        for j in np.flatnonzero(np.bitwise_count(fp[i + 1:] ^ fp[i]) <= max_bits) + i + 1:
            g.join(i, int(j))
    low = collections.defaultdict(list)
    for i, (d, _) in enumerate(texts):
        low[g.find(i)] += [] if d is None else [d]
    return sorted((str(d), f"{int(fp[i]):016x}", str(min(low[g.find(i)], default=None))) for i, (d, _) in enumerate(texts))


def test_simhash_groups(spark, docs, rows, odd, monkeypatch):
    r = random.Random(8)
    base = [f"w{r.randrange(5000)}" for _ in range(400)]
    near = [(5000 + i, " ".join(base[:i] + ["new"] + base[i + 1:])) for i in range(0, 60)]
    df = docs.select("doc_id", "text").union(spark.createDataFrame(near, "doc_id bigint, text string")).union(
        odd.select(F.col("doc_id") + 10 ** 6, "text"))
    want = brute_groups(rows + near + [(r[0] and r[0] + 10 ** 6, r[1]) for r in ODD])
    for limit in (2048, 4):  # the second compares block by block
        monkeypatch.setattr(runs, "LIMIT", limit)
        monkeypatch.setattr(runs, "BLOCK", limit // 2)
        got = simhash.group_documents(df).select("doc_id", simhash.hex_fingerprint(F.col("fp")), "component_id").collect()
        assert sorted((str(a), b, str(c)) for a, b, c in got) == want
    kept = simhash.keep_one_each(df)
    assert sorted(str(r.doc_id) for r in kept.collect()) == sorted({c for _, _, c in want})
    assert simhash.keep_one_each(odd).columns == odd.columns
    assert simhash.group_documents(odd.limit(0)).count() == 0 and simhash.keep_one_each(odd.limit(0)).count() == 0


def test_components(spark):
    r = random.Random(9)
    edges = [(r.randrange(300), r.randrange(300)) for _ in range(220)] + [(i, i + 1) for i in range(1000, 1064)] + [(7, 7)]
    g = Groups(2000)
    for a, b in edges:
        g.join(a, b)
    want = {x: g.find(x) for a, b in edges if a != b for x in (a, b)}
    got = components.connected_components(spark.createDataFrame(edges, "a long, b long"))
    assert {r.node: r.root for r in got.collect()} == want
    assert components.connected_components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_scores_equal_a_plain_forward_pass():
    """One byte window, one filter, one chunk at a time, in plain loops over the network's own weights."""
    r = np.random.default_rng(5)
    texts = [b"", b"short text.", bytes(r.integers(1, 255, classifier.CHUNK + 3, dtype=np.uint8)),
             bytes(r.integers(32, 127, 2 * classifier.CHUNK + classifier.HOP, dtype=np.uint8))]
    net = classifier.Network(9)
    net.w[1] = r.normal(0, 0.2, len(net.w[1])).astype(np.float32)
    w, b, v, c, u, d = (x.astype(np.float64) for x in net.w)
    want = []
    for t in texts:
        best = None
        start = 0
        while best is None or start + classifier.CHUNK - classifier.HOP < len(t):
            chunk = t[start:start + classifier.CHUNK].ljust(classifier.CHUNK, b"\0")
            pooled = None
            for p in range(0, classifier.CHUNK - classifier.WIDTH + 1, classifier.STRIDE):
                seen = np.concatenate([classifier._BYTES[x] for x in chunk[p:p + classifier.WIDTH]]).astype(np.float64)
                y = np.array([sum(seen * w[:, k]) for k in range(w.shape[1])])
                pooled = y if pooled is None else np.maximum(pooled, y)
            hidden = np.maximum(np.maximum(pooled + b, 0) @ v + c, 0)
            best = hidden if best is None else np.maximum(best, hidden)
            start += classifier.HOP
        want.append(1 / (1 + np.exp(-(best @ u + d[0]))))
    assert np.allclose(net.scores(*classifier.chunks_of(texts)), want, atol=1e-4)
