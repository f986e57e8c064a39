"""Operators 11 to 13 against brute force, and the cases their docstrings define."""
from __future__ import annotations

import collections
import functools
import hashlib
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerlake.llm import contamination, negatives, queries, repair

SF = "/root/testdata/sf0.001"


# ---- 11 conversation repair --------------------------------------------------------

def damage(rows):
    out = []
    for conv, turn, role, text in rows:
        role, text = " " if role is None else role, " " if text is None else text
        k = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        if k == 0:
            continue
        if k == 1:
            text = ""
        if k == 2:
            text = re.sub("[.!?]", "", text)
        if k == 4:
            role = "user"
        out += [(conv, turn, role, text)] * (2 if k == 3 else 1)
    return out


def brute_repair(rows):
    """Faults of a conversation, and the best of all its edits by plain recursion over (row, last role, insertions there)."""
    rows = sorted(rows, key=lambda r: (r[1] is not None, r[1] or 0, r[2], r[3]))
    turns = [r[1] for r in rows if r[1] is not None]
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    faults, seen = [], set()
    for _, _, role, text in rows:
        kept = re.sub(r"[\x20\x09-\x0D]+$", "", text)
        f = ("blank" if not re.search(r"[^\x20\x09-\x0D]", text) else "duplicate" if (role, text) in seen
             else "truncated" if kept[-1] not in ".!?" else None)
        faults.append(f)
        seen.add((role, text))
    starts = [r[2][:1] for r in rows]
    illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(starts, starts[1:]))

    @functools.cache
    def plain(i, last, inserted):
        ways = []
        if i == len(rows):
            if last in ("", "a"):
                ways.append((0, "", ()))
        else:
            c, a, t = plain(i + 1, last, 0)
            ways.append((c + 3, "D" + a, t))
            if faults[i] not in ("blank", "duplicate"):
                late = faults[i] == "truncated"
                _, _, role, text = rows[i]
                if role and last + role[0] in ("s", "u", "su", "ua", "au"):
                    c, a, t = plain(i + 1, role[0], 0)
                    ways.append((c + late, "K" + a, ((role, text), *t)))
                new = "assistant" if last == "u" else "user"
                c, a, t = plain(i + 1, new[0], 0)
                ways.append((c + 2 + late, "R" + a, ((new, text), *t)))
        if inserted < 3:  # three insertions in a row never pay
            new = "assistant" if last == "u" else "user"
            c, a, t = plain(i, new[0], inserted + 1)
            ways.append((c + 2, "I" + a, ((new, ""), *t)))
        return min(ways, key=lambda w: w[:2]) if ways else (10 ** 9, "", ())
    cost, audit, made = plain(0, "", 0)
    text = "\n".join(f"{r}:{t}" for r, t in made)
    n = collections.Counter(faults)
    return gaps, n["blank"], n["duplicate"], n["truncated"], illegal, cost, audit, hashlib.sha256(text.encode()).hexdigest()


NAMES = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]


def by_conv(rows):
    out = collections.defaultdict(list)
    for r in rows:
        out[r[0]].append(r)
    return out


def test_repair_query_equals_brute_force(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    left = by_conv(damage(rows))
    want = {c: brute_repair(left.get(c, [])) for c in {r[0] for r in rows}}
    got = {r.conv_id: tuple(r[n] for n in NAMES) for r in queries.op11_conversation_repair(spark, SF).collect()}
    assert got == want and any(w[5] for w in want.values())


def random_rows(seed, convs, most):
    r = random.Random(seed)
    texts = ["One.", "Two!", "cut", "", " \t", "Three?  ", "Four. \n", "cut "]
    roles = ["user", "assistant", "system", "user", "assistant", "tool", "", "User", None]
    return [(c, r.choice([None, i, i, i + 1]), r.choice(roles), r.choice([*texts, None, f"t{i}.", f"u{i}!"]))
            for c in [*range(convs), None] for i in range(r.randint(1, most))]


@pytest.mark.parametrize("chunk", [512, 3])
def test_repair_of_random_rows(spark, chunk):
    rows = random_rows(5, 60, 12)
    df = spark.createDataFrame([(*r, "x") for r in rows], "conv_id bigint, turn bigint, role string, text string, pos string")
    report, repaired = repair.repair(df, chunk=chunk)
    got = {r.conv_id: tuple(r[n] for n in NAMES) for r in report.collect()}
    clean = [(c, t, " " if o is None else o, " " if x is None else x) for c, t, o, x in rows]
    assert got == {c: brute_repair(v) for c, v in by_conv(clean).items()}
    kept = by_conv(sorted(((r.conv_id, r.seq, r.edit, r.role, r.text) for r in repaired.collect() if r.edit != "D"),
                          key=lambda r: (r[0] is not None, r[0] or 0, r[1])))
    for c, lines in kept.items():
        assert re.fullmatch("(s?(ua)+)?", "".join(x[3][0] for x in lines))
        assert hashlib.sha256("\n".join(f"{x[3]}:{x[4]}" for x in lines).encode()).hexdigest() == got[c][-1]


def test_repair_of_one_long_conversation(spark):
    r = random.Random(3)
    rows = [(1, i, r.choice(["user", "assistant", "user", "assistant", "system"]), r.choice([f"t{i}.", f"t{i}", "same."])) for i in range(1500)]
    df = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string")
    got, whole = (repair.repair(df, chunk=c)[0].collect() for c in (64, 10 ** 6))
    assert got == whole and len(got) == 1
    codes = "".join("x" if t == "same." and (o, t) in {x[2:] for x in rows[:i]} else o[0].upper() if t[-1] != "." else o[0]
                    for i, (_, _, o, t) in enumerate(rows))
    assert repair.lightest(codes) == (got[0].cost, got[0].audit)


def test_repair_empty_and_all_deleted(spark):
    schema = "conv_id string, turn int, role string, text string"
    assert repair.repair(spark.createDataFrame([], schema))[0].count() == 0
    one = repair.repair(spark.createDataFrame([("c", None, "user", " ")], schema))[0].collect()
    assert tuple(one[0]) == ("c", 0, 1, 0, 0, 0, 3, "D", hashlib.sha256(b"").hexdigest())


# ---- 12 hard negatives -------------------------------------------------------------

def brute_mine(rows, anchors):
    rows = list({(i, lab, v): (i, lab, v) for i, lab, v in rows}.values())
    out = []
    for a, la, va in rows:
        if not anchors(a):
            continue
        scored = sorted((-sum(x * y for x, y in zip(va, v)), i, lab) for i, lab, v in rows if i != a)
        for s, p, _ in [x for x in scored if x[2] == la][:5]:
            fit = [(t, i) for t, i, lab in scored if lab != la and 30 * -s <= 100 * -t <= 90 * -s][:10]
            out += [(a, p, n + 1, i, -s, -t) for n, (t, i) in enumerate(fit)]
    return sorted(out)


def mined(df):
    return sorted(tuple(r) for r in df.collect())


@pytest.mark.parametrize("slab_bytes", [negatives.SLAB_BYTES, 400])
def test_mining_equals_brute_force(spark, monkeypatch, slab_bytes):
    r = random.Random(2)
    rows = [(i // 2 * 2 if i % 9 == 0 else i, r.choice([0, 1, 1, 1, 2]), tuple(r.randint(-3, 3) for _ in range(4))) for i in range(240)]
    rows += rows[:30] + [(i, 1, (2, 2, 2, 2)) for i in range(300, 330)]
    df = spark.createDataFrame([(i, lab, [x / 256 for x in v], 1) for i, lab, v in rows], "vec_id bigint, label int, embedding array<double>, rank int")
    odd = spark.createDataFrame([(1000, None, [0.1], 1), (1010, 1, None, 1), (1020, 1, [None], 1), (None, 1, [0.5], 1),
                                 (1030, 1, [float("nan")], 1), (1040, 1, [float("-inf")], 1)], df.schema)
    monkeypatch.setattr(negatives, "BLOCK_BYTES", 600)
    got = mined(negatives.mine(df.union(odd), F.col("vec_id") % 30 == 0, F.col("label"), slab_bytes=slab_bytes))
    want = brute_mine(rows, lambda i: i % 30 == 0)
    assert got == want and len(want) > 100


def test_fields_of_every_width():
    r = np.random.default_rng(1)
    for top, width in ((200, 4), (2 ** 20, 8), (2 ** 40, None)):
        f = negatives.Fields(top, 6)
        assert width is None or f.width == width
        v = r.integers(-top, top, (37, 6), endpoint=True)
        v[0], v[1] = top, -top
        wide, lifts = f.wide(f.pack(v), 37), f.lifts(37)
        for a in v[:5]:
            want = [sum(int(x) * int(y) for x, y in zip(a, c)) for c in v]
            assert [int(s) for s in f.scores(a.tolist(), wide, lifts, 37)] == want


def test_mining_of_huge_components(spark):
    rows = [(i, i % 2, (i * 2 ** 35, (7 - i) * 2 ** 36)) for i in range(12)]
    df = spark.createDataFrame([(i, lab, [x / 256 for x in v]) for i, lab, v in rows], "vec_id bigint, label int, embedding array<double>")
    want = [(*x[:4], *(max(-2 ** 63, min(2 ** 63 - 1, s)) for s in x[4:])) for x in brute_mine(rows, lambda i: True)]
    fits = {x for x in want if abs(x[4]) < 2 ** 62}
    assert fits <= set(mined(negatives.mine(df, F.lit(True), F.col("label"))))


def test_mining_of_empty_tables(spark):
    empty = spark.createDataFrame([], "vec_id bigint, label int, embedding array<float>")
    assert negatives.mine(empty, F.lit(True), F.col("label")).count() == 0
    one = spark.createDataFrame([(0, 1, [0.5])], empty.schema)
    assert negatives.mine(one, F.lit(True), F.col("label")).count() == 0
    assert negatives.mine(one, F.lit(None).cast("boolean"), F.col("label")).count() == 0


# ---- 13 benchmark decontamination ---------------------------------------------------

def low_words(text):
    text = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", text)


def brute_contaminated(docs, items, containment=1.0):
    windows = collections.defaultdict(set)
    for i, t in items:
        w = low_words(t)
        n = min(10, len(w))
        for s in range(len(w) - n + 1 if n else 0):
            windows[tuple(w[s:s + n])].add("" if i is None else str(i))
    out = []
    for i, t in docs:
        w, hit, own = low_words(t), set(), set()
        if containment == 1:  # the same by a look at every run of the document's words
            for n in {len(x) for x in windows}:
                for s in range(len(w) - n + 1):
                    if tuple(w[s:s + n]) in windows:
                        hit |= set(range(s, s + n))
                        own |= windows[tuple(w[s:s + n])]
        for span, names in windows.items() if containment < 1 else ():
            g = min(5, len(span))
            n = len(span) - g + 1
            for s in range(len(w) - len(span) + 1):
                same = sum(tuple(w[s + k:s + k + g]) == span[k:k + g] for k in range(n))
                if same >= max(1, -int(-containment * n // 1)):
                    hit |= set(range(s, s + len(span)))
                    own |= names
        out.append((i, len(w), len(hit), sorted(own)))
    return out


ITEMS = [(1, "One two three four five six seven eight nine ten eleven twelve"), (2, "short item HERE"), (3, None), (4, "..."),
         (5, "a a a a a a a a a a a a a"), (None, "ünï çode wörds ß and Ünï"), (10, "one two three four five six seven eight nine ten"),
         (1, "the same id with another text of more than ten words in all")]
LONG = " ".join(f"w{i % 977}" for i in range(3_000))
DOCS = [(1, "x one Two, three-four five.six seven eight nine TEN eleven y"), (2, "short item here short item here now"), (3, ""), (4, None),
        (5, "b " + "a " * 17 + "b"), (6, LONG + " ONE two three four five six seven eight nine ten " + LONG), (None, "ünï çode wörds ß and Ünï"),
        (6, "short item here"), (7, "one two three four five six seven eight nine eleven ten"), (8, "item here short item"),
        (9, "the same id with another text of more than ten words in"), (9, "the same id with another text of more than ten words in"),
        (11, "one two three four five six seven eight NEIN ten eleven twelve")]


@pytest.mark.parametrize("containment, broadcast_rows", [(1.0, 100_000), (1.0, 0), (0.6, 100_000), (0.3, 0)])
def test_contamination_equals_brute_force(spark, containment, broadcast_rows):
    docs = spark.createDataFrame([(*d, 1, 2) for d in DOCS], "doc_id bigint, text string, rid int, span int")
    items = spark.createDataFrame([(*i, 1) for i in ITEMS], "item_id bigint, text string, item int")
    got = contamination.contaminated(docs, items, containment, broadcast_rows=broadcast_rows).collect()
    key = lambda r: (r[0] is not None, r[0] or 0, *r[1:])
    assert sorted((tuple(r) for r in got), key=key) == sorted(brute_contaminated(DOCS, ITEMS, containment), key=key)


def test_contamination_on_given_tables(spark):
    docs, items = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "benchmark"))
    want = brute_contaminated([(r.doc_id, r.text) for r in docs.collect()], [(r.item_id, r.text) for r in items.collect()])
    got = queries.op13_decontamination(spark, SF).collect()
    assert sorted((r.doc_id, r.n_words, r.n_hit, r.n_items, r.items_sha256, r.contaminated) for r in got) == sorted(
        (i, n, h, len(own), hashlib.sha256(",".join(own).encode()).hexdigest(), h > 0) for i, n, h, own in want)


def test_contamination_empty_tables(spark):
    docs = spark.createDataFrame(DOCS, "doc_id bigint, text string")
    items = spark.createDataFrame(ITEMS, "item_id bigint, text string")
    assert contamination.contaminated(docs.limit(0), items).count() == 0
    none = contamination.contaminated(docs, items.limit(0)).collect()
    assert len(none) == len(DOCS) and not any(r.n_hit or r["items"] for r in none)


def test_places_found_with_a_full_bit_table(spark, monkeypatch):
    """A table too small for the benchmark lets more places through, none get lost or invented."""
    monkeypatch.setattr(contamination, "MIN_BITS", 16)
    monkeypatch.setattr(contamination, "MAX_BITS", 16)
    docs, items = spark.createDataFrame(DOCS, "doc_id bigint, text string"), spark.createDataFrame(ITEMS, "item_id bigint, text string")
    got = sorted(r.n_hit for r in contamination.contaminated(docs, items).collect())
    assert got == sorted(h for _, _, h, _ in brute_contaminated(DOCS, ITEMS))
