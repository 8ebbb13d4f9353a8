"""Operators of the training-data package against brute force, and on awkward rows."""

import hashlib
import itertools
import random
import re
import zlib
from collections import defaultdict

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from shelfwatch.llm import (chat, components, curriculum, decontam, kdshards, langid, licenses, phrases, secret_scan, simhash, spelling,
                            suffixes, toxicity, whitening)

DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint, size bigint, h bigint, shard int, slot string, key string, score string, keep_text string, _drop bigint"


def awkward(spark, n=0):
    """Nulls in every column, empty and long texts, ties, repeated rows, extra columns with clashing names."""
    rng = random.Random(4)
    word = lambda: "".join(rng.choice("abcdeé") for _ in range(rng.randint(1, 7)))
    long = " ".join(word() for _ in range(30_000))
    texts = [None, "", " \n\t", "one", "One", "!!!", "12 34", long, long + " x", "Ünder the MIT\x00license", "a" * 3000] + [
        " ".join(word() for _ in range(rng.randint(1, 80))) + ". " for _ in range(n)]
    rows = [(i if i else None, t, [None, "en", "fr"][i % 3], [None, "s1", "s2", "S1"][i % 4], None, 5, None, 3, None, "k", "x", None, 7)
            for i, t in enumerate(texts)]
    rows += [rows[3], rows[3], rows[0], (3, "other", None, None, None, None, None, None, None, None, None, None, None)]
    return spark.createDataFrame(rows, DOCS)


def empty(spark):
    return spark.createDataFrame([], DOCS)


def labels(spark, rows=((1, 1, 0), (2, 1, 1), (3, None, None), (None, 1, 1), (2, 1, 0))):
    return spark.createDataFrame(list(rows), "doc_id bigint, quality int, toxic int")


def items(spark, rows=((1, "some benchmark item of a few words"), (2, None), (3, ""), (None, "x"), (4, "one"))):
    return spark.createDataFrame(list(rows), "item_id bigint, text string")


@pytest.mark.parametrize("table", ["awkward", "empty"])
def test_every_operator_takes_awkward_tables(spark, table):
    docs = awkward(spark) if table == "awkward" else empty(spark)
    n = docs.count()
    assert len(kdshards.kd_shards(docs, shards=4, keep=docs.columns).collect()) == n
    assert len(curriculum.curriculum(docs, keep=docs.columns).collect()) == n
    assert len(simhash.near_duplicates(docs).collect()) == n
    assert len(licenses.scan_licenses(docs).collect()) == n
    assert len(phrases.edit_study(docs).collect()) == n
    assert len(suffixes.repeated_spans(docs).collect()) == n
    assert len(toxicity.toxicity(docs, labels(spark)).collect()) == n
    assert len(langid.languages(docs).collect()) == n
    assert len(secret_scan.find_secrets(docs).collect()) == n
    assert {r["word"]: r["n"] for r in spelling.spelling_variants(docs).collect()} == slow_words([(r["doc_id"], r["text"]) for r in docs.collect()])
    got = {(r["doc_id"], r["item_id"]) for r in decontam.contaminated(docs, items(spark)).collect()}
    texts = [(r["doc_id"], " ".join((r["text"] or "").lower().split())) for r in docs.collect()]
    assert got == {(i, k) for i, t in texts for k, item in ((None, "x"), (4, "one")) if item in t}
    assert decontam.contaminated(docs, items(spark, ())).count() == 0


# --- SimHash ---------------------------------------------------------------------

def slow_simhash(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m.group().lower(), text or ""))
    grams = [" ".join(words[i:i + 4]) for i in range(len(words) - 3)] or ([" ".join(words)] if words else [])
    hs = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if sum(h >> b & 1 for h in hs) * 2 > len(hs))


@pytest.mark.parametrize("text", [None, "", " ", "a", "A b", "a b c d", "a b\x0bc\x1cd e f ÉÀ", "x y z w " * 50])
def test_simhash_of_a_text(text):
    assert simhash.simhash(text) == slow_simhash(text)


@pytest.mark.parametrize("bits", [2, 4, 5])
def test_links_are_all_pairs_within_distance_once(spark, bits):
    rng = random.Random(bits)
    fps = {0, (1 << 64) - 1}
    for _ in range(12):
        f = rng.getrandbits(64)
        for _ in range(12):
            g = f
            for b in rng.sample(range(64), rng.randint(0, 4)):
                g ^= 1 << b
            fps.add(g)
    signed = [f - (1 << 64) if f >> 63 else f for f in fps]
    got = [tuple(r) for r in simhash.links(spark.createDataFrame([(f,) for f in signed], "fp long"), bits).collect()]
    want = {(a, b) for a, b in itertools.permutations(signed, 2) if a < b and ((a ^ b) & (1 << 64) - 1).bit_count() <= bits}
    assert len(got) == len(set(got)) and set(got) == want


def test_fingerprints_and_their_variants_are_not_broadcast(spark, tmp_path):
    path = str(tmp_path / "fps")
    spark.range(3000).select(F.xxhash64("id").alias("fp")).write.parquet(path)  # a small file, 64 variants of every row of it
    found = simhash.links(spark.read.parquet(path))
    docs = spark.createDataFrame([(i, f"text {i} of words {i * i} unlike others {-i}") for i in range(20)], "doc_id long, text string")
    for df in (found, simhash.near_duplicates(docs)):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in plan and "BroadcastHashJoin" not in plan and "BroadcastExchange" not in plan


def test_components_of_chains_and_stars(spark):
    edges = [(i, i + 1) for i in range(60)] + [(100, i) for i in range(101, 140)] + [(200, 200), (None, 5), (300, 301), (301, 300)]
    got = defaultdict(set)
    for r in components.connected_components(spark.createDataFrame(edges, "a long, b long")).collect():
        got[r["root"]].add(r["v"])
    assert sorted(map(sorted, got.values())) == [list(range(61)), list(range(100, 140)), [300, 301]]


def test_near_duplicates_and_keep_one(spark):
    base = " ".join(f"w{i % 37}x{i}" for i in range(400))
    docs = spark.createDataFrame([(5, base), (3, base + " tail"), (9, "something else entirely here now"), (2, None), (7, ""), (11, base)], "doc_id long, text string")
    got = {r["doc_id"]: r["component_id"] for r in simhash.near_duplicates(docs).collect()}
    assert got == {5: 3, 3: 3, 11: 3, 9: 9, 2: 2, 7: 2}
    assert sorted(r["doc_id"] for r in simhash.keep_one(docs).collect()) == [2, 3, 9]


# --- mixing and shards -------------------------------------------------------------

def slow_targets(sizes):
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: 1 + i % 3 for i, s in enumerate(order)}
    left, open_, target = sum(sizes.values()), set(order), {}
    while True:
        w = sum(weight[s] for s in open_)
        over = {s for s in open_ if left * weight[s] / w > 3 * sizes[s]}
        if not over:
            return target | {s: left * weight[s] / w for s in open_}
        for s in over:
            target[s] = float(3 * sizes[s])
        left -= sum(3 * sizes[s] for s in over)
        open_ -= over


def test_curriculum_targets_and_copies(spark):
    rng = random.Random(2)
    docs = [(i, "w " * rng.randint(0, 60), rng.choice(["a", "b", "B", "é", None] + ["big"] * 20)) for i in range(900)]
    sizes = defaultdict(int)
    for _, t, s in docs:
        sizes[s] += t.count("w")
    df = spark.createDataFrame(docs, "doc_id long, text string, source string")
    rows = curriculum.curriculum(df, keep=["source"]).collect()
    want = slow_targets(sizes)
    taken = defaultdict(int)
    for r in rows:
        assert r["target"] == pytest.approx(want[r["keep_source"]]) and r["taken"] == r["copies"] * r["size"] <= 3 * r["size"]
        assert len(r["positions"]) == r["copies"] and all(0 <= p <= 1 for p in r["positions"])
        taken[r["keep_source"]] += r["taken"]
    assert any(want[s] == 3 * sizes[s] for s in sizes)
    assert all(abs(taken[s] - want[s]) <= 30 for s in sizes)
    order = curriculum.training_order(curriculum.curriculum(df)).collect()
    assert [r["position"] for r in order] == sorted(r["position"] for r in order) and len(order) == sum(r["copies"] for r in rows)
    assert sorted(map(str, curriculum.curriculum(df).collect())) == sorted(map(str, curriculum.curriculum(df.repartition(7)).collect()))


@pytest.mark.parametrize("shards", [1, 5, 16])
def test_kd_shards_are_even_and_slots_gapless(spark, shards):
    rng = random.Random(1)
    docs = [(i, "x" * rng.randint(0, 300), rng.choice(["en", None]), "hot" if i % 3 else f"s{i % 7}") for i in range(3000)] + [(9999, None, None, None)]
    rows = kdshards.kd_shards(spark.createDataFrame(docs, "doc_id long, text string, lang string, source string"), shards=shards).collect()
    load, slots = defaultdict(int), defaultdict(list)
    for r in rows:
        load[r["shard"]] += r["size"]
        slots[r["shard"]].append(r["slot"])
    assert {r["doc_id"]: (r["size"], r["text_crc32"]) for r in rows} == {i: (len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for i, t, *_ in docs}
    assert set(load) == set(range(shards)) and max(load.values()) - min(load.values()) <= 4 * 301
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())


def test_kd_shards_by_target_bytes(spark):
    docs = spark.range(1000).selectExpr("id AS doc_id", "repeat('y', 99) AS text", "'en' AS lang", "'s' AS source")
    load = defaultdict(int)
    for r in kdshards.kd_shards(docs, target_bytes=30_000).collect():
        load[r["shard"]] += r["size"]
    assert len(load) == 4 and max(load.values()) <= 26_000


# --- chat --------------------------------------------------------------------------

def test_chat_round_trip(spark):
    rng = random.Random(3)
    bits = ["<|im_end|>", "<|im_start|>", "<|im_sep|>", "<|nl|>", "<", "|", "\\", "<\\|", "\n", "ü", "a b", "$1", ""]
    turns = [(c, t, rng.choice(["user", "assistant", "system", None, "we\nird<|"]), rng.choice([None, "".join(rng.choice(bits) for _ in range(6))]))
             for c in [*range(40), None] for t in range(rng.randint(1, 9))]
    turns += [(77, 0, "assistant", "x"), (77, 0, "assistant", "x"), (77, None, "user", "first")]
    back = {r["conv_id"]: r for r in chat.read_back(chat.format_chats(spark.createDataFrame(turns, "conv_id long, turn long, role string, text string"))).collect()}
    want = defaultdict(list)
    for c, t, r, x in turns:
        want[c].append((-1 if t is None else t, r or "", x or ""))
    assert set(back) == set(want)
    for c, rows in want.items():
        rows.sort()
        assert [(t["role"], t["text"]) for t in back[c]["turns"]] == [r[1:] for r in rows]
        assert back[c]["loss_text"] == "".join(x for _, r, x in rows if r == "assistant")
        blocks = len(list(itertools.groupby(rows, key=lambda r: r[1])))
        assert back[c]["formatted"].count("<|im_start|>") == blocks == back[c]["formatted"].count("<|im_end|>")


def test_chat_takes_empty_tables_and_clashing_columns(spark):
    schema = "conv_id long, turn long, role string, text string, turns string, firsts int, blocks int, formatted string, loss_spans long"
    extra = ("t", None, 3, "f", 7)
    long = "ü<|im_end|>" * 20_000
    rows = [(1, 0, "user", "q", *extra), (1, 1, "assistant", long, *extra), (1, 1, "assistant", long, *extra), (2, None, None, None, *extra), (None, 0, "assistant", "", *extra)]
    back = {r["conv_id"]: r for r in chat.read_back(chat.format_chats(spark.createDataFrame(rows, schema))).collect()}
    assert {i: [(t["role"], t["text"]) for t in r["turns"]] for i, r in back.items()} == {
        1: [("user", "q"), ("assistant", long), ("assistant", long)], 2: [("", "")], None: [("assistant", "")]}
    assert back[1]["loss_text"] == long * 2
    assert chat.read_back(chat.format_chats(spark.createDataFrame([], schema))).collect() == []


@pytest.mark.parametrize("n", [1, 2, 3, 7, 5000])
def test_chat_spans_of_a_long_conversation(spark, n):
    rng = random.Random(n)
    rows = [(1, t, rng.choice(["user", "assistant"]), "é<|" * rng.randint(0, 3) + str(t)) for t in range(n)]
    got = chat.read_back(chat.format_chats(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string"))).first()
    raw, cuts = got["formatted"].encode(), [(s["first"], s["end"]) for s in got["loss_spans"]]
    said = [x for *_, r, x in rows if r == "assistant"]
    assert [raw[a:z].decode().replace("<\\|", "<|") for a, z in cuts] == said
    assert got["loss_text"] == "".join(said)


# --- licences -------------------------------------------------------------------------

def test_licence_places_against_brute_force():
    machine, rng = licenses.Automaton(), random.Random(1)
    vocab = [w.decode() for w in machine.vocab] + ["zz", "Foo", "été"]
    for _ in range(800):
        parts = []
        for _ in range(rng.randrange(20)):
            x = rng.random()
            tw = rng.choice(licenses.TEMPLATES)[1].split()
            a = rng.randrange(len(tw))
            parts += rng.choice(licenses.BASE)[0].split() if x < .3 else tw[a:a + rng.randrange(1, 12)] if x < .5 else [rng.choice(vocab)]
        text = rng.choice([" ", "-", ", "]).join(parts)
        words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m.group().lower(), text))
        assert [w.decode() for w in licenses.words_of(text)] == words
        want = sorted((i, k) for k, (p, _) in enumerate(licenses.BASE) for i in range(len(words)) if words[i:i + len(p.split())] == p.split())
        assert sorted(machine.scan(licenses.words_of(text))[0]) == want


@pytest.mark.parametrize("k", range(len(licenses.TEMPLATES)))
def test_licence_template_is_found_with_a_word_changed(k):
    label, text = licenses.TEMPLATES[k]
    machine = licenses.Automaton()
    assert (label, 1.0) in [(machine.templates[t][0], x) for *_, t, x in machine.scan(licenses.words_of(f"before {text} after"))[1]]
    words = licenses.words_of(text)
    if len(words) > 20:
        words[10] = b"changed"
        assert label in [machine.templates[t][0] for _, _, t, x in machine.scan(words)[1] if 0.7 <= x < 1]


@pytest.mark.parametrize("text, want", [
    ("This work is licensed under a Creative Commons Attribution 4.0 International License.", {"cc-by"}),
    ("This work is licensed under a Creative Commons Attribution-NonCommercial-ShareAlike 4.0 International License.", {"cc-by-nc-sa"}),
    ("This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.", {"cc-by-nc"}),
    ("This work is licensed under a Creative Commons Attribution 9.0 International License.", set()),
    ("This work is licensed under the GNU General Public License, version 2.", {"gpl-2"}),
    ("This work is licensed under the GNU General Public License, version 3.", {"gpl-3"}),
    ("This work is licensed under the GNU Lesser General Public License, version 3.", {"lgpl-3"}),
    ("Licensed under the Apache License, Version 1.1", {"apache-1.1"}),
    ("Licensed under the Apache License, Version 2.0.", {"apache-2"}),
    ("This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as "
     "published by the Free Software Foundation; either version 2.1 of the License, or (at your option) any later version.", {"lgpl-2.1"}),
])
def test_licences_are_told_from_their_siblings(text, want):
    machine = licenses.Automaton()
    assert {machine.templates[t][0] for *_, t, _ in machine.scan(licenses.words_of(f"before {text} after"))[1]} == want


def test_short_licence_phrases_and_templates():
    machine = licenses.Automaton(base=[("apache two", "a2"), ("mit", "m")], templates=[("isc", "isc license"), ("long", "one two three four five")])
    hits, spans = machine.scan(licenses.words_of("zz apache two zz MIT zz isc license zz"))
    assert sorted(hits) == [(1, 0), (4, 1)]
    assert [(a, e, machine.templates[t][0], x) for a, e, t, x in spans] == [(6, 8, "isc", 1.0)]
    assert licenses.Automaton(base=[("mit", "m")], templates=[]).scan([b"mit", b"mit"])[0] == [(0, 0), (1, 0)]


def test_licence_chains_against_brute_force():
    """On a template of different words a chain is a run of file words in template order, gaps of at most MAX_GAP words between its matches."""
    rng = random.Random(5)
    template = [f"w{i}" for i in range(12)]
    machine = licenses.Automaton(base=[], templates=[("t", " ".join(template))])
    places = {w: i for i, w in enumerate(template)}
    found = 0
    for _ in range(500):
        words = []
        at = 0
        while at < 12:  # pieces of the template in order, unknown words between them
            n = rng.randint(2, 6)
            words += template[at:at + n] + ["zz"] * rng.choice([0, 1, 3, 8, 9, 20])
            at += n + rng.choice([0, 0, 1])
        runs = []  # maximal runs of consecutive template words: first word, end, first place
        i = 0
        while i < len(words):
            if words[i] not in places:
                i += 1
                continue
            j = i + 1
            while j < len(words) and places.get(words[j]) == places[words[j - 1]] + 1:
                j += 1
            if j - i >= licenses.MIN_MATCH:
                runs.append((i, j))
            i = j
        chains = []
        for a, b in runs:
            if chains and a - chains[-1][-1][1] <= licenses.MAX_GAP:
                chains[-1].append((a, b))
            else:
                chains.append([(a, b)])
        want = [(c[0][0], c[-1][1], sum(b - a for a, b in c) / 12) for c in chains if sum(b - a for a, b in c) >= licenses.MIN_COVER * 12]
        got = [(a, e, x) for a, e, _, x in machine.scan(licenses.words_of(" ".join(words)))[1]]
        assert got == want, words
        found += len(got)
    assert found > 100


def test_matching_statistics_leave_common_words_alone():
    assert licenses.Automaton().scan(licenses.words_of("the software and the work is in the public version of this"))[1] == []


# --- fingerprints ------------------------------------------------------------------------

def test_edit_study(spark):
    rng = random.Random(6)
    docs = [(i * 3, " ".join(rng.choice(["alpha", "beta", "gämma", "delta", "eps", "zeta"]) + str(rng.randrange(50)) for _ in range(rng.randrange(200)))) for i in range(400)]
    rows = {r["doc_id"]: r for r in phrases.edit_study(spark.createDataFrame(docs, "doc_id long, text string")).collect()}
    order = sorted(docs, reverse=True)
    for (i, t), (_, following) in zip(order, order[1:] + order[:1]):
        k = len(t) // 3
        assert rows[i]["n_chars"] == len(t)
        assert rows[i]["edited_sha256"] == hashlib.sha256((t[:len(t) - k] + following[:k]).encode()).hexdigest()
    assert sum(r["near_edited"] > r["near_next"] for r in rows.values()) > 0.95 * len(rows)
    alike = {}
    for i, t in docs:
        assert alike.setdefault(t, rows[i]["fingerprint"]) == rows[i]["fingerprint"]


def test_equal_substrings_share_names_at_any_offset():
    import numpy as np
    rng = random.Random(8)
    shared = "".join(rng.choice("abcdefgh ") for _ in range(2000))
    names = []
    for lead in ("", "x", "some other words before"):
        x, starts = np.frombuffer((lead + shared).encode("utf-32-le"), "<u4"), np.array([0])
        for _ in range(3):
            x, starts = phrases.parse(x, starts)
        names.append(set(x.tolist()))
    assert all(len(names[0] & o) >= 0.9 * len(names[0]) for o in names[1:])


M64 = (1 << 64) - 1


def slow_mix(x):
    x = ((x ^ (x >> 30)) * 0xBF58476D1CE4E5B9) & M64
    x = ((x ^ (x >> 27)) * 0x94D049BB133111EB) & M64
    return x ^ (x >> 31)


def slow_parse(row):
    """Names of the phrases of one row of symbols, one symbol at a time."""
    golden = 0x9E3779B97F4A7C15
    symbols = [slow_mix((x + golden * len(list(run))) & M64) for x, run in itertools.groupby(row)]
    labels = symbols
    for _ in range(4):
        before = [labels[0] ^ 1, *labels[:-1]]
        places = [((a ^ b) & -(a ^ b)).bit_length() - 1 for a, b in zip(labels, before)]
        labels = [2 * k + (a >> k & 1) for a, k in zip(labels, places)]
    phrases_, last = [], len(symbols) - 1
    for i, x in enumerate(symbols):
        if i == 0 or i != last and labels[i - 1] < labels[i] > labels[i + 1]:
            phrases_.append([])
        phrases_[-1].append(x)
    return [slow_mix((sum(x * pow(golden, i + 1, 1 << 64) for i, x in enumerate(p)) + len(p)) & M64) for p in phrases_]


def test_sketches_equal_plain_parsing():
    rng = random.Random(12)
    texts = ["".join(rng.choice("ab cdé\n") for _ in range(rng.randrange(1, 400))) for _ in range(150)] + ["a", "aaaa", "ab", "", "x" * 500]
    got = phrases.sketches(texts)
    for text, sketch in zip(texts, got):
        want, row, first = [-1] * phrases.SLOTS, [ord(c) for c in text], 0
        for slots in phrases.LEVEL_SLOTS:
            row = slow_parse(row) if row else []
            for slot in {x % slots for x in row}:
                want[first + slot] = slow_mix(min(x >> 6 for x in row if x % slots == slot)) >> 48
            first += slots
        assert sketch.tolist() == want


def test_next_documents_over_many_buckets(spark, monkeypatch):
    """Null, repeated and extreme doc_ids split over buckets; every row is followed by the next in order."""
    monkeypatch.setattr(phrases, "BUCKET_BYTES", 60)
    monkeypatch.setattr(phrases, "SAMPLE", 4)
    rng = random.Random(13)
    docs = ([(i * 7 - 900, f"text {i} {rng.random()}") for i in range(300)] + [(None, f"none {i}") for i in range(150)] + [(5, f"five {i}") for i in range(100)]
            + [(8, "copy")] * 200 + [((1 << 63) - 1, "last"), (-(1 << 63) + 1, None), (2, "")])
    rows = phrases.with_next(spark.createDataFrame(docs, "doc_id long, text string")).collect()
    assert len({r["bucket"] for r in rows}) > 50
    own = [(r["doc_id"], r["text"]) for r in rows if not r["ahead"]]
    assert sorted(own, key=str) == sorted([(i, t or "") for i, t in docs], key=str)
    following = defaultdict(list)
    for b in {r["bucket"] for r in rows}:
        part = [r for r in rows if r["bucket"] == b]
        assert [r["ahead"] for r in part] == [False] * (len(part) - 1) + [True]
        for a, c in zip(part, part[1:]):
            following[a["doc_id"]].append(c["doc_id"])
    # the rows of all buckets, one behind the other, are a ring in which ids fall but once
    ring = [(i, j) for i, js in following.items() for j in js]
    assert len(ring) == len(docs)
    key = lambda i: -(1 << 63) if i is None else i
    assert sum(key(i) < key(j) for i, j in ring) == 1
    ids = sorted({key(i) for i, _ in docs}, reverse=True)
    nexts = dict(zip(ids, ids[1:] + ids[:1]))
    assert all(key(j) in (key(i), nexts[key(i)]) for i, j in ring)
    assert sorted(key(i) for i, j in ring if key(i) != key(j)) == sorted(ids)
    # of equal doc_ids every text is followed and follows once
    five = sorted(r["text"] for r in rows if r["doc_id"] == 5 and not r["ahead"])
    assert five == sorted(f"five {i}" for i in range(100))


# --- repeats -------------------------------------------------------------------------------

def slow_repeats(docs, length, keep):
    seen = defaultdict(list)
    marks = [bytearray(len((t or "").encode())) for _, t in docs]
    for n, (_, t) in enumerate(docs):
        b = (t or "").encode()
        for p in range(len(b) - length + 1):
            seen[b[p:p + length]].append((docs[n][0], p, n))
    for places in seen.values():
        if len(places) > 1:
            for _, p, n in places if keep == "none" else sorted(places)[1:]:
                marks[n][p:p + length] = b"\1" * length
    out = []
    for (i, t), m in zip(docs, marks):
        kept = bytes(c for c, x in zip((t or "").encode(), m) if not x)
        out.append((i, len(m), sum(m), len(re.findall(b"\1+", bytes(m))), hashlib.sha256(kept).hexdigest()))
    return sorted(out)


@pytest.mark.parametrize(("seed", "keep", "group"), [(0, "none", 20_000), (0, "first", 20_000), (1, "none", 3), (1, "first", 3)])
def test_repeated_spans(spark, seed, keep, group):
    rng = random.Random(seed)
    alphabet = "ab" if seed else "abcdefghé "
    rnd = lambda n: "".join(rng.choice(alphabet) for _ in range(n))
    pool = [rnd(rng.randrange(20, 200)) for _ in range(12)]
    docs = [(i, "".join(rng.choice(pool)[rng.randrange(30):rng.randrange(30, 200)] if rng.random() < .6 else rnd(rng.randrange(60))
                        for _ in range(rng.randrange(6)))) for i in range(90)]
    docs += [(100, None), (101, ""), (102, docs[3][1]), (103, docs[3][1]), (104, "a" * 300), (105, "ab" * 100 + "c" + "ab" * 30)]
    rows = suffixes.repeated_spans(spark.createDataFrame(docs, "doc_id long, text string"), 40, 13, keep, group, with_text=True).collect()
    assert all(hashlib.sha256(bytes(r["kept"])).hexdigest() == r["kept_sha256"] for r in rows)
    assert sorted((r["doc_id"], r["n_bytes"], r["n_removed"], len(r["spans"]), r["kept_sha256"]) for r in rows) == slow_repeats(docs, 40, keep)


# --- decontamination ----------------------------------------------------------------------------

def slow_match(a, b):
    prev = [0] * (len(b) + 1)
    for i, x in enumerate(a):
        cur = [i + 1]
        for j, y in enumerate(b):
            cur.append(min(prev[j] + (x != y), prev[j + 1] + 1, cur[j] + 1))
        prev = cur
    return min(prev)


def test_edit_distance_to_the_best_part():
    rng = random.Random(3)
    for _ in range(400):
        a, b = ("".join(rng.choice("abc ") for _ in range(rng.randrange(lo, 40))) for lo in (1, 0))
        assert decontam.best_match(a, b)[0] == slow_match(a, b)


def test_contaminated_recall_and_precision(spark):
    rng = random.Random(5)
    word = lambda: "".join(rng.choice("abcdefghiklmnoprstu") for _ in range(rng.randint(2, 9)))
    bench = [(i, " ".join(word() for _ in range(rng.randint(15, 60)))) for i in range(60)] + [(90, "short item"), (91, "two words only")]
    docs, planted = [], set()
    for n in range(400):
        text = [word() for _ in range(rng.randint(20, 300))]
        if n % 2:
            i, t = rng.choice(bench)
            t = list(t)
            for _ in range(len(t) * (n % 4 == 3) // 12):
                t[rng.randrange(len(t))] = rng.choice("abcdef")
            text.insert(rng.randrange(len(text)), "".join(t).upper() if n % 5 == 0 else "".join(t))
            planted.add((n, i))
        docs.append((n, "  ".join(text)))
    df, it = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(bench, "item_id long, text string")
    rows = decontam.contaminated(df, it).collect()
    got = {(r["doc_id"], r["item_id"]) for r in rows}
    texts, by = dict(docs), dict(bench)
    want = {(n, i) for n, t in docs for i, b in bench if slow_match_bounded(b, decontam.normal(t).decode())}
    assert planted <= want and got <= want
    assert len(got) >= 0.95 * len(want)
    for r in rows[:30]:
        assert r["edits"] == slow_match(by[r["item_id"]], decontam.normal(texts[r["doc_id"]]).decode())
    assert {r["doc_id"] for r in decontam.decontaminate(df, it).collect()} == set(texts) - {d for d, _ in got}


def slow_match_bounded(item, text):
    """Brute force by the exact routine, which another test holds against the plain recurrence."""
    return decontam.best_match(item, text)[0] <= 0.2 * len(item)


def edited(rng, text, edits, even):
    """``text`` with so many substitutions, deletions and insertions, at random or at even distances."""
    places = [int((i + 0.5) * len(text) / edits) for i in range(edits)] if even else rng.sample(range(len(text)), edits)
    out = list(text)
    for p in places:
        x = rng.choice("abcdefgh")
        out[p] = rng.choice([x, "", x + out[p]])
    return "".join(out)


@pytest.mark.parametrize("rate, even", [(0.15, True), (0.2, False), (0.2, True)])
def test_contaminated_recall_at_the_verified_similarity(spark, rate, even):
    rng = random.Random(8)
    word = lambda: "".join(rng.choice("abcdefghiklmnoprstu") for _ in range(rng.randint(2, 9)))
    bench = [(i, " ".join(word() for _ in range(99))[:(24, 48, 80, 120, 300)[i % 5]].strip()) for i in range(200)]
    docs = [(i, f"{word()} {word()} {edited(rng, t, int(rate * len(t)), even)} {word()}") for i, t in bench]
    df, it = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(bench, "item_id long, text string")
    got = {r["doc_id"] for r in decontam.contaminated(df, it).where("doc_id = item_id").collect()}
    for n in range(5):
        want = [i for (i, b), (_, t) in zip(bench, docs) if i % 5 == n and slow_match_bounded(b, decontam.normal(t).decode())]
        assert len(want) >= 30 and len(got & set(want)) >= 0.9 * len(want)


def test_contaminated_needs_no_spaces(spark):
    rng = random.Random(6)
    chinese = "".join(chr(0x4E00 + rng.randrange(3000)) for _ in range(60))
    bench = [(1, chinese), (2, "https://example.org/some/long/path?with=a&query=string"), (3, "for(i=0;i<len(values);i++){total+=values[i]*weights[i];}"),
             (4, "twoverylongwordswithout anyotherspacebetweenthem")]
    docs = [(i, f"文 {t} 字") for i, t in bench] + [(i + 10, f"文{edited(rng, t, len(t) // 10, False)}字") for i, t in bench] + [(99, "別 nothing of them")]
    df, it = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(bench, "item_id long, text string")
    assert {(r["doc_id"], r["item_id"]) for r in decontam.contaminated(df, it).collect()} == {(i + k, i) for i in (1, 2, 3, 4) for k in (0, 10)}


def test_long_texts_go_piece_by_piece(spark):
    item = "a passage that the benchmark holds and that must be found at any place of a text"
    filler = "lorem ipsum dolor sit amet consectetur " * 30_000  # over one piece
    cut = len(filler) - len(filler) % decontam.PIECE
    docs = [(1, filler + item), (2, filler[:cut - 40] + " " + item + " " + filler[:50]), (3, filler)]
    got = decontam.contaminated(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame([(7, item)], "item_id long, text string"))
    assert sorted(r["doc_id"] for r in got.collect()) == [1, 2]


# --- classifiers -----------------------------------------------------------------------------------

def test_toxicity_on_held_out_documents(spark, sf_small):
    import shelfwatch.llm.queries as Q
    sf = sf_small.replace("sf0.001", "sf0.01")
    truth = {r["doc_id"]: r["toxic"] for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    rows = [r for r in Q.op4_toxicity(spark, sf).collect() if r["held_out"] and r["doc_id"] in truth]
    bad, good = ([r for r in rows if truth[r["doc_id"]] == k] for k in (1, 0))
    assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.7) for r in rows)
    assert sum(r["predicted"] for r in bad) >= 0.6 * len(bad) and sum(r["predicted"] for r in good) <= 0.02 * len(good)
    pairs = [(a["score"] > b["score"]) + (a["score"] == b["score"]) / 2 for a in bad for b in good]
    assert sum(pairs) / len(pairs) > 0.9


def test_offending_sentence_is_located():
    texts = [f"Calm words number {i} here. {'You utter moron are bad' if i % 2 else 'You kind person are good'}. More calm words." for i in range(60)]
    scorer = toxicity.Scorer(*toxicity.fit(texts, [i % 2 for i in range(60)]))
    p, spans = scorer.score(texts[1])
    assert p > 0.7 and [texts[1][s["first"]:s["end"]].strip() for s in spans] == ["You utter moron are bad"]
    assert scorer.score(None) == (0.0, []) and scorer.score("")[0] == 0.0
    assert toxicity.fit(["a"], [0])[1] == toxicity.UNTRAINED


def slow_marginals(scores, move, start):
    import numpy as np
    n, k = scores.shape
    post, total = np.zeros((n, k)), 0.0
    for path in itertools.product(range(k), repeat=n):
        p = start[path[0]] * np.exp(sum(scores[i, y] for i, y in enumerate(path)))
        for a, b in zip(path, path[1:]):
            p *= move[a, b]
        total += p
        for i, y in enumerate(path):
            post[i, y] += p
    return post / total


def test_forward_backward_against_all_paths(monkeypatch):
    import numpy as np
    rng = np.random.default_rng(1)
    monkeypatch.setattr(langid, "CHUNK", 3)
    lengths = [1, 5, 2, 7, 1]
    scores, move, start = rng.normal(size=(sum(lengths), 3)), rng.random((3, 3)), rng.random(3)
    first = np.zeros(len(scores), bool)
    cuts = np.cumsum([0, *lengths])
    first[cuts[:-1]] = True
    got = langid.marginals(scores, first, move, start)
    for a, b in zip(cuts, cuts[1:]):
        assert np.allclose(got[a:b], slow_marginals(scores[a:b], move, start))


def slow_log_likelihood(theta, f, at, new, y):
    """Of the languages ``y`` per word, over all paths of every text."""
    n, k = len(y), theta[0].shape[1]
    scores = np.zeros((n, k))
    np.add.at(scores, at, theta[0][f])
    cuts, total = [*np.flatnonzero(new), n], 0.0
    for a, b in zip(cuts, cuts[1:]):
        def weight(path):
            return (theta[2][path[0]] + sum(scores[a + i, l] for i, l in enumerate(path))
                    + sum(theta[1][i, j] for i, j in zip(path, path[1:])))
        total += weight(y[a:b]) - np.log(sum(np.exp(weight(p)) for p in itertools.product(range(k), repeat=b - a)))
    return total / n


@pytest.mark.parametrize("chunk", [1, 3, 256])
def test_language_gradient_equals_finite_differences(monkeypatch, chunk):
    rng = np.random.default_rng(chunk)
    monkeypatch.setattr(langid, "CHUNK", chunk)
    lengths = [1, 6, 2, 5]
    n, k, m = sum(lengths), 3, 4
    new = np.zeros(n, bool)
    new[np.cumsum([0, *lengths])[:-1]] = True
    at = np.repeat(np.arange(n), 2)
    f, y = rng.integers(0, m, len(at)), rng.integers(0, k, n)
    theta = [rng.normal(size=(m, k)), rng.normal(size=(k, k)), rng.normal(size=k)]
    got = langid.slopes(theta, f, at, new, y)
    for part, grad in zip(theta, got):
        for i in np.ndindex(part.shape):
            part[i] += 1e-5
            up = slow_log_likelihood(theta, f, at, new, y)
            part[i] -= 2e-5
            down = slow_log_likelihood(theta, f, at, new, y)
            part[i] += 1e-5
            assert abs((up - down) / 2e-5 - grad[i]) < 1e-6


def test_language_on_held_out_documents(spark, sf_small):
    import shelfwatch.llm.queries as Q
    sf = sf_small.replace("sf0.001", "sf0.01")
    truth = {r["doc_id"]: r["lang"] for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "lang").collect()}
    rows = [r for r in Q.op9_language(spark, sf).collect() if r["held_out"]]
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2) for r in rows)
    assert sum(r["lang_pred"] == truth[r["doc_id"]] for r in rows) > 0.95 * len(rows)


def test_code_switched_words_are_labelled(spark):
    en, fr = "the house and that thing with which we went there", "les maisons et cette chose avec laquelle nous sommes"
    rng = random.Random(1)
    mix = lambda t: " ".join(rng.sample(t.split(), 8))
    field = langid.fit([mix(t) for _ in range(60) for t in (en, fr)], ["en", "fr"] * 60)
    docs = spark.createDataFrame([(1, f"{en} {fr}"), (2, None), (3, "12 !")], "doc_id long, text string")
    rows = {r["doc_id"]: r for r in langid.predict(docs, field, segments=True).collect()}
    n = len(en.split())
    assert [(s["first"], s["end"], s["lang"]) for s in rows[1]["segments"]] == [(0, n, "en"), (n, n + len(fr.split()), "fr")]
    assert rows[2]["lang_pred"] == rows[3]["lang_pred"] == "und"


def test_toxicity_of_a_long_text_is_the_plain_noisy_or():
    model, bias = {"<barg": 0.6, "=zest": 1.5, "dent>": 0.2}, -6.0
    text = "bargain bargained bargains bargainer bargaining barge. zest student president resident. none here. " * 50
    clean = 1.0
    for sentence in re.findall(r"[^.!?\n]+", text):
        features = {f for w in re.findall(r"[^\W_]+", sentence.lower()) for f in toxicity.word_features(w)}
        clean *= 1 - 1 / (1 + 2.718281828459045 ** -(bias + sum(model.get(f, 0) for f in features)))
    assert toxicity.Scorer(model, bias).score(text)[0] == pytest.approx(1 - clean)


# --- short items, shards of sources with a common beginning ------------------------------

def test_short_items_are_found_exactly(spark):
    rng = random.Random(9)
    words = ["x=y+z*2", "蓝鲸吃磷虾", "日本東京都", "ab", "abc d", "kitchen", "öl", "elevenchars"]
    texts = ["so x=y+z*2 holds", "蓝鲸_磷虾", "日本X京都", "kitchn", "a b"] + ["".join(rng.choice("abcdk itxy=+z2") for _ in range(40)) for _ in range(200)]
    got = {(r["doc_id"], r["item_id"]): r["edits"] for r in decontam.contaminated(
        spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), spark.createDataFrame(list(enumerate(words)), "item_id long, text string")).collect()}
    want = {}
    for i, t in enumerate(texts):
        t = " ".join(t.lower().split())
        for k, w in enumerate(words):
            edits, _ = decontam.best_match(w, t)
            if edits <= 0.2 * len(w) + 1e-9:
                want[i, k] = edits
    assert got == want and {(0, 0), (1, 1), (2, 2), (3, 5)} <= set(got)


def test_sources_with_a_common_beginning_are_cut_like_others(spark):
    rows = [(i, "x" * 50, ["wikipedia-en", "wikipedia-de"][i % 2], "l") for i in range(2000)]
    out = kdshards.kd_shards(spark.createDataFrame(rows, "doc_id long, text string, source string, lang string"), shards=2).collect()
    assert {(r["shard"], r["doc_id"] % 2) for r in out} == {(0, 1), (1, 0)}


# --- longest previous factors -----------------------------------------------------------

def test_longest_previous_factors():
    rng = np.random.default_rng(7)
    for n in (0, 1, 2, 5, 40, 300):
        for _ in range(10):
            rank, lcp = rng.permutation(n), rng.integers(0, 9, n)
            if n:
                lcp[0] = 0
            want = [max([min(lcp[min(i, j) + 1:max(i, j) + 1]) for j in range(n) if rank[j] < rank[i]], default=0) for i in range(n)]
            assert suffixes.longest_previous(rank, lcp).tolist() == want


def test_windows_of_words_that_other_documents_have(spark):
    rng = random.Random(3)
    word = lambda: "".join(rng.choice("abcdef") for _ in range(3))
    text = lambda n: [word() for _ in range(n)]
    a, b = text(60), text(55)
    rows = [(1, " ".join(text(100) + a + text(40))), (2, "\n".join(text(10) + a)), (3, " ".join(text(300))), (4, " ".join(b)), (4, " ".join(b)),
            (None, " ".join(b[:50] + text(30))), (5, None), (6, ""), (7, " ".join(text(20) + a[5:56])), (8, " ".join(text(5) + ["x"] * 200))]
    got = suffixes.repeated_spans(spark.createDataFrame(rows, "doc_id long, text string"), words=51).collect()
    wins = [{" ".join(w[i:i + 51]) for i in range(len(w) - 50)} for w in ((t or "").split() for _, t in rows)]
    want = sorted((str(i), sum(any(x in v for k, v in enumerate(wins) if k != j) for x in wins[j])) for j, (i, _) in enumerate(rows))
    assert sorted((str(r["doc_id"]), r["n_shared"]) for r in got) == want and sum(n for _, n in want) > 20


# --- spelling variants ---------------------------------------------------------------

def slow_words(rows):
    n = defaultdict(int)
    for i, t in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", t or ""):
            run = re.sub("[A-Z]", lambda m: m.group().lower(), run)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            n[run[:h % len(run)] + run[h % len(run) + 1:] if h % 31 == 0 else run] += 1
    return {w: k for w, k in n.items() if len(w) >= 7 and k >= 2}


def one_edit(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def slow_variants(n):
    near = {w: [x for x in n if one_edit(w, x)] for w in n}
    form = {}
    for w in n:
        best = min(near[w], key=lambda x: (-n[x], x), default=None)
        form[w] = best if best is not None and n[best] >= 10 * n[w] else None
    out = {}
    for w in n:
        root = w
        while form[root]:
            root = form[root]
        out[w] = (form[w], root, n[w], len(near[w]), n[form[w]] if form[w] else None)
    return out


@pytest.mark.parametrize("tile", [1024, 3])
def test_spelling_variants_are_those_of_all_pairs(spark, monkeypatch, tile):
    monkeypatch.setattr(spelling, "TILE", tile)
    rng = random.Random(11)
    words = ["".join(rng.choice("abcé") for _ in range(rng.randint(6, 9))) for _ in range(60)] + ["Kitchen", "×÷×÷×÷×", "Zürich-Genève", "z" * 3000, "z" * 3001]
    rows = []
    for i in range(1500):
        w = rng.choice(words[:12] if i % 4 else words)
        at = rng.randrange(len(w))
        edited = rng.choice([w, w, w, w[:at] + w[at + 1:], w[:at] + "b" + w[at:], w[:at] + "a" + w[at + 1:]])
        rows.append((rng.choice([None, 7, i]), f"{edited} {w}, {w.upper()}"))
    rows += [(1, None), (2, ""), (3, "12 !")] + [(None, "kitchen " * 600)]
    n = slow_words(rows)
    got = {r["word"]: (r["form"], r["root"], r["n"], r["n_near"], r["form_n"])
           for r in spelling.spelling_variants(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    want = slow_variants(n)
    assert len(want) > 60 and any(v[0] for v in want.values())
    assert got == want


@pytest.mark.parametrize("groups", [2, 3, 6])
def test_every_edit_leads_to_an_adjacent_block(groups):
    steps = {tuple(s) for s in spelling._steps(groups)}
    letters = [chr(c) for c in (*range(97, 123), *range(0xC0, 0x100))]
    block = lambda w: [len(w), *[sum(c in letters[g::groups] for c in w) for g in range(groups - 1)]]
    rng = random.Random(groups)
    for _ in range(500):
        w = "".join(rng.choice(letters) for _ in range(8))
        at = rng.randrange(8)
        x = rng.choice([w[:at] + w[at + 1:], w[:at] + rng.choice(letters) + w[at + 1:]])
        step = tuple(a - b for a, b in zip(block(w), block(x)))
        assert step in steps or tuple(-s for s in step) in steps
        assert step == (0,) * groups or not (step in steps and tuple(-s for s in step) in steps)


# --- secrets ----------------------------------------------------------------------------

@pytest.mark.parametrize("pattern,gives", [
    ("abc", {"abc"}), ("(?i)ABCd", {"abc", "bcd"}), ("ab", None), ("[0-9a-f]{32,}", None), ("ab?cde", {"abc", "bcd", "cde", "acd"}),
    ("x+abc|y", None), ("(?:abc)*", None), ("(abc){2}x", {"abc", "bca", "cab", "bcx"}), ("^abc$", {"abc"}), ("[ab]cd", None), ("é", None), ("aé", {"a\xc3\xa9"})])
def test_trigrams_that_a_pattern_asks_for(pattern, gives):
    q = secret_scan.trigram_query(pattern)
    if pattern == "[ab]cd":
        assert q[0] == "or" and len(q[1]) == 2
    elif gives is None:
        assert q is None
    else:
        want = {ord(g[0]) << 16 | ord(g[1]) << 8 | ord(g[2]) for g in gives}
        assert secret_scan.trigrams(q) == want


def slow_spans(text):
    return [(m[0], r.kind, m[1]) for r in secret_scan.BASE + secret_scan.ADDED for m in secret_scan.matches(r, text or "")]


def test_secrets_of_the_index_are_those_of_a_full_search(spark):
    rng = random.Random(12)
    bits = ["password", "PASSWD", "token", "Secret", "api_key", "APIKEY", "=", ":", " ", "  ", '"', "'", "abcdefg", "abcdefgh", "xK9/+_.=-", "AKIA", "ABCDEFGHIJKL", "é", "\n",
            "0123456789abcdef", "ghp_", "a" * 36, "xoxb-", "eyJ", ".eyJ", "-----BEGIN RSA PRIVATE KEY-----", "-----END RSA PRIVATE KEY-----", "https://", "user", "@host", "bearer ", "AIza", "sk_live_", "ſecret: "]
    rows = [(i, "".join(rng.choice(bits) for _ in range(rng.randint(0, 25)))) for i in range(1500)]
    rows += [(None, "token=abcdefgh"), (1, None), (1, ""), (2, "password: hunter2"), (2, "password: hunter22"), (3, "token: secret: abcdefghij"),
             (4, "x " * 300_000 + "api_key = 'k3y-of-a-long-text'" + " y" * 300_000), (5, "ſecret=abcdefgh"), (6, "eyJabcdefgh.eyJabcdefgh.abcdefgh")]
    got = [(r["doc_id"], [(s["first"], s["kind"], s["end"]) for s in r["spans"]])
           for r in secret_scan.find_secrets(spark.createDataFrame(rows, "doc_id long, text string")).collect()]
    kinds = [r.kind for r in secret_scan.BASE + secret_scan.ADDED]
    want = [(i, sorted(slow_spans(t), key=lambda s: (s[0], kinds.index(s[1])))) for i, t in rows]
    assert sorted(got, key=str) == sorted(want, key=str)
    assert {k for _, spans in want for _, k, _ in spans} == set(kinds)
    assert dict(got)[3] == [] and dict(got)[5] == []


def test_matches_satisfy_their_query():
    rng = random.Random(1)
    letters = "abAB01_=:. -/@"
    for rule in secret_scan.BASE + secret_scan.ADDED:
        q = secret_scan.trigram_query(rule.pattern)
        index = secret_scan.Index(secret_scan.trigrams(q))
        texts = ["".join(rng.choice(letters) for _ in range(20)) for _ in range(50)] + ["token = x", "AKIA0", "f" * 32, "Bearer " + "x" * 16, "gho_" + "a" * 36,
                 "AIza" + "b" * 35, "eyJabcdefgh.eyJabcdefgh.abcdefgh", "-----BEGIN PRIVATE KEY-----", "xoxs-0123456789", "rk_live_" + "a" * 24, "ftp://a:b@"]
        hold = set(index.load([t.encode() for t in texts]).rows(q).tolist())
        hit = {i for i, t in enumerate(texts) if re.search(rule.pattern, t, re.A)}
        assert hit and hit <= hold


# --- whitening ----------------------------------------------------------------------------

def slow_whiten(vectors, k=8):
    x = np.floor(1024 * np.array(vectors, np.float64)).astype(np.int64) + 100000
    z = x - x.mean(axis=0)
    e, u = np.linalg.eigh(z.T @ z / len(x))
    e, u = e[::-1][:k], u[:, ::-1][:, :k]
    far = [sum((len(x) * c - s) ** 2 for c, s in zip(r, x.sum(axis=0).tolist())) for r in x.tolist()]
    return e / (z * z).sum() * len(x), z @ u / np.sqrt(e), far


@pytest.mark.parametrize("dims,rows,repeat", [(5, 200, 1), (48, 300, 1), (3, 7, 3)])
def test_whitened_vectors(spark, dims, rows, repeat):
    rng = np.random.default_rng(dims)
    v = (rng.standard_normal((rows, dims)) @ rng.standard_normal((dims, dims))).astype(np.float32).tolist() * repeat
    bad = [(-1, None), (-2, []), (-3, [None] * dims), (-4, [float("nan")] * dims), (-5, [float("inf")] * dims), (-6, [1.0]), (-7, [1e30] * dims)]
    table = spark.createDataFrame([*enumerate(v), *bad], "vec_id long, embedding array<float>").withColumn("component", F.lit("x"))
    out = whitening.whiten(table).collect()
    share, w, far = slow_whiten(v)
    k = min(8, dims)
    assert len(out) == len(v) * k and {r["n"] for r in out} == {len(v)}
    assert max(r["identity_error"] for r in out) < 1e-9
    for c in range(k):
        got = {r["vec_id"]: r for r in out if r["component"] == c + 1}
        mine = np.array([got[i]["whitened"] for i in range(len(v))])
        assert min(abs(mine - w[:, c]).max(), abs(mine + w[:, c]).max()) < 1e-8
        assert abs(got[0]["explained"] - share[c]) < 1e-12
        assert [got[i]["deviation"] for i in range(len(v))] == far


def test_vectors_that_cannot_be_whitened(spark):
    schema = "vec_id long, embedding array<float>"
    assert whitening.whiten(spark.createDataFrame([], schema)).count() == 0
    assert whitening.whiten(spark.createDataFrame([(None, [1.0, 2.0])] * 3, schema)).count() == 0
    flat = whitening.whiten(spark.createDataFrame([(None, [1.0, 2.0]), (1, [1.0, 3.0]), (1, [1.0, 3.0])], schema)).collect()
    assert [(r["vec_id"], r["component"]) for r in sorted(flat, key=str)] == [(1, 1), (1, 1), (None, 1)]
    assert abs(sum(r["whitened"] ** 2 for r in flat) / 3 - 1) < 1e-12


def test_components_of_close_and_equal_eigenvalues():
    rng = np.random.default_rng(3)
    u = np.linalg.qr(rng.standard_normal((120, 120)))[0]
    e = np.sort(np.concatenate(([9, 9, 5, 4.99, 4.98, 4], 1 + rng.random(114))))[::-1]
    v = u * e @ u.T
    values, vectors = whitening.components(lambda q: v @ q, 120, 6)
    assert abs(values - e[:6]).max() < 1e-10 and abs(v @ vectors - vectors * values).max() < 1e-9
    assert abs(vectors.T @ vectors - np.eye(6)).max() < 1e-12


def test_deviations_beyond_a_long_are_null():
    x = np.array([[0], [1 << 40]], np.int64)
    assert whitening.deviations(x, 2, [1 << 40], 0, 1 << 40) == [None, None]
    assert whitening.deviations(np.array([[3]], np.int64), 1, [1], 3, 3) == [4]
