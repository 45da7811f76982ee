"""Operators that compare documents with each other, and the pipeline."""

import hashlib
import random
import re
import struct
import sys
from bisect import bisect_right
from collections import Counter

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

import corpus_pipeline
from docweave.llm import mixing, orderminhash, quality, repeats, simhash
from docweave.llm.components import connected_components

WORD = re.compile(r"[^\x20\x09-\x0D]+")
MASK = (1 << 64) - 1


def roots(n, edges):
    label = list(range(n))

    def find(x):
        while label[x] != x:
            x = label[x]
        return x

    for a, b in edges:
        a, b = find(a), find(b)
        if a != b:
            label[max(a, b)] = min(a, b)
    return [find(i) for i in range(n)]


# components


@pytest.mark.parametrize("kind", ["chain", "star", "random", "none"])
def test_components(spark, kind):
    rng = random.Random(1)
    edges = {"chain": [(i, i + 1) for i in range(60)], "star": [(50, i) for i in range(50)], "random": [(rng.randrange(80), rng.randrange(80)) for _ in range(50)], "none": []}[kind]
    df = spark.createDataFrame(edges + [(None, 1), (2, 2)], "a long, b long")
    want = roots(100, edges)
    got = {r.node: r.root for r in connected_components(df).collect()}
    assert got == {i: want[i] for e in edges if e[0] != e[1] for i in e}


# near duplicates


def plain_fingerprint(text, shingle=4):
    ws = WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    grams = [" ".join(ws[i : i + shingle]) for i in range(len(ws) - shingle + 1)] if len(ws) >= shingle else [" ".join(ws)] if ws else []
    h = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def plain_groups(rows, shingle=4, budget=4):
    """(id, text) -> (fingerprint, least id of the component) in order; null ids last."""
    prints = [plain_fingerprint(t, shingle) for _, t in rows]
    n = len(rows)
    found = roots(n, [(i, j) for i in range(n) for j in range(i) if (prints[i] ^ prints[j]).bit_count() <= budget])
    least = {}
    for (d, _), r in zip(rows, found):
        if d is not None:
            least[r] = min(d, least.get(r, d))
    return [(p, least.get(r)) for p, r in zip(prints, found)]


def test_simhash_by_plain_code(spark, sf, table_of):
    docs = table_of("documents")
    rows = list(zip(docs.doc_id.tolist(), docs.text))
    got = {r.doc_id: (r.fingerprint, r.component_id) for r in simhash.op9_simhash(spark, sf).collect()}
    assert got == {d: (f"{p:016x}", c) for (d, _), (p, c) in zip(rows, plain_groups(rows))}


def test_simhash_of_odd_documents(spark, odd, folder_of):
    rows = [(r.doc_id, r.text) for r in odd.collect()]
    got = simhash.op9_simhash(spark, folder_of(documents=odd)).collect()
    key = lambda x: (str(x[0]), str(x[1]), str(x[2]))
    want = [(d, f"{p:016x}", c) for (d, _), (p, c) in zip(rows, plain_groups(rows))]
    assert sorted(map(tuple, got), key=key) == sorted(want, key=key)
    assert simhash.op9_simhash(spark, folder_of(documents=odd.limit(0))).count() == 0


def clustered(seed):
    """Distinct numbers of 64 bits: clusters around random centres."""
    rng = random.Random(seed)
    prints = {rng.getrandbits(64) for _ in range(100)}
    for c in sorted(prints)[:20] + [0, MASK]:
        for _ in range(15):
            prints.add(c ^ sum(1 << b for b in rng.sample(range(64), rng.randint(0, 4))))
    return sorted(prints)


@pytest.mark.parametrize("budget, sizes", [(4, {}), (4, {"subtree": 0}), (1, {"piece": 2, "chunk": 7}), (8, {"piece": 10}), (8, {"subtree": 0, "piece": 1, "chunk": 20}), (0, {})])
def test_tries_find_all_links(spark, budget, sizes):
    """More blocks on top, subtrees that are cut, and groups that come in several batches give the same links."""
    prints = clustered(budget)
    signed = [p - (1 << 64) if p >> 63 else p for p in prints]
    edges = simhash.links(spark.createDataFrame([(s,) for s in signed], "fp long"), budget, **sizes).collect()
    at = {s: i for i, s in enumerate(signed)}
    near = [(i, j) for i in range(len(prints)) for j in range(i) if (prints[i] ^ prints[j]).bit_count() <= budget]
    assert roots(len(prints), [(at[e.a], at[e.b]) for e in edges]) == roots(len(prints), near)
    assert all((prints[at[e.a]] ^ prints[at[e.b]]).bit_count() <= budget for e in edges)


@pytest.mark.parametrize("frontier", [10, 500_000])
def test_node_pairs_are_pruned(frontier):
    """The traversal meets few of the row pairs; with a budget that prunes nothing it meets them all."""
    rng = np.random.default_rng(2)
    value = np.unique(np.concatenate([rng.integers(0, 1 << 63, 3000, dtype=np.uint64), np.uint64(77) ^ (np.uint64(1) << rng.integers(0, 40, 60, dtype=np.uint64))]))
    n = len(value)
    whole = tuple(np.array([x]) for x in (0, 0, n, 0, n, 0))
    tally = {}
    i, j = simhash.forest(value, whole, 3, frontier, tally)
    near = np.triu(np.bitwise_count(value[:, None] ^ value[None, :]) <= 3, 1)
    assert roots(n, zip(i.tolist(), j.tolist())) == roots(n, zip(*(x.tolist() for x in np.nonzero(near)))) and len(i) == n - len(set(roots(n, zip(i.tolist(), j.tolist()))))
    assert tally["rows"] < n * n / 20 and tally["nodes"] > tally["rows"]
    # what is connected already is not visited again: a dense cluster costs far less than its pairs
    dense = np.arange(1 << 11, dtype=np.uint64)
    tally = {}
    i, j = simhash.forest(dense, tuple(np.array([x]) for x in (0, 0, len(dense), 0, len(dense), 0)), 4, 64, tally)
    assert len(i) == len(dense) - 1 and tally["rows"] < len(dense) * 40


def shingles(text, n=5):
    ws = WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    return {tuple(ws[i : i + n]) for i in range(max(1, len(ws) - n + 1))} if ws else set()


def are_near(a, b):
    return 10 * len(a & b) >= 8 * len(a | b)


def plain_candidates(rows):
    def one(text):
        ws = set(WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")))
        h = [xxhash.xxh64_intdigest(w.encode(), 42) for w in ws]
        return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))

    prints = [one(t) for _, t in rows]
    return roots(len(rows), [(i, j) for i in range(len(rows)) for j in range(i) if (prints[i] ^ prints[j]).bit_count() <= simhash.CANDIDATE_BUDGET])


def plain_near_copies(rows):
    """(id, text) by id -> the rows that stay: of each component of near pairs within a candidate group the first."""
    sets = [shingles(t) for _, t in rows]
    group = plain_candidates(rows)
    label = roots(len(rows), [(i, j) for i in range(len(rows)) for j in range(i) if group[i] == group[j] and are_near(sets[i], sets[j])])
    return [r for i, r in enumerate(rows) if label[i] == i]


def test_near_copies_by_plain_code(spark, table_of, sf):
    rows = sorted(zip(table_of("documents").doc_id.tolist(), table_of("documents").text))
    got = simhash.drop_near_copies(spark.read.parquet(f"{sf}/documents.parquet")).collect()
    assert sorted((r.doc_id, r.text) for r in got) == plain_near_copies(rows)


def test_near_classes_against_all_pairs():
    rng = random.Random(3)
    for _ in range(30):
        base = [[f"w{rng.randrange(60)}" for _ in range(rng.randint(0, 60))] for _ in range(4)]
        texts = []
        for _ in range(30):
            ws = list(rng.choice(base))
            for _ in range(rng.randint(0, 3)):
                if ws:
                    ws[rng.randrange(len(ws))] = rng.choice(["x", "y", "w1"])
            texts.append(" ".join(ws))
        sets = [shingles(t) for t in texts]
        want = roots(30, [(i, j) for i in range(30) for j in range(i) if are_near(sets[i], sets[j])])
        assert simhash.near_classes(texts).tolist() == want


def test_near_copies_go_and_others_stay(spark):
    rng = random.Random(5)
    base = [f"w{rng.randrange(5000)}" for _ in range(400)]
    rows = [(100, " ".join(base))]
    for i in range(40):
        ws = list(base)
        for _ in range(3):
            ws[rng.randrange(400)] = f"x{rng.random()}"
        rows.append((i, " ".join(ws)))
    big = 1 << 60
    rows += [(big + 2 * i + 1, " ".join(f"w{rng.randrange(5000)}" for _ in range(400))) for i in range(30)]
    rows += [(300, "short text"), (301, "short text"), (302, "short tale"), (None, "short text"), (303, None), (304, ""), (None, "no id here"), (None, "no id here")]
    for sizes in ({}, {"piece": 3}, {"chars": 5000}):
        got = [r.doc_id for r in simhash.drop_near_copies(spark.createDataFrame(rows, "doc_id long, text string"), **sizes).collect()]
        assert sorted(g for g in got if g is not None) == sorted([0, 300, 302, 303, *(big + 2 * i + 1 for i in range(30))]) and got.count(None) == 1


def test_near_copies_keep_columns(spark):
    rows = [(1, "a b c", "x", 5), (1, "a b c", "x", 6), (2, "d e f", "y", 7)]
    df = spark.createDataFrame(rows, "doc_id long, text string, _key string, fp int")
    got = simhash.drop_near_copies(df)
    assert got.columns == df.columns and sorted((r.doc_id, r._key) for r in got.collect()) == [(1, "x"), (2, "y")]


def test_recall_of_near_copies(spark):
    """Of the pairs of different texts with an index of 0.8 or more at least 0.9 end up in one class (README has the figure for sf0.1)."""
    rng = random.Random(11)
    pairs = []
    for i in range(150):
        ws = [f"w{rng.randrange(3000)}" for _ in range(rng.randint(80, 400))]
        other = list(ws)
        for k in rng.sample(range(len(ws)), max(1, len(ws) // 50)):
            other[k] = f"e{rng.random()}"
        if are_near(shingles(" ".join(ws)), shingles(" ".join(other))):
            pairs += [(2 * i, " ".join(ws)), (2 * i + 1, " ".join(other))]
    got = simhash.drop_near_copies(spark.createDataFrame(pairs, "doc_id long, text string")).count()
    assert len(pairs) > 100 and (len(pairs) - got) / (len(pairs) / 2) >= 0.9


# order min-hash


def _long(v, seed):
    return xxhash.xxh64_intdigest(struct.pack("<Q", v & MASK), seed)


def plain_order_minhash(text):
    o, ws = orderminhash, WORD.findall(text or "")
    if not ws:
        return "0" * 4 * o.COMPONENTS

    def chain(values):
        seed = 42
        for v in values:
            seed = _long(v, seed)
        return seed

    h = [xxhash.xxh64_intdigest(w.encode(), 42) for w in ws]
    if len(ws) < o.SHINGLE:
        seed = 42
        for w in ws:
            seed = xxhash.xxh64_intdigest(w.encode(), seed)
        ks = [seed]
    else:
        ks = [chain(h[i : i + o.SHINGLE]) for i in range(len(h) - o.SHINGLE + 1)]
    seen, ring = {}, []
    for i, k in enumerate(ks):
        k >>= 32
        n = seen[k] = seen.get(k, -1) + 1
        ring.append((xxhash.xxh64_intdigest(struct.pack("<i", n), _long(k, 42)) >> 32, i))
    ring.sort()
    out, step = [], (1 << 32) // o.COMPONENTS
    for j in range(o.COMPONENTS):
        first = bisect_right(ring, (j * step + step // 2, o.PLACE))
        picked = sorted(ring[(first + t) % len(ring)][::-1] for t in range(o.TUPLE))
        out.append(f"{chain([x for _, x in picked]) & 0xFFFF:04x}")
    return "".join(out)


def plain_edited(rows):
    """(id, text) in order -> edited texts."""
    out = []
    for i, (_, t) in enumerate(rows):
        q = len(t) // 4
        out.append(t[: len(t) - q] + rows[(i + 1) % len(rows)][1][:q])
    return out


def test_order_minhash_by_plain_code(spark, sf, table_of):
    docs = table_of("documents").sort_values("doc_id")
    rows = list(zip(docs.doc_id.tolist(), docs.text))
    got = {r.doc_id: r for r in orderminhash.op4_order_minhash(spark, sf).collect()}
    prints = [plain_order_minhash(t) for _, t in rows]
    alike = lambda a, b: sum(a[i : i + 4] == b[i : i + 4] for i in range(0, len(a), 4)) / orderminhash.COMPONENTS
    for i, ((d, t), e) in enumerate(zip(rows, plain_edited(rows))):
        r = got[d]
        assert (r.n_chars, r.edited_sha256, r.fingerprint, r.edited_fingerprint) == (len(t), hashlib.sha256(e.encode()).hexdigest(), prints[i], plain_order_minhash(e))
        assert r.near_edited == alike(r.fingerprint, r.edited_fingerprint) and r.near_next == alike(prints[i], prints[(i + 1) % len(rows)])
    long = [r for r in got.values() if r.n_chars > 2000]
    assert sum(r.near_edited for r in long) / len(long) > 0.25 > 0.05 > sum(r.near_next for r in long) / len(long)


def test_order_minhash_sees_order(spark):
    ws = [f"w{i}" for i in range(400)]
    df = spark.createDataFrame([(" ".join(ws),), (" ".join(ws[200:] + ws[:200]),), (" ".join(ws[:398] + ["x", "y"]),)], "text string")
    a, turned, close = (r.f for r in df.select(orderminhash.fingerprint(F.col("text")).alias("f")).collect())
    alike = lambda a, b: sum(a[i : i + 4] == b[i : i + 4] for i in range(0, len(a), 4))
    assert alike(a, close) > 55 > 45 > alike(a, turned)


def true_order_minhash(a, b, rounds, rng):
    """The share of random orders of the numbered k-mers under which both texts select the same ones in the same text order."""

    def numbered(ws):
        seen = Counter()
        out = []
        for i in range(len(ws) - orderminhash.SHINGLE + 1):
            k = tuple(ws[i : i + orderminhash.SHINGLE])
            out.append((k, seen[k]))
            seen[k] += 1
        return out

    a, b = numbered(a), numbered(b)
    agree = 0
    for _ in range(rounds):
        order = {k: rng.random() for k in {*a, *b}}
        first = [[k for k in x if k in set(sorted(set(x), key=order.get)[: orderminhash.TUPLE])] for x in (a, b)]
        agree += first[0] == first[1]
    return agree / rounds


@pytest.mark.parametrize("n", [30, 120])
def test_likeness_is_that_of_independent_orders(spark, n):
    """Bias and spread against true Order MinHash, for short and for longer texts."""
    rng = random.Random(n)
    pairs = []
    for i in range(60):
        ws = [f"w{rng.randrange(40)}" for _ in range(n)]
        other = list(ws)
        if i % 3:
            for k in rng.sample(range(n), n // 30):
                other[k] = f"x{rng.random()}"
        else:
            cut = rng.randrange(n)
            other = other[cut:] + other[:cut]
        pairs.append((ws, other))
    df = spark.createDataFrame([(" ".join(a), " ".join(b)) for a, b in pairs], "a string, b string")
    got = [r.x for r in df.select(orderminhash.likeness(orderminhash.fingerprint(F.col("a")), orderminhash.fingerprint(F.col("b"))).alias("x")).collect()]
    want = [true_order_minhash(a, b, 200, rng) for a, b in pairs]
    off = np.array(got) - np.array(want)
    # one ring: no bias; the spread is that of at most n - 4 independent components instead of 64
    assert abs(off.mean()) < 0.04 and off.std() < 1.6 * (0.25 / min(n - 4, 64) + 0.25 / 200) ** 0.5


def test_order_minhash_of_odd_documents(spark, odd, folder_of):
    got = orderminhash.op4_order_minhash(spark, folder_of(documents=odd)).collect()
    assert len(got) == 11
    by_id = {r.doc_id: r for r in got if r.doc_id in (1, 2, 3, 4, 6, 7)}
    assert by_id[2].fingerprint == by_id[3].fingerprint == by_id[4].fingerprint == "0" * 256
    assert by_id[2].near_next == 1.0 and by_id[2].n_chars == 0 and by_id[4].n_chars == 5
    long, tail = (next(r.text for r in odd.collect() if r.doc_id == d) for d in (6, 7))
    q = len(long) // 4
    assert by_id[6].edited_sha256 == hashlib.sha256((long[: len(long) - q] + tail[:q]).encode()).hexdigest()
    assert len({r.fingerprint for r in got if r.n_chars == len(long)}) == 1
    single = orderminhash.op4_order_minhash(spark, folder_of(documents=odd.where("doc_id = 7"))).collect()
    assert [r.near_next for r in single] == [1.0]
    assert orderminhash.op4_order_minhash(spark, folder_of(documents=odd.limit(0))).count() == 0


# repeats


def plain_cut(rows):
    """(id, text) -> (words, which of them go). Rows of one id, or without one, are one document."""
    first, out = {}, []
    texts = [(d if d is not None else 1 << 63, WORD.findall(t or "")) for d, t in rows]
    for d, ws in texts:
        for j in range(len(ws) - 19):
            k = tuple(ws[j : j + 20])
            first[k] = min(first.get(k, (d, j)), (d, j))
    for d, ws in texts:
        gone = [False] * len(ws)
        for j in range(len(ws) - 19):
            if first[tuple(ws[j : j + 20])] != (d, j):
                gone[j : j + 20] = [True] * 20
        out.append((ws, gone))
    return out


def check_cut(got, rows):
    want = []
    for (d, _), (ws, gone) in zip(rows, plain_cut(rows)):
        kept = " ".join(w for w, g in zip(ws, gone) if not g)
        want.append((d, len(ws), sum(gone), hashlib.sha256(kept.encode()).hexdigest()))
    key = lambda x: (str(x[0]), x[1], x[3])
    assert sorted(map(tuple, got), key=key) == sorted(want, key=key)


def test_repeats_by_plain_code(spark, sf, table_of):
    docs = table_of("documents").sort_values("doc_id")
    check_cut(repeats.op6_repeats(spark, sf).collect(), list(zip(docs.doc_id.tolist(), docs.text)))


def digests(df):
    joined = F.regexp_replace(F.trim("kept"), r"\s+", " ")
    return df.select("doc_id", "n_words", "n_removed", F.sha2(joined, 256)).collect()


def passages_of(rng, n):
    passages = [[f"p{k}_{i}" for i in range(rng.randint(15, 60))] for k in range(6)]
    rows = []
    for d in range(n):
        ws = []
        for _ in range(rng.randint(0, 4)):
            p = rng.choice(passages)
            cut = rng.randrange(len(p)) if rng.random() < 0.4 else 0
            ws += [rng.choice(["x", "y", f"u{d}_{rng.random()}"]) for _ in range(rng.randint(0, 30))] + p[cut:] + (p[:30] if rng.random() < 0.2 else [])
        rows.append((d, " ".join(ws)))
    return rows


@pytest.mark.parametrize("sizes", [{}, {"chunk": 2_000, "rows_per_shard": 3, "per_task": 50}])
def test_repeats_within_and_across(spark, sizes):
    """Small chunks, many automata and many tasks give the same as large ones."""
    rows = passages_of(random.Random(3), 60)
    rows += [(60, "same " * 50), (61, "same " * 25), (62, "a b c d e " * 12)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    check_cut(digests(repeats.remove_repeats(df, **sizes)), rows)


def test_what_is_cut_follows_from_the_hits(spark, monkeypatch):
    """Passages are confirmed before they are compiled; the automaton finds every occurrence, word for word, and without its hits nothing is cut."""
    rows = passages_of(random.Random(4), 40)
    df = spark.createDataFrame(rows, "doc_id long, text string")
    keyed = repeats.sharded(df, 1_000).coalesce(1)
    root = spark.conf.get("spark.checkpoint.dir") + "/confirmed"
    anchors = repeats._write_by_shard(repeats.repeated_anchors(keyed, 3), root, 2)
    found = repeats.passages(repeats.segments(keyed, anchors), 3).drop("_shard").distinct().collect()
    texts = [WORD.findall(t) for _, t in rows]
    windows = Counter(tuple(ws[i : i + 20]) for ws in texts for i in range(len(ws) - 19))
    told = set()
    for r in found:
        own = texts[r.doc_id][r.place : r.place + 19 + r.length]
        mine = [tuple(own[i : i + 20]) for i in range(r.length)]
        assert r.words == " ".join(own[:20]) and len({windows[w] for w in mine}) == 1 < windows[mine[0]] and not told & set(mine)
        told |= set(mine)
    assert told == {w for w, n in windows.items() if n > 1} and len(found) < len(told) / 2
    chunk, ids = repeats.Chunk([t for _, t in rows]), np.arange(len(rows))
    columns = {c: t for c, t in repeats.PASSAGE.items() if c != "_shard"}
    matcher = repeats.Matcher(repeats.pa.Table.from_batches([repeats._batch([tuple(r[c] for c in columns) for r in found], columns)]))
    at, facts = matcher.occurrences(chunk)
    hits = {(int(i), *map(int, f)) for i, f in zip(at, facts)}
    want = {(int(chunk.starts[d]) + i, r.doc_id, r.place, r.length) for r in found for d, ws in enumerate(texts) for i in range(len(ws) - 19) if " ".join(ws[i : i + 20]) == r.words}
    assert hits == want and len(want) > len(found)
    assert repeats.covered(chunk, ids, matcher).any()
    monkeypatch.setattr(matcher, "occurrences", lambda chunk: (np.zeros(0, np.int64), np.zeros((0, 3), np.int64)))
    assert not repeats.covered(chunk, ids, matcher).any()


def test_repeats_of_tied_and_large_ids(spark):
    """Documents that share an id or have none, and ids beyond 2^53."""
    rng = random.Random(9)
    p = [f"p{i}" for i in range(70)]
    big = 1 << 60
    rows = [(5, " ".join(["a"] + p[:40])), (5, " ".join(["b"] + p[5:60])), (5, " ".join(["a"] + p[:40])), (big + 1, " ".join(p)), (big + 3, " ".join(p[20:])), (big, " ".join(["z"] * 3 + p[30:]))]
    rows += [(None, " ".join([f"n{i}"] + p[:30] + [str(rng.random()) for _ in range(5)] + ["q"] * 25)) for i in range(4)] + [(None, None)]
    rows.sort(key=lambda r: (r[0] is None, r[0] or 0))
    for sizes in ({}, {"chunk": 300, "rows_per_shard": 1, "per_task": 10}):
        check_cut(digests(repeats.remove_repeats(spark.createDataFrame(rows, "doc_id long, text string"), **sizes)), rows)


def test_repeats_of_odd_documents(spark, odd, folder_of):
    got = repeats.op6_repeats(spark, folder_of(documents=odd)).collect()
    rows = sorted(((r.doc_id, r.text) for r in odd.collect()), key=lambda r: (r[0] is None, r[0] or 0))
    check_cut(got, rows)
    assert repeats.op6_repeats(spark, folder_of(documents=odd.limit(0))).count() == 0
    out = repeats.remove_repeats(odd.withColumn("kept", F.lit("clash"))).collect()
    assert len(out) == 11 and all(r.kept == (r0 or "") for r, r0 in [(x, x.kept) for x in out])


def test_cut_texts_keep_their_lines(spark):
    passage = " ".join(f"q{i}" for i in range(25))
    df = spark.createDataFrame([(1, f"first  line\n{passage}"), (2, f"own  text\n{passage}\nmixed {passage} end\n\nlast")], "doc_id long, text string")
    assert [r.kept for r in repeats.remove_repeats(df).orderBy("doc_id").collect()] == [f"first  line\n{passage}", "own  text\nmixed end\n\nlast"]


def test_words_are_coded_in_arrays():
    """A chunk keeps no object for each of its words, which cost a third of op6's time."""
    text = " ".join(f"w{i % 977}" for i in range(60_000))
    before = sys.getallocatedblocks()
    chunk = repeats.Chunk([text])
    assert len(chunk.codes) == 60_001 and sys.getallocatedblocks() - before < 6_000


def test_words_of_a_chunk():
    texts = ["", " ", "a", "\t\n\x0b\x0c\r a  b\x0bc\x0cd\re\n", "\x1c \x85 \xa0\u2003x \x00 \x00\x00", "a b", ""]
    for some in (texts, [], texts[:1], texts[3:4]):
        chunk, words = repeats.Chunk(some), [WORD.findall(t) for t in some]
        names = chunk.vocabulary.to_pylist()
        assert [[names[c] for c in chunk.codes[b : b + n]] for b, n in zip(chunk.starts, chunk.sizes)] == words
        assert [names[c] for c in chunk.codes] == [w for ws in words for w in ["", *ws]]
        assert chunk.doc.tolist() == [i for i, ws in enumerate(words) for _ in range(len(ws) + 1)]


def test_automata_read_stretches_of_their_own_words():
    """Words that no passage has are one break, however many they are; hits are at their places in the whole text."""
    p, q = [f"p{i}" for i in range(20)], [f"p{i}" for i in range(5, 25)]
    columns = {c: t for c, t in repeats.PASSAGE.items() if c != "_shard"}
    found = repeats._batch([(" ".join(ws), 1, k, 0) for k, ws in ((1, p), (2, q))], columns)
    matcher, letters = repeats.Matcher(repeats.pa.Table.from_batches([found])), []

    class Recorder:
        def __init__(self, automaton):
            self.automaton = automaton

        def iter(self, text):
            letters.append(len(text))
            return self.automaton.iter(text)

    matcher.automaton = Recorder(matcher.automaton)
    texts = [p[:19] + ["x"] * 500 + p + p[:3], p[1:], ["y"] * 900, ["p3"] * 30 + q[1:] + ["z"] + q, p + q, []]
    chunk = repeats.Chunk([" ".join(ws) for ws in texts])
    at, facts = matcher.occurrences(chunk)
    hits = sorted((int(i), int(f[0])) for i, f in zip(at, facts))
    want = [(int(chunk.starts[d]) + i, k) for d, ws in enumerate(texts) for i in range(len(ws)) for k, w in ((1, p), (2, q)) if ws[i : i + 20] == w]
    assert hits == sorted(want) and len(want) == 4
    assert sum(letters) == 2 * sum(1 + n for n in (23, 49, 20, 40))


# pipeline


def test_pipeline_by_plain_code(spark, sf, table_of):
    """All stages against plain versions; the mix and the quality model, whose own tests do that, are taken as they are."""
    docs = table_of("documents").sort_values("doc_id").reset_index(drop=True)
    kept = {r.doc_id for r in quality.op3_quality(spark, sf).where("kept").collect()}
    rows = [(d, t) for d, t in zip(docs.doc_id.tolist(), docs.text) if d in kept]
    rows = plain_near_copies(rows)
    left = {d: [w for w, g in zip(ws, gone) if not g] for (d, _), (ws, gone) in zip(rows, plain_cut(rows))}
    left = {d: ws for d, ws in left.items() if ws}
    source = dict(zip(docs.doc_id.tolist(), docs.source))
    light = spark.createDataFrame([(d, source[d], len(ws)) for d, ws in left.items()], "doc_id long, source string, size long")
    times = {r.doc_id: r.n for r in mixing.mix(light).where("taken").groupBy("doc_id").agg(F.count("doc_id").alias("n")).collect()}
    got = corpus_pipeline.run(spark, sf).collect()
    counted = {}
    for r in got:
        counted[r.doc_id] = counted.get(r.doc_id, 0) + 1
        assert r.lossless
    assert counted == times and len(got) > 50


def test_stages_keep_the_columns_of_documents(spark, sf, table_of):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, sf)
        assert out.columns == docs.columns and out.dtypes == docs.dtypes


def test_stages_of_odd_documents(spark, odd, folder_of):
    labels = spark.createDataFrame([(1, 1, 0)], "doc_id long, quality int, toxic int")
    root = folder_of(documents=odd, labels=labels)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, odd, root).count() >= 0
        assert stage(spark, odd.limit(0), root).count() == 0
    assert corpus_pipeline.drop_near_copies(spark, odd, root).where("doc_id = 1").count() == 1
    clash = odd.withColumn("ids", F.lit(1)).withColumn("size", F.lit("x")).withColumn("kept", F.lit(0))
    for _, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, clash, root)
        assert out.columns == clash.columns and {(r.ids, r["size"], r.kept) for r in out.collect()} <= {(1, "x", 0)}
