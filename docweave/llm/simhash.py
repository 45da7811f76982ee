"""SimHash near-duplicates by a self-join of binary tries.

Distinct 64-bit fingerprints stand in binary tries, and pairs of nodes are
traversed together: the differing bits of the two paths add up, and a pair is
left as soon as they exceed the budget. A pair is also left if all fingerprints
below its two nodes are known to be connected already.

To spread the work, the bits are cut into more blocks than the budget. Two
fingerprints within the budget agree in all but `budget` blocks, so for every
choice of the other blocks there is a trie with these on top, and its subtrees
below them are independent of each other. A subtree with very many
fingerprints is cut further down, at a depth of its own: there each pair of
nodes that is within the budget so far is a task.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docweave.llm.common import discard, table, text_or_empty, written
from docweave.llm.components import connected_components

BITS = 64
SEED = 42
#: Bits that the blocks on top have at least, and fingerprints that an average subtree may have; with more, tries have more blocks on top.
LEAST_KEY, SUBTREE = 12, 256
#: Fingerprints of one subtree that one task takes; larger subtrees are cut by up to MOST_CUT further bits.
PIECE, MOST_CUT = 20_000, 12
#: Rows of complete subtrees that are traversed at once, and node pairs on one stack entry.
CHUNK, FRONTIER = 50_000, 200_000


def shingle_hashes(text: str | None, shingle: int) -> np.ndarray:
    """XXH64 of a text's word shingles, in order and repeats included.

    A-Z are lowered; words are separated by U+0020 and U+0009 to U+000D. A
    text with fewer words than a shingle is one shingle; one without words has
    none.
    """
    ws = text.encode().lower().split() if text else []
    if not ws:
        return np.zeros(0, np.uint64)
    digest, seed = xxhash.xxh64_intdigest, SEED
    if shingle == 1:
        return np.fromiter((digest(w, seed) for w in ws), np.uint64, len(ws))
    joined = b" ".join(ws)
    n = len(ws) - shingle + 1
    if n <= 1:
        return np.array([digest(joined, seed)], np.uint64)
    starts = np.zeros(len(ws), dtype=np.int64)
    np.cumsum(np.fromiter(map(len, ws), np.int64, len(ws))[:-1] + 1, out=starts[1:])
    ends = (np.append(starts[1:], len(joined) + 1) - 1)[shingle - 1 :].tolist()
    return np.fromiter((digest(joined[s:e], seed) for s, e in zip(starts[:n].tolist(), ends)), np.uint64, n)


def fingerprint(text: str | None, shingle: int, distinct: bool = False) -> int:
    """The SimHash of a text's word shingles as an unsigned number: a bit is 1 if it is set in over half of their hashes; 0 without words. `distinct` counts equal shingles once."""
    hashes = shingle_hashes(text, shingle)
    if distinct:
        hashes = np.unique(hashes)
    ones = np.zeros(BITS, dtype=np.int64)
    for at in range(0, len(hashes), 65536):
        part = hashes[at : at + 65536].astype(">u8").view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(part, axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(ones * 2 > len(hashes)).tobytes(), "big")


def with_fingerprints(docs: DataFrame, text_col: str, shingle: int, distinct: bool = False) -> DataFrame:
    """docs with `fp`, a signed long, in place of the text. Null texts are empty; a column fp gives way."""
    kept = [c for c in docs.columns if c not in (text_col, "fp")]
    rows = docs.select(*[F.col(f"`{c}`") for c in kept], text_or_empty(F.col(f"`{text_col}`")).alias(text_col))
    fields = "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in rows.schema.fields if f.name != text_col)

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            got = np.fromiter((fingerprint(t.as_py(), shingle, distinct) for t in b[text_col]), np.uint64, b.num_rows)
            yield pa.RecordBatch.from_arrays([*[b[c] for c in kept], pa.array(got.astype(np.int64))], [*kept, "fp"])

    return rows.mapInArrow(digest, f"{fields}fp long")


def layouts(budget: int, top: int) -> list[list[tuple[int, int]]]:
    """For each trie the blocks of bits, (first bit from the top, width), in the order that it has them; the first `top` are its key."""
    n = budget + top
    cuts = [round(i * BITS / n) for i in range(n + 1)]
    blocks = [(a, b - a) for a, b in zip(cuts, cuts[1:])]
    return [[*first, *[b for b in blocks if b not in first]] for first in combinations(blocks, top)]


def key_bits(budget: int, top: int) -> int:
    """The least number of bits that a key of `top` blocks has."""
    return min(sum(w for _, w in x[:top]) for x in layouts(budget, top))


def blocks_on_top(n: int, budget: int, subtree: int = SUBTREE) -> int:
    """How many blocks the tries of n fingerprints have on top. Any number finds the same links; more of them make more, smaller subtrees."""
    top = 1
    while top < 4 and budget + top < BITS and (key_bits(budget, top) < LEAST_KEY or n > subtree << key_bits(budget, top)):
        top += 1
    return top


def arranged(fp: np.ndarray, blocks: list[tuple[int, int]]) -> np.ndarray:
    """Fingerprints with their bits in the order of the blocks."""
    out, at = np.zeros(len(fp), np.uint64), 0
    for start, width in blocks:
        at += width
        part = (fp >> np.uint64(BITS - start - width)) & np.uint64((1 << width) - 1)
        out |= part << np.uint64(BITS - at)
    return out


def _spread(nodes: DataFrame, tries: list[list[tuple[int, int]]]) -> DataFrame:
    """(fp, trie, value): each fingerprint as it stands in each trie."""

    def arrange(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            fp = b["fp"].to_numpy()
            for i, blocks in enumerate(tries):
                yield pa.RecordBatch.from_pydict({"fp": fp, "trie": np.full(len(fp), i, np.int32), "value": arranged(fp.view(np.uint64), blocks).view(np.int64)})

    return nodes.select("fp").mapInArrow(arrange, "fp long, trie int, value long")


def forest(value: np.ndarray, pairs: tuple[np.ndarray, ...], budget: int, frontier: int = FRONTIER, tally: dict | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Row pairs that connect just the rows that pairs of at most `budget` differing bits connect: a spanning forest.

    value: numbers, sorted and distinct within each subtree. pairs: pairs of
    nodes to begin with, as arrays (depth, a0, a1, b0, b1, diff): the rows
    [a0, a1) and [b0, b1) have `depth` leading bits in common each, and the
    two prefixes differ in `diff` of them. A node of two equal sides is paired
    with itself. `tally` takes the numbers of node pairs and of row pairs met.
    """
    n = len(value)
    label, left, right = np.arange(n), [], []
    ones: dict[int, np.ndarray] = {}
    changes = np.arange(n)

    def middle(lo: np.ndarray, hi: np.ndarray, depth: np.ndarray) -> np.ndarray:
        """Where the children with the bit at `depth` set begin."""
        out = np.empty(len(lo), np.int64)
        for d in np.unique(depth).tolist():
            if d not in ones:
                ones[d] = np.concatenate(([0], np.cumsum((value >> np.uint64(BITS - 1 - d)) & np.uint64(1), dtype=np.int32)))
            at, c = depth == d, ones[d]
            out[at] = hi[at] - (c[hi[at]] - c[lo[at]])
        return out

    stack = [tuple(np.asarray(x, np.int64) for x in pairs)]
    while stack:
        depth, a0, a1, b0, b1, diff = stack.pop()
        if len(a0) > frontier:
            half = len(a0) // 2
            stack += [tuple(x[half:] for x in (depth, a0, a1, b0, b1, diff)), tuple(x[:half] for x in (depth, a0, a1, b0, b1, diff))]
            continue
        # nodes whose rows are all in one component need no visit
        open_ = (changes[a1 - 1] != changes[a0]) | (changes[b1 - 1] != changes[b0]) | (label[a0] != label[b0])
        depth, a0, a1, b0, b1, diff = (x[open_] for x in (depth, a0, a1, b0, b1, diff))
        if tally is not None:
            tally["nodes"] = tally.get("nodes", 0) + len(a0)
        single = (a1 - a0 == 1) & (b1 - b0 == 1)
        i, j = a0[single], b0[single]
        if len(i):
            # paths of single rows are compared to their end at once
            near = np.bitwise_count(value[i] ^ value[j]) <= budget
            if tally is not None:
                tally["rows"] = tally.get("rows", 0) + len(i)
            i, j = i[near], j[near]
            while len(i):
                p, q = label[i], label[j]
                apart = p != q
                i, j, p, q = i[apart], j[apart], p[apart], q[apart]
                if not len(i):
                    break
                # every root is hung below a smaller one by one pair, so no circle can come of it
                high, first = np.unique(np.maximum(p, q), return_index=True)
                label[high] = np.minimum(p, q)[first]
                left.append(i[first])
                right.append(j[first])
                while not ((up := label[label]) == label).all():
                    label = up
                changes = np.concatenate(([0], np.cumsum(label[1:] != label[:-1])))
        depth, a0, a1, b0, b1, diff = (x[~single] for x in (depth, a0, a1, b0, b1, diff))
        if not len(a0):
            continue
        am, bm = middle(a0, a1, depth), middle(b0, b1, depth)
        cross = a0 != b0
        kids = (
            (depth, a0, am, b0, bm, diff),
            (depth, am, a1, bm, b1, diff),
            (depth, a0, am, bm, b1, diff + 1),
            (depth[cross], am[cross], a1[cross], b0[cross], bm[cross], diff[cross] + 1),
        )
        depth, a0, a1, b0, b1, diff = (np.concatenate(x) for x in zip(*kids))
        keep = (a1 > a0) & (b1 > b0) & (diff <= budget) & ~((a0 == b0) & (a1 - a0 == 1))
        if keep.any():
            stack.append((depth[keep] + 1, *(x[keep] for x in (a0, a1, b0, b1, diff))))
    return (np.concatenate(left), np.concatenate(right)) if left else (np.zeros(0, np.int64),) * 2


KEYS = ["trie", "top", "low", "high"]


def _edges(rows: pa.Table, budget: int, bits: int) -> pa.RecordBatch:
    """Edges of spanning forests of complete groups of KEYS."""
    trie, top, low, high, cut, value, fp = (rows[c].to_numpy() for c in (*KEYS, "cut", "value", "fp"))
    value = value.view(np.uint64)
    begins = np.concatenate(([True], (trie[1:] != trie[:-1]) | (top[1:] != top[:-1]) | (low[1:] != low[:-1]) | (high[1:] != high[:-1])))
    a0 = np.flatnonzero(begins)
    end = np.append(a0[1:], len(value))
    low, high, cut = low[a0], high[a0], cut[a0]
    # of two different nodes the rows of the lower come first
    wide = np.repeat(cut.astype(np.int64), end - a0)
    mine = (value >> (BITS - bits - wide).astype(np.uint64)).astype(np.int64) & ((1 << wide) - 1)
    split = a0 + np.add.reduceat((mine == np.repeat(low, end - a0)).astype(np.int64), a0)
    same = low == high
    b0, a1 = np.where(same, a0, split), np.where(same, end, split)
    diff = np.bitwise_count(low ^ high).astype(np.int64)
    some = (a1 > a0) & (end > b0) & ~(same & (a1 - a0 == 1))
    i, j = forest(value, tuple(x[some] for x in (bits + cut.astype(np.int64), a0, a1, b0, end, diff)), budget)
    return pa.RecordBatch.from_pydict({"a": fp[i], "b": fp[j]})


def links(nodes: DataFrame, budget: int = 4, subtree: int = SUBTREE, piece: int = PIECE, chunk: int = CHUNK) -> DataFrame:
    """nodes (fp, distinct) -> edges (a, b) of fingerprints that connect just what pairs of at most `budget` differing bits connect.

    Each task gives a spanning forest of its links, so dense groups give no
    more edges than they have members.
    """
    top = blocks_on_top(nodes.count(), budget, subtree)
    # all tries have the same number of bits on top, so keys of wider blocks stop short
    bits, tries = key_bits(budget, top), layouts(budget, top)
    spread = _spread(nodes, tries).withColumn("top", F.shiftrightunsigned("value", BITS - bits))
    # a subtree over `piece` is cut at a depth that leaves about so many fingerprints below a node
    large = spread.groupBy("trie", "top").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > piece)
    large = large.select("trie", "top", F.least(F.lit(MOST_CUT), F.lit(BITS - bits), F.ceil(F.log2(F.col("n") / piece)).cast("int")).alias("cut"))
    sized = spread.join(large, ["trie", "top"], "left").withColumn("cut", F.coalesce("cut", F.lit(0)))
    masks = F.filter(F.expr("sequence(0, shiftleft(1, cut) - 1)"), lambda m: F.bit_count(m) <= budget)
    mine = F.when(F.col("cut") > 0, F.expr(f"shiftrightunsigned(shiftleft(value, {bits}), {BITS} - cut)")).otherwise(0).cast("int")
    # of an uncut subtree there is the one pair (0, 0)
    paired = sized.withColumn("_p", mine).withColumn("_m", F.explode(masks))
    other = F.col("_p").bitwiseXOR(F.col("_m"))
    rows = paired.select(*KEYS[:2], F.least("_p", other).alias("low"), F.greatest("_p", other).alias("high"), "cut", "value", "fp")

    def traverse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = [], 0
        for b in batches:
            held.append(b)
            n += b.num_rows
            if n < chunk:
                continue
            rows = pa.Table.from_batches(held)
            last = np.logical_and.reduce([rows[k].to_numpy() == rows[k][-1].as_py() for k in KEYS])
            cut = int(np.argmax(last))
            if cut:
                yield _edges(rows.slice(0, cut), budget, bits)
            held = rows.slice(cut).to_batches()
            n -= cut
        if n:
            yield _edges(pa.Table.from_batches(held), budget, bits)

    # the bits on top are equal within a group, so the signed order is the order of the tries
    return rows.repartition(*KEYS).sortWithinPartitions(*KEYS, "value").mapInArrow(traverse, "a long, b long")


def near_groups(docs: DataFrame, shingle: int = 4, budget: int = 4, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, fp, component_id): component_id is the least id that a document reaches over links of at most `budget` differing bits.

    Texts without words have fingerprint 0 and are linked like any other.
    Null ids are kept; a component of null ids only has component_id null.
    Repeated rows all come back. Further columns are ignored, so none can
    clash. An empty table gives an empty one.
    """
    rows = docs.select(F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{text_col}`").alias("_text"))
    printed = written(with_fingerprints(rows, "_text", shingle), "fingerprints")
    nodes = written(printed.groupBy("fp").agg(F.min("doc_id").alias("least")), "nodes")
    roots = connected_components(links(nodes.select("fp"), budget), "simhash")
    placed = nodes.join(roots, nodes["fp"] == roots["node"], "left").select("fp", "least", F.coalesce("root", "fp").alias("root"))
    placed = written(placed, "placed")
    discard(nodes)
    named = placed.groupBy("root").agg(F.min("least").alias("component_id"))
    classes = placed.select("fp", "root").join(named, "root").select("fp", "component_id")
    return printed.join(classes, "fp").select("doc_id", "fp", "component_id")


def op9_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents with fingerprint and component."""
    found = near_groups(table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


#: Near copies: the word shingles whose Jaccard index decides, and its least value.
COPY_SHINGLE, COPY_LEAST = 5, 0.8
#: Candidates for near copies are linked by fingerprints of the distinct words, which changed words disturb least, within this budget.
CANDIDATE_BUDGET = 7
#: Documents and characters of a candidate group that one task compares with as many others.
COPY_PIECE, COPY_CHARS = 2_000, 4_000_000


def near_classes(texts: list[str], shingle: int = COPY_SHINGLE, least: float = COPY_LEAST) -> np.ndarray:
    """For each text the number of the first text that it reaches over pairs whose sets of shingles have a Jaccard index of at least `least`.

    Exact: a text is compared with all others by counting its shingles in an
    inverted index, until the texts that are left are known to be connected.
    Texts without shingles are near each other.
    """
    sets = [np.unique(shingle_hashes(t, shingle)) for t in texts]
    n, sizes = len(sets), np.array([len(s) for s in sets])
    _, ids = np.unique(np.concatenate(sets), return_inverse=True)
    holders = np.repeat(np.arange(n), sizes)[np.argsort(ids, kind="stable")]
    bounds = np.concatenate(([0], np.cumsum(np.bincount(ids))))
    edges = np.concatenate(([0], np.cumsum(sizes)))
    label, left = np.arange(n), np.ones(n, bool)
    while True:
        counts = np.bincount(label[left], minlength=n)
        most = int(np.argmax(counts))
        outside = np.flatnonzero(left & (label != most))
        if not len(outside):
            return label
        i = int(outside[0])
        mine = ids[edges[i] : edges[i + 1]]
        lists = [holders[bounds[k] : bounds[k + 1]] for k in mine.tolist()]
        both = np.bincount(np.concatenate(lists), minlength=n) if lists else np.zeros(n, np.int64)
        near = both + 1e-9 >= least * (sizes[i] + sizes - both)
        joined = np.unique(label[near | (np.arange(n) == i)])
        label[np.isin(label, joined)] = joined[0]
        left[i] = False


def _near_edges(members: DataFrame, shingle: int, least: float) -> DataFrame:
    """members (_group, _low, _high, _sum, _text) -> edges (a, b) of _sum that connect the near copies within each (_group, _low, _high)."""
    keys = ["_group", "_low", "_high"]

    def connect(sums: list, texts: list) -> Iterator[tuple]:
        once = dict(zip(sums, texts))
        names = list(once)
        for i, root in enumerate(near_classes(list(once.values()), shingle, least).tolist() if len(names) > 1 else []):
            if root != i:
                yield names[i], names[root]

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, sums, texts = None, [], []
        for b in batches:
            out = []
            for *key, s, t in zip(*(b[c].to_pylist() for c in (*keys, "_sum", "_text"))):
                if key != now:
                    out += connect(sums, texts)
                    now, sums, texts = key, [], []
                sums.append(s)
                texts.append(t)
            yield pa.RecordBatch.from_arrays([pa.array([x[0] for x in out], pa.string()), pa.array([x[1] for x in out], pa.string())], ["a", "b"])
        out = list(connect(sums, texts))
        yield pa.RecordBatch.from_arrays([pa.array([x[0] for x in out], pa.string()), pa.array([x[1] for x in out], pa.string())], ["a", "b"])

    return members.repartition(*keys).sortWithinPartitions(*keys).mapInArrow(compare, "a string, b string")


def drop_near_copies(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    shingle: int = COPY_SHINGLE,
    least: float = COPY_LEAST,
    budget: int = CANDIDATE_BUDGET,
    piece: int = COPY_PIECE,
    chars: int = COPY_CHARS,
) -> DataFrame:
    """docs without near copies: of each group of documents that near pairs connect, the one of least id (null last, then by text) stays.

    Equal texts are one class. Fingerprints of the distinct words link classes
    to candidate groups; within these the sets of word shingles are compared,
    exactly and whole, and pairs with a Jaccard index of `least` or more
    connect. A large candidate group is cut into pieces, and each pair of
    pieces is compared in a task of its own, so nothing is left out.

    Rows that repeat a document stay once, whatever their further columns.
    Null texts are empty, and texts without words are near each other. An
    empty table gives an empty one. Further columns may have any names.
    """
    last = F.lit((1 << 63) - 1)
    names = {c: f"_c{i}" for i, c in enumerate(docs.columns)}
    text = text_or_empty(F.col(f"`{text_col}`"))
    rows = docs.select(*[F.col(f"`{c}`").alias(n) for c, n in names.items()], F.coalesce(F.col(f"`{id_col}`").cast("long"), last).alias("_key"), F.md5(text.cast("binary")).alias("_sum"), text.alias("_text"))
    prints = written(with_fingerprints(rows.select("_key", "_sum", F.length("_text").alias("_chars"), "_text"), "_text", 1, True), "prints")
    # copies are counted before they are shuffled: of each text there is one row per task
    classes = written(prints.groupBy("_sum").agg(F.min("_key").alias("_key"), F.min("fp").alias("fp"), F.max("_chars").alias("_chars")), "classes")
    nodes = written(classes.select("fp").distinct(), "nodes")
    roots = connected_components(links(nodes, budget), "candidates")
    placed = classes.join(roots, classes["fp"] == roots["node"], "left").select("_sum", "_key", "_chars", F.coalesce("root", "fp").alias("_group"))
    placed = written(placed, "placed")
    size = placed.groupBy("_group").agg(F.count(F.lit(1)).alias("_n"), F.sum("_chars").alias("_all")).where("_n > 1")
    size = size.select("_group", F.greatest(F.ceil(F.col("_n") / piece), F.ceil(F.col("_all") / chars)).cast("int").alias("_pieces"))
    members = placed.join(size, "_group").select("_sum", "_key", "_group", "_pieces")
    p = F.pmod(F.xxhash64("_sum"), F.col("_pieces")).cast("int")
    texts = rows.select("_key", "_sum", "_text").join(members, ["_key", "_sum"]).withColumn("_p", p).withColumn("_q", F.explode(F.sequence(F.lit(0), F.col("_pieces") - 1)))
    met = texts.select("_group", F.least("_p", "_q").alias("_low"), F.greatest("_p", "_q").alias("_high"), "_sum", "_text")
    copies = connected_components(_near_edges(met, shingle, least), "copies")
    whole = classes.join(copies, classes["_sum"] == copies["node"], "left").select("_sum", "_key", F.coalesce("root", "_sum").alias("_root"))
    first = whole.groupBy("_root").agg(F.min(F.struct("_key", "_sum")).alias("_f"))
    verdict = whole.join(first, "_root").select("_sum", F.col("_key").alias("_least"), (F.col("_f._sum") == F.col("_sum")).alias("_stays"))
    counted = prints.groupBy("_key", "_sum").agg(F.count(F.lit(1)).alias("_n")).join(verdict, "_sum")
    stays = F.col("_stays") & (F.col("_key") == F.col("_least"))
    marked = written(counted.select("_key", "_sum", stays.alias("_stays"), "_n").where("not _stays or _n > 1"), "marked")
    discard(prints, classes, nodes, placed)
    columns = [F.col(n).alias(c) for c, n in names.items()]
    out = rows.join(marked.select("_key", "_sum"), ["_key", "_sum"], "left_anti").select(*columns)
    again = marked.where("_stays").select("_key", "_sum")
    if again.isEmpty():
        return out
    return out.unionByName(rows.join(again, ["_key", "_sum"]).dropDuplicates(["_key", "_sum"]).select(*columns))
