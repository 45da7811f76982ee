"""SentencePiece encoding and decoding by suffix-array matching.

Texts are cut into units that no piece crosses (a run of spaces with the word
after it, a line feed). The distinct units of a batch are written one after
the other and indexed by a suffix array, sorted as far as the longest piece
goes. Every piece of the vocabulary is found in it by binary search, which
gives the range of its occurrences; the occurrences are the edges of a graph
over the places of the text. The edges are sorted by place and relaxed: in
every unit, however long, the edge of best score that joins two neighbouring
symbols, the leftmost among equals, replaces them, until no edge does. That is the
segmentation of a byte-pair model. Symbols outside the vocabulary become
their UTF-8 bytes.
"""

from __future__ import annotations

import hashlib
import heapq
import re
from array import array
from bisect import bisect_left
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import sentencepiece
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docweave.llm.common import table, text_or_empty

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
SPACE = "▁"
#: Characters of text that a task encodes at a time, symbols of one suffix
#: array, and the longest unit that is relaxed in rounds over arrays; longer ones use a heap.
CHUNK_CHARS, INDEX_SYMBOLS, ARRAY_UNIT = 6_000_000, 400_000, 64
NEVER = np.iinfo(np.int32).max
UNITS = re.compile(r" +[^ \n]*|[^ \n]+|\n")


@dataclass
class Model:
    """A vocabulary: pieces and scores by id, byte ids by byte (or none), the unknown id."""

    pieces: list[str]
    scores: list[float]
    special: list[bool]
    bytes_: dict[int, int]
    unknown: int
    digest: str = ""

    def __post_init__(self) -> None:
        self.digest = hashlib.sha256(repr((self.pieces, self.scores, self.special, sorted(self.bytes_.items()), self.unknown)).encode("utf-8", "surrogatepass")).hexdigest()

    @staticmethod
    def load(path: str = MODEL) -> Model:
        """Reads a byte-pair model whose pieces have the space sign only in front and no line feed; others can't be cut into units and are refused."""
        sp = sentencepiece.SentencePieceProcessor(model_file=path)
        n = sp.get_piece_size()
        pieces = [sp.id_to_piece(i) for i in range(n)]
        special = [sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i) or sp.is_unused(i) for i in range(n)]
        for p, s in zip(pieces, special):
            if not s and (SPACE in p.lstrip(SPACE) or "\n" in p):
                raise ValueError(f"piece {p!r} crosses units")
        return Model(pieces, [sp.get_score(i) for i in range(n)], special, {int(p[3:5], 16): i for i, p in enumerate(pieces) if sp.is_byte(i)}, sp.unk_id())


class Encoder:
    """A model prepared for matching."""

    def __init__(self, model: Model):
        self.model = model
        ids = np.array([i for i, s in enumerate(model.special) if not s])
        texts = [model.pieces[i] for i in ids]
        self.ids = ids
        # equal scores have equal ranks; the leftmost edge wins among them
        _, rank = np.unique(-np.array([model.scores[i] for i in ids]), return_inverse=True)
        self.rank = np.full(len(model.pieces), NEVER, np.int32)
        self.rank[ids] = rank
        self.lengths = np.array([len(t) for t in texts])
        self.longest = int(self.lengths.max(initial=1))
        codes = np.frombuffer("".join(texts).encode("utf-32-le"), np.uint32)
        self.alphabet = np.unique(codes)  # symbol k + 1 is alphabet[k]; 0 is what no piece has
        if len(self.alphabet) >= 0xFFFF:
            raise ValueError("too many characters in the vocabulary")
        wide = self.longest
        low, high = np.zeros((len(ids), wide), ">u2"), np.full((len(ids), wide), 0xFFFF, ">u2")
        row, column = np.repeat(np.arange(len(ids)), self.lengths), np.concatenate([np.arange(n) for n in self.lengths])
        low[row, column] = high[row, column] = self.symbols(codes)
        self.low, self.high = (np.ascontiguousarray(x).view(f"S{2 * wide}").ravel() for x in (low, high))
        self.fallback: dict[str, list[int]] = {}

    def symbols(self, codes: np.ndarray) -> np.ndarray:
        at = np.minimum(np.searchsorted(self.alphabet, codes), len(self.alphabet) - 1)
        return np.where(self.alphabet[at] == codes, at + 1, 0).astype(np.uint16)

    def suffix_array(self, symbols: np.ndarray) -> np.ndarray:
        """The places of the text, sorted by the symbols from there on, as many as the longest piece has at least.

        As many symbols as fit into a number are compared at once; after
        that, each round doubles the reach.
        """
        there = np.unique(symbols)
        small = np.searchsorted(there, symbols).astype(np.int64) + 1
        bits, n = int(len(there)).bit_length(), len(symbols)
        reach = min(62 // bits, self.longest)
        key = np.zeros(n, np.int64)
        for k in range(reach):
            key <<= bits
            key[: n - k if k < n else 0] |= small[k:]
        while True:
            order = np.argsort(key)
            if reach >= self.longest:
                return order
            sorted_key = key[order]
            rank = np.empty(n, np.int64)
            rank[order] = np.cumsum(np.concatenate(([1], sorted_key[1:] != sorted_key[:-1])))
            key = rank * (n + 1)
            key[: max(0, n - reach)] += rank[reach:]
            reach *= 2

    def edges(self, symbols: np.ndarray) -> np.ndarray:
        """For each place of the text and each length the piece that stands there, or -1: the edges, sorted by place."""
        n, wide = len(symbols), self.longest
        array = self.suffix_array(symbols)
        padded = np.concatenate((symbols, np.zeros(wide, np.uint16))).astype(">u2")
        suffixes = np.lib.stride_tricks.sliding_window_view(padded, wide)[array]
        keys = np.ascontiguousarray(suffixes).view(f"S{2 * wide}").ravel()
        begin, end = np.searchsorted(keys, self.low, "left"), np.searchsorted(keys, self.high, "right")
        count = end - begin
        total = int(count.sum())
        # one edge for each occurrence of each piece
        place = array[np.repeat(begin - (np.cumsum(count) - count), count) + np.arange(total)]
        # sorted by place and length: by where they stand in the table
        out = np.full(n * (wide + 1), -1, np.int32)
        cell = place * (wide + 1) + np.repeat(self.lengths, count)
        order = np.argsort(cell)
        out[cell[order]] = np.repeat(self.ids, count)[order]
        return out.reshape(n, wide + 1)

    def relax(self, table: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(unit, place, length) of the symbols that remain in each unit, sorted."""
        wide = self.longest
        unit = np.repeat(np.arange(len(starts)), sizes)
        place = np.arange(int(sizes.sum())) - np.repeat(np.cumsum(sizes) - sizes, sizes) + starts[unit]
        length = np.ones(len(unit), np.int64)
        done: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        while len(unit):
            joined = np.zeros(len(unit), np.int64)
            joined[:-1] = length[:-1] + length[1:]
            joined[:-1][unit[1:] != unit[:-1]] = 0
            fits = (joined > 0) & (joined <= wide)
            piece = table[place, np.where(fits, joined, 0)]
            rank = np.where(piece >= 0, self.rank[piece], NEVER).astype(np.int64)
            heads = np.flatnonzero(np.concatenate(([True], unit[1:] != unit[:-1])))
            best = np.minimum.reduceat((rank << 32) | np.arange(len(unit)), heads)
            merges = (best >> 32) < NEVER
            # units without a further edge are finished
            going = np.repeat(merges, np.diff(np.append(heads, len(unit))))
            if not merges.all():
                done.append((unit[~going], place[~going], length[~going]))
            at = (best & 0xFFFFFFFF)[merges]
            length[at] = joined[at]
            going[at + 1] = False
            unit, place, length = unit[going], place[going], length[going]
        if not done:
            return (np.zeros(0, np.int64),) * 3
        unit, place, length = (np.concatenate(x) for x in zip(*done))
        order = np.lexsort((place, unit))
        return unit[order], place[order], length[order]

    def outside(self, symbol: str) -> list[int]:
        """The ids of a character that is no piece."""
        if symbol not in self.fallback:
            data = symbol.encode("utf-8", "surrogatepass")
            if len(self.fallback) > 100_000:
                self.fallback.clear()
            self.fallback[symbol] = [self.model.bytes_[b] for b in data] if self.model.bytes_ else [self.model.unknown]
        return self.fallback[symbol]

    def merge(self, n: int, places: array, pieces: list[int]) -> tuple[list[int], list[int]]:
        """(place, piece or -1) of the symbols that remain in one long unit: the same relaxation with a heap, so that time grows with the length times its logarithm.

        places: the unit's edges as place * (longest + 1) + length, sorted; pieces: their pieces.
        """
        wide = self.longest + 1
        end, before = list(range(1, n + 1)), list(range(-1, n - 1))
        alive, heap = bytearray(b"\1" * n), []

        def edge(a: int, e: int) -> int:
            if e - a >= wide:
                return -1
            key = a * wide + e - a
            i = bisect_left(places, key)
            return pieces[i] if i < len(places) and places[i] == key else -1

        def offer(a: int) -> None:
            b = end[a]
            if b < n and (i := edge(a, end[b])) >= 0:
                heapq.heappush(heap, (int(self.rank[i]), a, b, end[b]))

        for a in range(n - 1):
            offer(a)
        while heap:
            _, a, b, e = heapq.heappop(heap)
            if not (alive[a] and b < n and alive[b] and end[a] == b and end[b] == e):
                continue
            alive[b], end[a] = 0, e
            if e < n:
                before[e] = a
                offer(a)
            if before[a] >= 0:
                offer(before[a])
        at, found, a = [], [], 0
        while a < n:
            at.append(a)
            found.append(edge(a, end[a]))
            a = end[a]
        return at, found

    def spell(self, codes: np.ndarray, ids: np.ndarray, unit: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Symbols (their first characters, pieces, units) with those that are no piece as the ids of their character."""
        strange = np.flatnonzero(ids < 0)
        if not len(strange):
            return ids, unit
        spelt = [self.outside(chr(c)) for c in codes[strange].tolist()]
        wide = np.ones(len(ids), np.int64)
        wide[strange] = [len(x) for x in spelt]
        ids, unit = np.repeat(ids, wide), np.repeat(unit, wide)
        ids[ids < 0] = [y for x in spelt for y in x]
        return ids, unit

    def batches(self, sizes: np.ndarray, symbols: int) -> list[np.ndarray]:
        """Runs of units with about so many symbols each, separators included; a longer unit is a run of its own."""
        group = np.cumsum(sizes + 1) // symbols
        alone = sizes >= symbols
        new = (np.diff(group) > 0) | alone[1:] | alone[:-1] if len(sizes) else np.zeros(0, bool)
        return np.split(np.arange(len(sizes)), np.flatnonzero(new) + 1) if len(sizes) else []

    def encode_units(self, units: list[str], symbols: int = INDEX_SYMBOLS, arrays: int = ARRAY_UNIT) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(ids of all units, where each unit's ids begin, how many it has).

        symbols: of one suffix array. All edges come of suffix arrays; units
        of more than `arrays` characters are relaxed by merge(). A unit longer
        than a suffix array is indexed in parts that overlap by the longest
        piece, and its edges are put together.
        """
        wide = self.longest + 1
        sizes = np.fromiter(map(len, units), np.int64, len(units))
        flat, starts, counts, held = [], np.zeros(len(units), np.int64), np.zeros(len(units), np.int64), 0

        def put(which: np.ndarray, ids: np.ndarray, unit: np.ndarray) -> None:
            nonlocal held
            per_unit = np.bincount(unit, minlength=len(which))
            counts[which] = per_unit
            starts[which] = held + np.cumsum(per_unit) - per_unit
            flat.append(ids.astype(np.int32))
            held += len(ids)

        for mine in self.batches(sizes, symbols):
            # units stand one after the other, with a symbol that no piece has between them
            codes = np.frombuffer("\n".join([units[i] for i in mine.tolist()]).encode("utf-32-le", "surrogatepass"), np.uint32)
            n = sizes[mine]
            begin = np.cumsum(n + 1) - (n + 1)
            known = self.symbols(codes)
            # several units are in one suffix array, a single one may need parts
            step = max(len(codes), 1) if len(mine) > 1 else symbols
            in_arrays = (n <= arrays) & (len(codes) <= step)
            short, long = np.flatnonzero(in_arrays), np.flatnonzero(~in_arrays)
            keys, found = array("q"), []
            for part in range(0, len(codes), step):
                table = self.edges(known[part : part + step + self.longest])[:step]
                if len(long):
                    cell = np.flatnonzero(table.ravel() >= 0)
                    keys.frombytes((cell + part * wide).tobytes())
                    found += table.ravel()[cell].tolist()
            if len(short):
                unit, place, length = self.relax(table, begin[short], n[short])
                put(mine[short], *self.spell(codes[place], table[place, length], unit))
            for k in long.tolist():
                lo, hi = bisect_left(keys, int(begin[k]) * wide), bisect_left(keys, int(begin[k] + n[k]) * wide)
                own = array("q", (np.frombuffer(keys, np.int64)[lo:hi] - int(begin[k]) * wide).tobytes())
                at, got = self.merge(int(n[k]), own, found[lo:hi])
                put(mine[k : k + 1], *self.spell(codes[int(begin[k]) + np.array(at)], np.array(got), np.zeros(len(got), np.int64)))
        return (np.concatenate(flat) if flat else np.zeros(0, np.int32)), starts, counts

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts, number of ids of each). An empty text has none; others get a space in front."""
        cut = [UNITS.findall(" " + t.replace(SPACE, " ")) if t else [] for t in texts]
        per_text = np.fromiter(map(len, cut), np.int64, len(cut))
        every = list(chain.from_iterable(cut))
        cut.clear()
        distinct = list(dict.fromkeys(every))
        asked = np.fromiter(map(dict(zip(distinct, range(len(distinct)))).__getitem__, every), np.int64, len(every))
        every.clear()
        flat, starts, counts = self.encode_units([u.replace(" ", SPACE) for u in distinct])
        n = counts[asked]
        total = int(n.sum())
        ids = flat[np.repeat(starts[asked] - (np.cumsum(n) - n), n) + np.arange(total)]
        through = np.concatenate(([0], np.cumsum(n)))
        edge = np.concatenate(([0], np.cumsum(per_text)))
        return ids, np.diff(through[edge])


class Decoder:
    def __init__(self, model: Model):
        back = {i: b for b, i in model.bytes_.items()}
        self.data = [bytes([back[i]]) if i in back else b"" if s and i != model.unknown else p.replace(SPACE, " ").encode() for i, (p, s) in enumerate(zip(model.pieces, model.special))]
        self.data[model.unknown] = " ⁇ ".encode()

    def decode(self, ids: list[int]) -> str:
        """The text of some ids; the space in front goes, bytes that are no UTF-8 become U+FFFD."""
        return b"".join(map(self.data.__getitem__, ids)).decode("utf-8", "replace").removeprefix(" ")


_prepared: dict[str, tuple[Encoder, Decoder]] = {}


def _tools(model: Model) -> tuple[Encoder, Decoder]:
    """A worker prepares a vocabulary once."""
    key = model.digest
    if key not in _prepared:
        _prepared.clear()
        _prepared[key] = (Encoder(model), Decoder(model))
    return _prepared[key]


def encode(docs: DataFrame, model: str = MODEL, text: str = "text") -> DataFrame:
    """docs plus n_tokens, ids (array of int), decoded_sha256 and lossless: whether the decoded ids are the text.

    Row by row over whole texts: null and empty texts have no ids, repeated
    rows are treated alike, columns of the same names give way. Texts with
    U+2581, which stands for the space in the vocabulary, are not lossless.
    """
    vocabulary = Model.load(model)
    kept = docs.drop("n_tokens", "ids", "decoded_sha256", "lossless").withColumn(text, text_or_empty(F.col(f"`{text}`")))
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept.schema.fields)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, decoder = _tools(vocabulary)
        for b in batches:
            sizes = pc.utf8_length(b[text]).to_numpy(zero_copy_only=False)
            begin = 0
            while begin < b.num_rows:
                fits = int(np.searchsorted(np.cumsum(sizes[begin:]), CHUNK_CHARS, "right"))
                part = b.slice(begin, max(1, fits))
                begin += part.num_rows
                texts = part[text].to_pylist()
                ids, n = encoder.encode(texts)
                offsets = np.concatenate(([0], np.cumsum(n))).astype(np.int32)
                digests, lossless = [], []
                for t, lo, hi in zip(texts, offsets[:-1].tolist(), offsets[1:].tolist()):
                    back = decoder.decode(ids[lo:hi].tolist())
                    digests.append(hashlib.sha256(back.encode()).hexdigest())
                    lossless.append(back == t)
                yield pa.RecordBatch.from_arrays(
                    [*part.columns, pa.array(n, pa.int64()), pa.ListArray.from_arrays(pa.array(offsets), pa.array(ids)), pa.array(digests), pa.array(lossless)],
                    [*part.schema.names, "n_tokens", "ids", "decoded_sha256", "lossless"],
                )

    return kept.mapInArrow(work, f"{fields}, n_tokens long, ids array<int>, decoded_sha256 string, lossless boolean")


def decode(encoded: DataFrame, model: str = MODEL, ids: str = "ids", out: str = "text") -> DataFrame:
    """encoded plus the column `out` for the text of its ids; null ids give an empty text."""
    vocabulary = Model.load(model)
    kept = encoded.drop(out)
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept.schema.fields)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        _, decoder = _tools(vocabulary)
        for b in batches:
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array([decoder.decode(x or []) for x in b[ids].to_pylist()], pa.string())], [*b.schema.names, out])

    return kept.mapInArrow(work, f"{fields}, `{out}` string")


def op5_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents encoded, and decoded again."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return encode(docs).drop("text")
