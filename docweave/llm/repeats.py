"""Substring dedup by repeated-phrase automata.

A window is WINDOW consecutive words of a document. Words are removed that
stand in a window whose words also start earlier in the corpus.

1. Find repeated phrases. Of the PHRASE-word phrases within a window, the one
   with the least hash is its anchor; equal windows have equal anchors. The
   anchors of every shard of documents are counted, and the shards are told
   which of theirs occur twice or more in the corpus.
2. Confirm passages. Around those anchors the shards send their words, once for
   equal words, to where the anchor is dealt with. There all windows with that
   anchor are compared word by word; those that occur twice or more recur.
   Neighbours that only occur together make one passage, which is known by its
   first window. Every shard that has a passage other than as its first
   occurrence is sent the passage's words and where it occurs first.
3. Compile automata. Each shard's passages become an Aho-Corasick automaton
   over the words.
4. Stream all documents. Each shard streams its documents through its
   automaton; words that none of its passages has are a break. A hit is an occurrence of a passage, word for word; unless it is
   the first one, the words of all the passage's windows are cut out in place.

What is cut follows from the hits alone. A shard is some ROWS_PER_SHARD rows of
a file, so texts are never shuffled; what is sent to a shard is written to a
folder of its own, which only the tasks that read its rows open. All work and
all that is written grows in proportion to the text. A phrase that is in a
third of all documents is sent once for each shard and wording around it.
"""

from __future__ import annotations

import contextlib
import ctypes
from collections.abc import Iterator
from itertools import accumulate, chain

import ahocorasick
import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.parquet as pq
import xxhash
from pyarrow import fs
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docweave.llm.common import WHITE, WHITE_RUN, delete_path, fresh_path, table, text_or_empty, written

WINDOW, PHRASE = 20, 8
SPAN = WINDOW - PHRASE + 1
#: Rows of a shard, bytes of text that a task holds at a time, and anchors that a task counts.
ROWS_PER_SHARD, CHUNK_BYTES, ANCHORS_PER_TASK = 2_048, 4 << 20, 1_000_000
#: A null id counts as the greatest.
LAST = (1 << 63) - 1


def _values(array: pa.Array) -> list:
    """An array without nulls as a list; much faster than to_pylist()."""
    return array.to_numpy(zero_copy_only=False).tolist()


class Chunk:
    """The words of some documents as codes, one document after the other, each with a 0 in front that is no word."""

    def __init__(self, texts: pa.Array | list[str]):
        split = pc.ascii_split_whitespace(texts if isinstance(texts, pa.Array) else pa.array(texts, pa.string()))
        found = split.flatten().dictionary_encode()
        #: the word of each code; no word has code 0
        self.vocabulary = pa.concat_arrays([pa.array([""], found.dictionary.type), found.dictionary])
        numbers = found.indices.to_numpy()
        # white space at the ends of a text leaves empty parts
        real = numbers != pc.index(found.dictionary, "").as_py()
        total = np.concatenate(([0], np.cumsum(real)))
        ends = split.offsets.to_numpy()
        self.sizes = np.diff(total[ends - ends[0]])
        #: where each document's words begin, and the document of each code
        self.starts = np.cumsum(self.sizes + 1) - self.sizes
        self.doc = np.repeat(np.arange(len(self.sizes)), self.sizes + 1)
        self.codes = np.zeros(len(self.doc), np.int32)
        is_word = np.ones(len(self.doc), bool)
        is_word[self.starts - 1] = False
        self.codes[is_word] = numbers[real] + 1

    def joined(self, begin: np.ndarray, n: np.ndarray) -> pa.Array:
        """The n codes from each begin on as words with single spaces."""
        through = np.concatenate(([0], np.cumsum(n)))
        at = np.arange(through[-1]) + np.repeat(begin - through[:-1], n)
        words = self.vocabulary.take(pa.array(self.codes[at]))
        return pc.binary_join(pa.ListArray.from_arrays(pa.array(through, pa.int32()), words), " ")

    def segments(self) -> dict[str, np.ndarray]:
        """Runs of windows that have the same phrase as their anchor: the anchor's hash, the document, the place of the first window and the number of windows."""
        none = {"anchor": np.zeros(0, np.int64), "doc": np.zeros(0, np.int64), "place": np.zeros(0, np.int64), "windows": np.zeros(0, np.int64)}
        n = len(self.codes) - PHRASE + 1
        if n < SPAN:
            return none
        inside = np.arange(len(self.codes)) - self.starts[self.doc]
        at = np.flatnonzero((inside >= 0) & (inside + WINDOW <= self.sizes[self.doc]))
        if not len(at):
            return none
        words = np.fromiter(map(xxhash.xxh3_64_intdigest, _values(self.vocabulary)), np.uint64, len(self.vocabulary))[self.codes]
        # a phrase's hash: a polynomial of its words' hashes, put together from those of 2 and 4 words
        factor, size = np.uint64(0x9E3779B97F4A7C15), 1
        with np.errstate(over="ignore"):
            while size < PHRASE:
                words = words[:-size] * factor + words[size:]
                size, factor = size * 2, factor * factor
            words = (words ^ (words >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
            phrase = least = words ^ (words >> np.uint64(31))
        where, reach = np.arange(n, dtype=np.int32), 1
        # the least of 1, 2, 4, ... places from each place on, the leftmost among equals
        while reach < SPAN:
            step = min(reach, SPAN - reach)
            less = least[step:] < least[:-step]
            least, where = np.where(less, least[step:], least[:-step]), np.where(less, where[step:], where[:-step])
            reach += step
        anchor = where[at]
        new = np.flatnonzero(np.concatenate(([True], (anchor[1:] != anchor[:-1]) | (at[1:] != at[:-1] + 1))))
        first = at[new]
        return {"anchor": phrase[anchor[new]].view(np.int64), "doc": self.doc[first], "place": inside[first], "windows": np.diff(np.append(new, len(at)))}


def _runs(lengths: np.ndarray, size: int) -> Iterator[tuple[int, int]]:
    """Runs (begin, end) of rows with about `size` bytes each; a longer row is a run of its own."""
    through = np.cumsum(lengths, dtype=np.int64)
    begin = 0
    while begin < len(through):
        held = through[begin - 1] if begin else 0
        end = max(begin + 1, int(np.searchsorted(through, held + size, "right")))
        yield begin, end
        begin = end


def _slices(batch: pa.RecordBatch, size: int) -> Iterator[pa.RecordBatch]:
    """Runs of rows with about `size` bytes of text each."""
    for begin, end in _runs(pc.binary_length(batch["text"]).to_numpy(zero_copy_only=False), size):
        yield batch.slice(begin, end - begin)


def _give_back() -> None:
    """Hands freed memory back to the system, where the C library can: workers wait for their next task with what they hold."""
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):
        ctypes.CDLL("libc.so.6").malloc_trim(0)


def _open(path: str):
    return fs.FileSystem.from_uri(path) if "://" in path or path.startswith("file:") else (fs.LocalFileSystem(), path)


def sharded(docs: DataFrame, rows: int = ROWS_PER_SHARD) -> DataFrame:
    """docs with `_shard`: the same for rows that stand together in a file. What doesn't come from such files is written first."""
    place = F.xxhash64("_metadata.file_path", F.floor(F.col("_metadata.row_index") / F.lit(rows)))
    try:
        return docs.withColumn("_shard", place)
    except AnalysisException:  # these rows have no place in a file
        return written(docs, "documents").withColumn("_shard", place)


def _parts(batch: pa.RecordBatch, size: int) -> Iterator[tuple[int, pa.RecordBatch]]:
    """Runs of rows of one shard with about `size` bytes of text."""
    shard = batch["_shard"].to_numpy()
    begins = np.flatnonzero(np.concatenate(([True], shard[1:] != shard[:-1]))) if len(shard) else []
    for lo, hi in zip(begins, [*begins[1:], len(shard)]):
        for part in _slices(batch.slice(lo, hi - lo), size):
            yield int(shard[lo]), part


def _write_by_shard(rows: DataFrame, folder: str, tasks: int) -> str:
    """Writes rows to a folder for each `_shard`."""
    rows.repartition(tasks, "_shard").sortWithinPartitions("_shard").write.partitionBy("_shard").parquet(folder)
    return folder


def _read_of_shard(folder: str, shard: int, columns: list[str]) -> pa.Table | None:
    where, root = _open(f"{folder}/_shard={shard}")
    files = [x.path for x in where.get_file_info(fs.FileSelector(root, allow_not_found=True)) if x.base_name.endswith(".parquet")]
    found = []
    for name in files:
        with where.open_input_file(name) as f:
            found.append(pq.ParquetFile(f).read(columns))
    return pa.concat_tables(found) if found else None


def repeated_anchors(docs: DataFrame, tasks: int, chunk: int = CHUNK_BYTES) -> DataFrame:
    """docs (_shard, text) -> (_shard, anchor): the anchors of each shard that occur twice or more in all documents, each once or a few times."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for shard, part in _parts(b, chunk):
                anchor, n = np.unique(Chunk(part["text"]).segments()["anchor"], return_counts=True)
                yield pa.RecordBatch.from_pydict({"_shard": np.full(len(anchor), shard), "anchor": anchor, "n": n.astype(np.int32)})
        _give_back()

    def again(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [b for b in batches if b.num_rows]
        if not held:
            return
        rows = pa.Table.from_batches(held)
        anchor, n = rows["anchor"].to_numpy(), rows["n"].to_numpy()
        order = np.argsort(anchor, kind="stable")
        first = np.flatnonzero(np.concatenate(([True], anchor[order][1:] != anchor[order][:-1])))
        total = np.repeat(np.add.reduceat(n[order], first), np.diff(np.append(first, len(order))))
        kept = order[total > 1]
        yield pa.RecordBatch.from_pydict({"_shard": rows["_shard"].to_numpy()[kept], "anchor": anchor[kept]})
        _give_back()

    # an anchor has a row for each shard and chunk at most, however often it occurs
    counted = docs.select("_shard", "text").mapInArrow(count, "_shard long, anchor long, n int")
    return counted.repartition(tasks, "anchor").mapInArrow(again, "_shard long, anchor long")


SEGMENT = {"anchor": pa.int64(), "_shard": pa.int64(), "doc_id": pa.int64(), "place": pa.int32(), "n": pa.int64(), "words": pa.string()}
PASSAGE = {"_shard": pa.int64(), "words": pa.string(), "length": pa.int32(), "doc_id": pa.int64(), "place": pa.int32()}


def _batch(rows: list[tuple], columns: dict[str, pa.DataType]) -> pa.RecordBatch:
    values = list(zip(*rows)) if rows else [()] * len(columns)
    return pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(values, columns.values())], list(columns))


def segments(docs: DataFrame, anchors: str, chunk: int = CHUNK_BYTES) -> DataFrame:
    """docs (_shard, doc_id, text) -> the words around repeated anchors: for each shard and wording once, with the first place (document, window) and the number there."""

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, mine = None, np.zeros(0, np.int64)
        for b in batches:
            for shard, part in _parts(b, chunk):
                if shard != now:
                    found = _read_of_shard(anchors, shard, ["anchor"])
                    now, mine = shard, np.zeros(0, np.int64) if found is None else np.unique(found["anchor"].to_numpy())
                if not len(mine):
                    continue
                c, ids = Chunk(part["text"]), part["doc_id"].to_numpy()
                s = c.segments()
                at = np.minimum(np.searchsorted(mine, s["anchor"]), len(mine) - 1)
                kept = np.flatnonzero(mine[at] == s["anchor"])
                anchor, doc, place = (s[x][kept] for x in ("anchor", "doc", "place"))
                begin, n = c.starts[doc] + place, s["windows"][kept] + WINDOW - 1
                through = np.concatenate(([0], np.cumsum(pc.binary_length(c.vocabulary).to_numpy()[c.codes] + 1, dtype=np.int64)))
                for lo, hi in _runs(through[begin + n] - through[begin], 4 * chunk):
                    equal = c.joined(begin[lo:hi], n[lo:hi]).dictionary_encode()
                    group = equal.indices.to_numpy()
                    order = lo + np.lexsort((place[lo:hi], ids[doc[lo:hi]], group))
                    # groups are numbered without gaps
                    count = np.bincount(group)
                    first = order[np.cumsum(count) - count]
                    values = (anchor[first], np.full(len(first), shard), ids[doc[first]], place[first], count, equal.dictionary)
                    yield pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(values[:-1], SEGMENT.values())] + [values[-1]], list(SEGMENT))
        _give_back()

    return docs.select("_shard", "doc_id", "text").mapInArrow(send, "anchor long, _shard long, doc_id long, place int, n long, words string")


def confirm(rows: list[tuple]) -> list[tuple]:
    """All segments (shard, doc_id, place, n, words) of one anchor -> the passages (shard, words, length, doc_id, place) to look for in each shard."""
    wordings: dict[str, list[tuple]] = {}
    for shard, doc, place, n, words in rows:
        wordings.setdefault(words, []).append((shard, doc, place, n))
    if len(wordings) == 1:  # its windows only occur together
        (words, places), = wordings.items()
        if sum(x[3] for x in places) < 2:
            return []
        start = min((x[1], x[2]) for x in places)
        window, length = " ".join(words.split(" ", WINDOW)[:WINDOW]), words.count(" ") + 2 - WINDOW
        return [(shard, window, length, *start) for shard in {x[0] for x in places if x[3] > 1 or (x[1], x[2]) != start}]
    # windows by number: how often each occurs, where first, and how often it is followed by its neighbour
    known: dict[str, int] = {}
    counts: list[int] = []
    first: list[tuple[int, int]] = []
    joint: dict[tuple[int, int], int] = {}
    cut: list[list[int]] = []
    for words, places in wordings.items():
        ends = list(accumulate(len(w) + 1 for w in words.split(" ")))
        n, (doc, place) = sum(x[3] for x in places), min((x[1], x[2]) for x in places)
        mine: list[int] = []
        for i, (begin, end) in enumerate(zip([0, *ends], ends[WINDOW - 1 :])):
            w = known.setdefault(words[begin : end - 1], len(counts))
            if w == len(counts):
                counts.append(0)
                first.append((doc, place + i))
            counts[w] += n
            first[w] = min(first[w], (doc, place + i))
            if mine:
                joint[mine[-1], w] = joint.get((mine[-1], w), 0) + n
            mine.append(w)
        cut.append(mine)
    names, out = list(known), set()
    for windows, places in zip(cut, wordings.values()):
        i = 0
        while i < len(windows):
            w, end = windows[i], i + 1
            while end < len(windows) and counts[windows[end - 1]] == counts[windows[end]] == joint[windows[end - 1], windows[end]]:
                end += 1
            if counts[w] > 1:
                # a shard whose only occurrence is the first of all has nothing to cut
                out |= {(shard, names[w], end - i, *first[w]) for shard, doc, place, n in places if n > 1 or (doc, place + i) != first[w]}
            i = end
    return list(out)


def passages(found: DataFrame, tasks: int) -> DataFrame:
    """Segments -> the passages (PASSAGE) that each shard has to look for."""

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, held = None, []
        for b in batches:
            out = []
            for anchor, *row in zip(*(_values(b[c]) for c in SEGMENT)):
                if anchor != now:
                    out += confirm(held)
                    now, held = anchor, []
                held.append(row)
            yield _batch(out, PASSAGE)
        yield _batch(confirm(held), PASSAGE)

    return found.repartition(tasks, "anchor").sortWithinPartitions("anchor").mapInArrow(compare, "_shard long, words string, length int, doc_id long, place int")


class Matcher:
    """The automaton of a shard's passages. A word is written as two letters, of two alphabets, so that no node has more than about the root of all words below it."""

    def __init__(self, found: pa.Table):
        self.facts = np.stack([found[c].to_numpy().astype(np.int64) for c in ("doc_id", "place", "length")], axis=1)
        coded = pc.split_pattern(found["words"].combine_chunks(), " ").flatten().dictionary_encode()
        self.words = coded.dictionary
        self.base = int(len(self.words) ** 0.5) + 1
        text, size = self._spelt(coded.indices.to_numpy()), 2 * WINDOW
        self.automaton = ahocorasick.Automaton(ahocorasick.STORE_INTS, ahocorasick.KEY_STRING)
        for i in range(found.num_rows):
            self.automaton.add_word(text[i * size : (i + 1) * size], i)
        self.automaton.make_automaton()

    def _spelt(self, numbers: np.ndarray) -> str:
        """Words by number, as two letters each; -1 is any word that no passage has."""
        letters = np.where(numbers >= 0, (1 + numbers // self.base, 1 + self.base + numbers % self.base), 0)
        return letters.T.astype("<u4").tobytes().decode("utf-32-le")

    def occurrences(self, chunk: Chunk) -> tuple[np.ndarray, np.ndarray]:
        """Where in a chunk passages begin, and (document and place of the first occurrence, length) of each."""
        number = pc.fill_null(pc.index_in(chunk.vocabulary, value_set=self.words), -1).to_numpy()[chunk.codes]
        # words that no passage has break the text, as do the gaps between documents; what is shorter than a passage goes into the break
        edges = np.flatnonzero(np.diff(number >= 0, prepend=False, append=False))
        begin, end = edges[::2], edges[1::2]
        whole = end - begin >= WINDOW
        size = 1 + end[whole] - begin[whole]
        through = np.cumsum(size)
        # each stretch with the break in front of it
        at = np.arange(size.sum()) + np.repeat(begin[whole] - 1 - (through - size), size)
        hits = np.fromiter(chain.from_iterable(self.automaton.iter(self._spelt(number[at]))), np.int64).reshape(-1, 2)
        # a passage ends with the second letter of a word
        return at[hits[:, 0] // 2] - (WINDOW - 1), self.facts[hits[:, 1]]


def covered(chunk: Chunk, ids: np.ndarray, matcher: Matcher | None) -> np.ndarray:
    """Which codes of a chunk are words in a window that also starts earlier."""
    change = np.zeros(len(chunk.codes) + 1, np.int64)
    if matcher is not None and len(chunk.codes):
        at, facts = matcher.occurrences(chunk)
        doc = chunk.doc[at]
        later = (ids[doc] != facts[:, 0]) | (at - chunk.starts[doc] != facts[:, 1])
        np.add.at(change, at[later], 1)
        np.add.at(change, at[later] + facts[later, 2] + WINDOW - 1, -1)
    return np.cumsum(change)[:-1] > 0


def cut_repeats(docs: DataFrame, folder: str, chunk: int = CHUNK_BYTES) -> DataFrame:
    """docs (_shard, doc_id as `_order`, text, further columns) with `kept` (the text of the words that stay) in place of text, n_words and n_removed."""
    others = [f.name for f in docs.schema.fields if f.name not in ("text", "_order", "_shard")]
    names = "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in docs.schema.fields if f.name in others)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, matcher = None, None
        for b in batches:
            for shard, part in _parts(b, chunk):
                if shard != now:
                    matcher = None
                    found = _read_of_shard(folder, shard, [c for c in PASSAGE if c != "_shard"])
                    now, matcher = shard, Matcher(found) if found is not None and found.num_rows else None
                    del found
                texts = _values(part["text"])
                c = Chunk(part["text"])
                gone = covered(c, part["_order"].to_numpy(), matcher)
                total = np.concatenate(([0], np.cumsum(gone)))
                removed = total[c.starts + c.sizes] - total[c.starts]
                kept = [t if not r else _without(t, gone[s : s + n].tolist()) for t, r, s, n in zip(texts, removed.tolist(), c.starts.tolist(), c.sizes.tolist())]
                yield pa.RecordBatch.from_arrays([*[part[x] for x in others], pa.array(kept, pa.string()), pa.array(c.sizes), pa.array(removed)], [*others, "kept", "n_words", "n_removed"])
        matcher = None
        _give_back()

    return docs.mapInArrow(cut, f"{names}kept string, n_words long, n_removed long")


def remove_repeats(docs: DataFrame, rows_per_shard: int = ROWS_PER_SHARD, chunk: int = CHUNK_BYTES, per_task: int = ANCHORS_PER_TASK) -> DataFrame:
    """docs (doc_id, text, further columns) -> all columns but text, with `kept` (the text of the words that stay), n_words, n_removed.

    A text that loses nothing stays as it is; in others, lines that lose words
    have single spaces, and lines that lose all their words go.

    The order of documents is that of doc_id, null last. Rows of one id are
    one document for that order: of equal windows at the same place of such
    rows none counts as the earlier, so rows that repeat a document are kept
    or cut alike. Null texts have no words; an empty table gives an empty one.
    Windows are compared word by word. Columns named kept, n_words, n_removed,
    _order or _shard give way.
    """
    spark = docs.sparkSession
    clean = sharded(docs.drop("kept", "n_words", "n_removed", "_order", "_shard"), rows_per_shard)
    rows = clean.withColumn("text", text_or_empty("text")).withColumn("_order", F.coalesce(F.col("doc_id").cast("long"), F.lit(LAST)))
    keyed = rows.select("_shard", F.col("_order").alias("doc_id"), "text")
    # words have six bytes on average, and every seventh phrase is an anchor
    size = keyed.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    tasks = max(1, -(-size // (42 * per_task)))
    anchors = _write_by_shard(repeated_anchors(keyed, tasks, chunk), fresh_path(spark, "anchors"), tasks)
    found = passages(segments(keyed, anchors, chunk), 4 * tasks)
    folder = _write_by_shard(found, fresh_path(spark, "passages"), 4 * tasks)
    delete_path(spark, anchors.rsplit("/", 1)[0])
    return cut_repeats(rows, folder, chunk)


def _without(text: str, gone: list[bool]) -> str:
    """A text without the marked words: its lines, with single spaces in lines that lose words, and without lines that lose all."""
    lines, at = [], 0
    for line in text.encode().split(b"\n"):
        ws = line.split()
        out = gone[at : at + len(ws)]
        at += len(ws)
        if not any(out):
            lines.append(line)
        elif not all(out):
            lines.append(b" ".join(w for w, g in zip(ws, out) if not g))
    return b"\n".join(lines).decode()


def op6_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents with the number of removed words and a digest of the others, joined by single spaces."""
    done = remove_repeats(table(spark, sf_dir, "documents").select("doc_id", "text"))
    joined = F.regexp_replace(F.btrim("kept", F.lit(WHITE)), WHITE_RUN, " ")
    return done.select("doc_id", "n_words", "n_removed", F.sha2(joined, 256).alias("kept_sha256"))


OP6_SQL = r"""
WITH d AS (
  SELECT row_number() OVER () AS rid, doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents
), g AS (
  SELECT rid, doc_id, i, array_to_string(list_slice(w, i, i + 19), ' ') AS k
  FROM (SELECT rid, doc_id, w, unnest(range(1, len(w) - 18)) AS i FROM d WHERE len(w) >= 20)
), f AS (
  SELECT rid, i, row_number() OVER (PARTITION BY k ORDER BY doc_id NULLS LAST, i) AS n FROM g
), gone AS (
  SELECT DISTINCT rid, i + o AS j FROM f, (SELECT unnest(range(0, 20)) AS o) WHERE n > 1
), words AS (
  SELECT rid, unnest(w) AS word, generate_subscripts(w, 1) AS j FROM d
), s AS (
  SELECT words.rid, count(gone.j) AS n_removed, string_agg(CASE WHEN gone.j IS NULL THEN word END, ' ' ORDER BY words.j) AS kept
  FROM words LEFT JOIN gone ON words.rid = gone.rid AND words.j = gone.j GROUP BY words.rid
)
SELECT d.doc_id, CAST(len(d.w) AS BIGINT) AS n_words, CAST(coalesce(s.n_removed, 0) AS BIGINT) AS n_removed, sha256(coalesce(s.kept, '')) AS kept_sha256
FROM d LEFT JOIN s ON d.rid = s.rid
"""
