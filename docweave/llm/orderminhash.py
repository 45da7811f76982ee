"""Order MinHash fingerprints of documents, in SQL expressions only.

The k-mers of a text are its runs of SHINGLE words, each numbered by how often
it has occurred before, so repeats differ. Every numbered k-mer has a hash on
a ring of 40 bits. A component of the signature starts at a fixed point of the
ring and selects the TUPLE numbered k-mers that follow it first: the minimal
ones under the hash order that begins at that point. They are put back into
the order of the text, and the hash of the tuple is the component. Two texts
agree in a component if the same k-mers are selected and stand in the same
order, so the likeness falls with the edit distance.

All components read one ring from different points instead of one random order
each (one permutation instead of many). The expected likeness is that of
independent orders; components of short texts, with fewer k-mers than
components, repeat each other, so its variance is larger there.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from docweave.llm.common import count_upto, let, table, text_or_empty, words, written

SHINGLE, TUPLE, COMPONENTS = 5, 2, 64
#: A packed number has the hash in its upper 32 bits and the place, as large as an array can have it, in its lower.
PLACE_BITS = 31
PLACE = (1 << PLACE_BITS) - 1


def kmers(ws: Column) -> Column:
    """Hashes of the word runs of a text: all of SHINGLE words, or the one of all its words if they are fewer. No words, none."""
    return let(
        F.transform(ws, lambda w: F.xxhash64(w)),
        lambda h: F.when(F.size(h) == 0, F.array().cast("array<long>"))
        .when(F.size(h) < SHINGLE, F.array(F.xxhash64(ws)))
        .otherwise(F.transform(count_upto(F.size(h) - (SHINGLE - 1)), lambda i: F.xxhash64(*[F.get(h, i + k) for k in range(SHINGLE)]))),
    )


def pack(hashed: Column, place: Column) -> Column:
    """Upper 32 bits of a hash, as a number that isn't negative, and a place below PLACE."""
    return F.shiftleft(F.shiftrightunsigned(hashed, PLACE_BITS + 1), PLACE_BITS).bitwiseOR(place)


def place_of(packed: Column) -> Column:
    return packed.bitwiseAND(F.lit(PLACE).cast("long"))


def numbered(ks: Column) -> Column:
    """Each k-mer with its occurrence number hashed onto the ring and packed with its place; sorted by hash. ks may be a lambda variable."""
    by_value = F.sort_array(F.transform(ks, lambda k, i: pack(k, i.cast("long"))))
    same = lambda s, i: F.shiftright(F.get(s, i), PLACE_BITS)

    def ring(s: Column) -> Column:
        n = F.size(s)
        starts = F.filter(count_upto(n), lambda i: (i == 0) | (same(s, i) != same(s, i - 1)))
        # a run of equal k-mers has the numbers 0, 1, ... in the order of the text
        runs = let(starts, lambda at: F.flatten(F.transform(at, lambda a, r: F.sequence(F.lit(0), F.coalesce(F.get(at, r + 1), n) - a - 1))))
        packed = let(runs, lambda occ: F.transform(s, lambda v, i: pack(F.xxhash64(F.shiftright(v, PLACE_BITS), F.get(occ, i)), place_of(v))))
        return F.sort_array(packed)

    return let(by_value, ring)


def marks() -> Column:
    """The components' starting points on the ring, packed with the highest place so that they are told from k-mers."""
    step = (1 << (63 - PLACE_BITS)) // COMPONENTS
    return F.array(*[F.lit(((j * step + step // 2) << PLACE_BITS) | PLACE).cast("long") for j in range(COMPONENTS)])


def signature(ring: Column) -> Column:
    """The fingerprint of a ring: 4 hexadecimal digits for each component. ring may be a lambda variable."""
    n = F.size(ring)

    def component(first: Column) -> Column:
        picked = [F.get(ring, F.pmod(first + t, n).cast("int")) for t in range(TUPLE)]
        # put back into text order: by place
        turned = F.array_sort(F.array(*[F.struct(place_of(p).alias("at"), F.shiftright(p, PLACE_BITS).alias("h")) for p in picked]))
        hashed = let(turned, lambda t: F.xxhash64(*[F.get(t, i)["h"] for i in range(TUPLE)]))
        return F.lpad(F.lower(F.hex(hashed.bitwiseAND(F.lit(0xFFFF).cast("long")))), 4, "0")

    def read(both: Column) -> Column:
        found = F.filter(count_upto(F.size(both)), lambda i: place_of(F.get(both, i)) == PLACE)
        # a mark at i with r marks before it is followed by k-mer i - r
        return F.array_join(F.transform(found, lambda i, r: component(i - r)), "")

    return F.when(n == 0, F.lit("0" * 4 * COMPONENTS)).otherwise(let(F.sort_array(F.concat(ring, marks())), read))


def fingerprint(text: Column) -> Column:
    """The fingerprint of a non-null text: 4 * COMPONENTS hexadecimal digits, all 0 for a text without words.

    Equal word sequences have equal fingerprints, whatever their length.
    """
    return let(kmers(words(text)), lambda ks: let(numbered(ks), signature))


def likeness(a: Column, b: Column) -> Column:
    """The share of components in which two fingerprints agree."""
    agree = F.aggregate(F.sequence(F.lit(0), F.lit(COMPONENTS - 1)), F.lit(0), lambda s, i: s + (F.substr(a, i * 4 + 1, F.lit(4)) == F.substr(b, i * 4 + 1, F.lit(4))).cast("int"))
    return agree / F.lit(float(COMPONENTS))


def successors(ids: DataFrame, keys: list[str], carried: list[str]) -> DataFrame:
    """Rows of distinct keys, each with the keys and carried columns of the next row in key order as next_<column>; the last row's next is the first.

    The rows are cut into ranges of their order; each range is ordered in a
    task of its own, and the ranges' first rows close the gaps between them.
    """
    ranged = written(ids.select(*keys, *carried).repartitionByRange(*keys).withColumn("_range", F.spark_partition_id()), "ranged")
    row = F.struct(*keys, *carried)
    heads = ranged.groupBy("_range").agg(F.min(row).alias("_head"))
    # one row per range; after the last range comes the first
    order = Window.orderBy("_range")
    following = F.coalesce(F.lead("_head").over(order), F.first("_head").over(order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)))
    around = heads.select("_range", following.alias("_around"))
    inside = ranged.withColumn("_lead", F.lead(row).over(Window.partitionBy("_range").orderBy(*keys)))
    # both sides are dealt out by range already
    joined = inside.join(around, "_range").withColumn("_next", F.coalesce("_lead", "_around"))
    return joined.select(*keys, *carried, *[F.col(f"_next.{c}").alias(f"next_{c}") for c in (*keys, *carried)])


KEYS = ["none", "id", "sum"]


def keyed(docs: DataFrame) -> DataFrame:
    """The text and a key without nulls: whether doc_id is missing, doc_id, a hash of the text."""
    text = text_or_empty("text")
    return docs.select(text.alias("text"), F.when(F.col("doc_id").isNull(), 1).otherwise(0).alias("none"), F.coalesce(F.col("doc_id").cast("long"), F.lit(0).cast("long")).alias("id"), F.xxhash64(text).alias("sum"))


def printed(docs: DataFrame) -> DataFrame:
    """docs (doc_id, text) -> doc_id, n_chars, fingerprint; null texts are empty, repeated rows all come back, further columns are ignored; an empty table gives an empty one."""
    text = text_or_empty("text")
    return docs.select("doc_id", F.length(text).cast("long").alias("n_chars"), fingerprint(text).alias("fingerprint"))


def edit_with_next(docs: DataFrame) -> DataFrame:
    """docs (doc_id, text) -> doc_id, n_chars, fingerprint, edited, next_fingerprint.

    Documents follow each other by doc_id (null last), then by a hash of the
    text; rows of one id and one text are one document there, and each row
    comes back. The next of the last document is the first, so a single
    document is its own next. `edited` is the text with its last quarter of
    code points, rounded down, replaced by as many from the start of the next
    document, or all it has. Null texts are empty, an empty table gives an
    empty one, and further columns are ignored, so none can clash.
    """
    rows = keyed(docs)
    one = rows.select(*KEYS, F.length("text").alias("n_chars"), fingerprint(F.col("text")).alias("fingerprint")).dropDuplicates(KEYS)
    chain = written(successors(one, KEYS, ["n_chars", "fingerprint"]), "chain")
    quarter = F.floor(F.col("n_chars") / 4).cast("int")
    # texts are dealt out by their keys once, as themselves and as what they lend to the document before them:
    # both joins take the same columns, so they share one exchange
    asked = chain.select(*[F.col(f"next_{k}").alias(k) for k in KEYS], *[F.col(k).alias(f"for_{k}") for k in KEYS], quarter.alias("take"))
    lent = rows.join(asked, KEYS).select(*[F.col(f"for_{k}").alias(k) for k in KEYS], F.left("text", F.col("take")).alias("lent"))
    # rows that repeat a document lend the same text
    lent = lent.groupBy(*KEYS).agg(F.first("lent").alias("lent"))
    both = rows.join(chain, KEYS).join(lent, KEYS)
    return both.select(F.when(F.col("none") == 0, F.col("id")).alias("doc_id"), F.col("n_chars").cast("long").alias("n_chars"), "fingerprint", F.concat(F.left("text", F.col("n_chars") - quarter), "lent").alias("edited"), "next_fingerprint")


def op4_order_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents: fingerprints of the text and of the edited text, and their likeness."""
    rows = edit_with_next(table(spark, sf_dir, "documents").select("doc_id", "text"))
    done = rows.select("doc_id", "n_chars", F.sha2("edited", 256).alias("edited_sha256"), "fingerprint", fingerprint(F.col("edited")).alias("edited_fingerprint"), "next_fingerprint")
    return done.select(
        "doc_id",
        "n_chars",
        "edited_sha256",
        "fingerprint",
        "edited_fingerprint",
        likeness(F.col("fingerprint"), F.col("edited_fingerprint")).alias("near_edited"),
        likeness(F.col("fingerprint"), F.col("next_fingerprint")).alias("near_next"),
    )
