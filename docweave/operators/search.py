"""Query-string search over texts.

A query string is a list of clauses: `term`, `prefix*`, `"a phrase"`, each
with `field:` in front if it is about another column, with `+` if a hit must
have it and `-` if it must not. Without `+` a hit has one clause at least. The
score of a hit is how often its terms, prefixes and phrases occur in all.
"""

from __future__ import annotations

import re
from dataclasses import dataclass
from functools import reduce

import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: What separates words: all that is no letter, mark or number of any script.
WORD_GAP = r"[^\p{L}\p{M}\p{N}]+"
_CLAUSE = re.compile(r"""\s*([+-]?)(?:([A-Za-z_][\w.]*):)?("([^"]*)"|[^\s"]+)""")


@dataclass(frozen=True)
class Clause:
    sign: str
    field: str | None
    words: tuple[str, ...]
    prefix: bool


def parse(query: str) -> list[Clause]:
    out, at = [], 0
    while at < len(query.rstrip()):
        m = _CLAUSE.match(query, at)
        if m is None:
            raise ValueError(f"can't read the query {query!r} from {query[at:]!r}")
        at = m.end()
        text = (m[4] if m[4] is not None else m[3]).lower()
        prefix = m[4] is None and text.endswith("*")
        words = tuple(w for w in regex.split(WORD_GAP, text) if w)
        if not words:
            raise ValueError(f"a clause of {query!r} has no word")
        out.append(Clause(m[1], m[2], words, prefix))
    if not out:
        raise ValueError("the query is empty")
    return out


def terms(text: Column) -> Column:
    """The words of a text, lowered."""
    return F.split(F.lower(F.coalesce(text, F.lit(""))), WORD_GAP)


def occurrences(words: Column, clause: Clause) -> Column:
    """How often a clause occurs among words."""
    if clause.prefix and len(clause.words) == 1:
        return F.size(F.filter(words, lambda w: w.startswith(clause.words[0])))
    if len(clause.words) == 1:
        return F.size(F.filter(words, lambda w: w == clause.words[0]))
    places = F.when(F.size(words) >= len(clause.words), F.sequence(F.lit(0), F.size(words) - len(clause.words))).otherwise(F.array().cast("array<int>"))
    return F.size(F.filter(places, lambda i: reduce(lambda a, b: a & b, [F.get(words, i + k) == w for k, w in enumerate(clause.words)])))


def search(df: DataFrame, query: str, text: str = "text", id_column: str = "id", limit: int | None = None, skip: int = 0) -> DataFrame:
    """(id, score) of the hits. With a limit: the best first, ties by id."""
    clauses = parse(query)
    columns = {c.field or text for c in clauses}
    words = df.select(F.col(id_column), *[terms(F.col(f"`{c}`")).alias(f"_{i}") for i, c in enumerate(sorted(columns))])
    name = {c: f"_{i}" for i, c in enumerate(sorted(columns))}
    counted = words.select(id_column, *[occurrences(F.col(name[c.field or text]), c).alias(f"n{i}") for i, c in enumerate(clauses)])
    number = [F.col(f"n{i}") for i in range(len(clauses))]
    must = [number[i] > 0 for i, c in enumerate(clauses) if c.sign == "+"]
    never = [number[i] == 0 for i, c in enumerate(clauses) if c.sign == "-"]
    some = [number[i] > 0 for i, c in enumerate(clauses) if c.sign == ""]
    wanted = [*must, *never, *([reduce(lambda a, b: a | b, some)] if some and not must else [])]
    score = reduce(lambda a, b: a + b, [number[i] for i, c in enumerate(clauses) if c.sign != "-"], F.lit(0))
    hits = counted.where(reduce(lambda a, b: a & b, wanted)).select(id_column, score.cast("long").alias("score"))
    if limit is not None:
        hits = hits.orderBy(F.col("score").desc(), id_column).offset(skip).limit(limit)
    return hits
