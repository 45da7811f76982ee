"""Filters: as text in the documents' query language, and as combinable conditions."""

from __future__ import annotations

import re
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from docweave.sources.keyspace import CAS_FIELD, ID_FIELD

_TOKEN = re.compile(
    r"""(?P<quoted>'(?:[^'\\]|\\.|'')*'|"(?:[^"\\]|\\.|"")*"|`(?:[^`]|``)*`)"""
    r"""|(?P<meta>\bmeta\s*\(\s*(?:`?\w+`?)?\s*\)\s*\.\s*`?(?P<field>id|cas)`?)"""
    r"""|(?P<open>\[)|(?P<close>\])|(?P<word>\w+)|(?P<space>\s+)|(?P<other>.)""",
    re.I | re.S,
)


def rewrite(text: str, id_field: str = ID_FIELD, cas_field: str = CAS_FIELD) -> str:
    """Filter or statement text as Spark SQL: META().id and META().cas become columns, `IN [..]` becomes `IN (..)`, other brackets array(..). Quoted text stays as it is."""
    out, brackets, before = [], [], ""
    for m in _TOKEN.finditer(text):
        if m["meta"]:
            out.append(f"`{id_field if m['field'].lower() == 'id' else cas_field}`")
        elif m["open"]:
            subscript = bool(before) and (before[-1] in "`)]" or before[-1].isalnum()) and before.lower() not in ("in", "and", "or", "not", "select", "when", "then", "else", "where", "between", "like")
            brackets.append("]" if subscript else ")")
            out.append("[" if subscript else "(" if before.lower() == "in" else "array(")
        elif m["close"]:
            if not brackets:
                raise ValueError(f"a bracket is closed that was not opened: {text}")
            out.append(brackets.pop())
        else:
            out.append(m[0])
        if not m["space"]:
            before = m[0]
    if brackets:
        raise ValueError(f"a bracket is not closed: {text}")
    return "".join(out)


def text_filter(text: str, id_field: str = ID_FIELD, cas_field: str = CAS_FIELD) -> Column:
    """The condition of a user's filter text."""
    return F.expr(rewrite(text, id_field, cas_field))


def attribute(name: str) -> Column:
    """A column by dotted path; a name in single quotes is an expression as it stands."""
    if len(name) > 1 and name[0] == name[-1] == "'":
        return F.expr(name[1:-1])
    return F.col(".".join(p if p.startswith("`") else f"`{p}`" for p in name.split(".")))


def always_true() -> Column:
    return F.lit(True)


def always_false() -> Column:
    return F.lit(False)


def equal(name: str, value) -> Column:
    return attribute(name) == F.lit(value)


def equal_null_safe(name: str, value) -> Column:
    return attribute(name).eqNullSafe(F.lit(value))


def greater(name: str, value) -> Column:
    return attribute(name) > F.lit(value)


def greater_or_equal(name: str, value) -> Column:
    return attribute(name) >= F.lit(value)


def less(name: str, value) -> Column:
    return attribute(name) < F.lit(value)


def less_or_equal(name: str, value) -> Column:
    return attribute(name) <= F.lit(value)


def is_in(name: str, values) -> Column:
    return attribute(name).isin(*values)


def is_null(name: str) -> Column:
    return attribute(name).isNull()


def is_not_null(name: str) -> Column:
    return attribute(name).isNotNull()


def contains(name: str, part: str) -> Column:
    return attribute(name).contains(part)


def starts_with(name: str, part: str) -> Column:
    """Literal: % and _ have no meaning."""
    return attribute(name).startswith(part)


def ends_with(name: str, part: str) -> Column:
    return attribute(name).endswith(part)


def both(left: Column, right: Column) -> Column:
    return left & right


def either(left: Column, right: Column) -> Column:
    return left | right


def negated(condition: Column) -> Column:
    return ~condition


def all_of(conditions) -> Column:
    """The conjunction of conditions; of none it is true."""
    return reduce(both, conditions, always_true()) if conditions else always_true()
