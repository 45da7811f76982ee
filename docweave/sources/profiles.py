"""The four ways to read a collection. They share one scan; this table says how they differ."""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class Profile:
    name: str
    #: options that must be given, and whether implicit keyspaces fill the others
    required: tuple[str, ...]
    implicit: bool
    id_column: bool
    cas_column: bool
    partitioned: bool
    writable: bool
    #: whether there is an option to switch aggregate push-down off (Catalyst decides it, so it makes no difference to results)
    aggregate_switch: bool


QUERY = Profile("query", (), True, True, True, True, True, True)
ANALYTICS = Profile("analytics", ("dataset",), True, True, False, False, False, True)
COLUMNAR = Profile("columnar", ("database", "scope", "collection"), False, False, False, False, False, False)
ENTERPRISE = Profile("enterprise-analytics", ("database", "scope", "collection"), False, False, False, False, False, False)
PROFILES = {p.name: p for p in (QUERY, ANALYTICS, COLUMNAR, ENTERPRISE)}
CONSISTENCIES = ("notBounded", "requestPlus")


def profile(name: str) -> Profile:
    try:
        return PROFILES[name]
    except KeyError:
        raise ValueError(f"Unknown profile {name!r}; there are {', '.join(PROFILES)}") from None


def check_consistency(value: str | None) -> str:
    """notBounded may read the snapshot that this session knows, requestPlus looks for the latest."""
    if value is None:
        return CONSISTENCIES[0]
    if value not in CONSISTENCIES:
        raise ValueError(f"Unknown scanConsistency of {value}")
    return value
