"""Connection settings in layers.

Settings stand in Spark's configuration under PREFIX. A setting for the
connection `id` is found, in this order, in the identifier itself if that is a
URI (scheme://user:password@root?key=value), under `key:id`, and under the
plain key.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from urllib.parse import parse_qsl, unquote, urlsplit

from docweave.sources.keyspace import Keyspace

PREFIX = "spark.docweave."
SSL_PREFIX = "spark.ssl."
KEYS = (
    "root username password implicitBucket implicitScope implicitCollection waitUntilReadyTimeout keyStorePath keyStorePassword keyStoreType"
).split()
DURATION_UNITS = {"ns": 1e-9, "us": 1e-6, "µs": 1e-6, "ms": 1e-3, "s": 1.0, "second": 1.0, "seconds": 1.0, "m": 60.0, "min": 60.0, "minute": 60.0, "minutes": 60.0, "h": 3600.0, "hour": 3600.0, "hours": 3600.0, "d": 86400.0, "day": 86400.0, "days": 86400.0}


class ConfigError(ValueError):
    """A setting is missing or contradicts another."""


def parse_duration(text: str) -> float:
    """Seconds of a duration such as '10s' or '100 ms'."""
    stripped = text.strip()
    number = stripped.rstrip("".join(c for c in stripped if c.isalpha() or c == "µ")).strip()
    unit = stripped[len(number) :].strip() if stripped.startswith(number) else ""
    try:
        return float(number) * DURATION_UNITS[unit]
    except (ValueError, KeyError):
        raise ConfigError(f"{text!r} is no duration; write a number and a unit, such as '10s'") from None


@dataclass(frozen=True)
class Connection:
    """What an identifier resolves to."""

    identifier: str | None
    root: str
    username: str | None = None
    password: str | None = field(default=None, repr=False)
    key_store: tuple[str, str, str] | None = field(default=None, repr=False)
    implicit: Keyspace = Keyspace()
    wait_until_ready: float | None = None
    secure: bool = False
    insecure: bool = False
    properties: dict[str, str] = field(default_factory=dict)

    def keyspace(self, bucket: str | None = None, scope: str | None = None, collection: str | None = None) -> Keyspace:
        """The given names, with the implicit ones in open places. A bucket must come from one of both."""
        found = Keyspace(bucket, scope, collection).filled(self.implicit)
        if not found.bucket:
            raise ConfigError(f"Neither a bucket was given nor an implicit bucket is configured{_named(self.identifier)}")
        return found


def _named(identifier: str | None) -> str:
    return f" (connection identifier {identifier!r})" if identifier else ""


class Settings:
    """A flat mapping of settings, such as Spark's configuration, looked up by identifier."""

    def __init__(self, values: dict[str, str]):
        self.values = dict(values)

    @staticmethod
    def of(spark) -> Settings:
        values = dict(spark.sparkContext.getConf().getAll())
        # what was set on the session counts more
        values |= {k: spark.conf.get(k) for prefix in (PREFIX, SSL_PREFIX) for k in _session_keys(spark, prefix)}
        return Settings(values)

    def get(self, key: str, identifier: str | None = None, prefix: str = PREFIX) -> str | None:
        if identifier and "://" in identifier:
            inside = _from_uri(identifier)
            if key in inside:
                return inside[key]
        elif identifier and (found := self.values.get(f"{prefix}{key}:{identifier}")) is not None:
            return found
        return self.values.get(f"{prefix}{key}")

    def connection(self, identifier: str | None = None) -> Connection:
        get = lambda key: self.get(key, identifier)
        root = get("root")
        if not root:
            raise ConfigError(f"The setting {PREFIX}root{':' + identifier if identifier else ''} is needed and not there")
        user, password = get("username"), get("password")
        store = tuple(get(k) for k in ("keyStorePath", "keyStorePassword", "keyStoreType"))
        if (user is None) != (password is None):
            raise ConfigError(f"If one of username and password is given, the other is needed too{_named(identifier)}")
        if any(store) and not all(store):
            raise ConfigError(f"keyStorePath, keyStorePassword and keyStoreType belong together{_named(identifier)}")
        if user is not None and all(store):
            raise ConfigError(f"Either username and password or a key store can be given, not both{_named(identifier)}")
        if user is None and not all(store) and self._needs_authentication(identifier):
            raise ConfigError(f"Either username and password or a key store is needed{_named(identifier)}")
        truth = lambda key: (self.get(key, identifier, SSL_PREFIX) or "false").lower() == "true"
        wait = get("waitUntilReadyTimeout")
        return Connection(
            identifier,
            root.rstrip("/"),
            user,
            password,
            store if all(store) else None,
            Keyspace(get("implicitBucket"), get("implicitScope"), get("implicitCollection")),
            parse_duration(wait) if wait else None,
            truth("enabled"),
            truth("insecure"),
            self.properties(identifier),
        )

    def _needs_authentication(self, identifier: str | None) -> bool:
        return (self.get("authentication", identifier) or "optional").lower() == "required"

    def properties(self, identifier: str | None = None) -> dict[str, str]:
        """Other settings under PREFIX, handed through. Those of the identifier count more than plain ones; those of other identifiers don't."""
        plain, own = {}, {}
        for name, value in sorted(self.values.items()):
            if not name.startswith(PREFIX):
                continue
            key, colon, of = name[len(PREFIX) :].partition(":")
            if key in KEYS or key == "authentication":
                continue
            if not colon:
                plain[key] = value
            elif of == identifier:
                own[key] = value
        inside = {k: v for k, v in _from_uri(identifier).items() if k not in KEYS} if identifier and "://" in identifier else {}
        return plain | own | inside


def _from_uri(identifier: str) -> dict[str, str]:
    parts = urlsplit(identifier)
    out = dict(parse_qsl(parts.query, keep_blank_values=True))
    at = parts.netloc.rpartition("@")[2]
    out["root"] = f"{parts.scheme}://{at}{parts.path}"
    if parts.username is not None:
        out["username"] = unquote(parts.username)
    if parts.password is not None:
        out["password"] = unquote(parts.password)
    return out


def _session_keys(spark, prefix: str) -> list[str]:
    return [r["key"] for r in spark.sql("SET").where(f"key LIKE '{prefix}%'").select("key").collect()]


_connections: dict[tuple[str, str | None], Connection] = {}


def connect(spark, identifier: str | None = None) -> Connection:
    """The connection of an identifier; an application resolves each of them once."""
    key = (spark.sparkContext.applicationId, identifier)
    if key not in _connections:
        _connections[key] = Settings.of(spark).connection(identifier)
    return _connections[key]


def disconnect_all() -> None:
    _connections.clear()
