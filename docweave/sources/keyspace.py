"""Names of document collections."""

from __future__ import annotations

from dataclasses import dataclass, replace

DEFAULT_SCOPE = "_default"
DEFAULT_COLLECTION = "_default"
ID_FIELD = "__META_ID"
CAS_FIELD = "__META_CAS"
INFER_LIMIT = 1000


@dataclass(frozen=True)
class Keyspace:
    """bucket, scope and collection of a collection of documents; each may be left open."""

    bucket: str | None = None
    scope: str | None = None
    collection: str | None = None

    @property
    def is_empty(self) -> bool:
        return self.bucket is None and self.scope is None and self.collection is None

    def filled(self, other: Keyspace) -> Keyspace:
        """This keyspace with its open parts taken from another."""
        return Keyspace(self.bucket or other.bucket, self.scope or other.scope, self.collection or other.collection)

    def with_defaults(self) -> Keyspace:
        return replace(self, scope=self.scope or DEFAULT_SCOPE, collection=self.collection or DEFAULT_COLLECTION)

    @property
    def path(self) -> str:
        full = self.with_defaults()
        if not full.bucket:
            raise ValueError("a bucket is needed")
        return "/".join(_safe(x) for x in (full.bucket, full.scope, full.collection))

    @property
    def table_name(self) -> str:
        """`bucket`, or `bucket:scope:collection` if either of the others is given."""
        if self.scope is None and self.collection is None:
            return self.bucket or ""
        full = self.with_defaults()
        return f"{full.bucket or ''}:{full.scope}:{full.collection}"

    @property
    def qualified(self) -> str:
        """Three-part name, each part in backticks."""
        full = self.with_defaults()
        return ".".join("`" + (x or "").replace("`", "``") + "`" for x in (full.bucket, full.scope, full.collection))

    @property
    def query_context(self) -> str:
        """What unqualified names of a raw statement refer to."""
        if not self.bucket or not self.scope:
            raise ValueError("a query context needs a bucket (or database) and a scope")
        return f"default:`{self.bucket}`.`{self.scope}`"


def _safe(name: str) -> str:
    if not name or "/" in name or name in (".", ".."):
        raise ValueError(f"{name!r} can't name a bucket, scope or collection")
    return name
