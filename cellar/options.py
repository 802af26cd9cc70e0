"""Options of a crawl-table ingest: one frozen object, validated up front."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field, replace
from typing import TYPE_CHECKING

if TYPE_CHECKING:  # pragma: no cover
    from pyspark.sql import Column, DataFrame

# Fixed values that must equal the reference's defaults: family names,
# qualifier names and the default content size limit (20 MiB).
DEFAULT_CONTENT_FAMILY = "content"
DEFAULT_CONTENT_QUALIFIER = "raw_data"
DEFAULT_CURI_FAMILY = "curi"
DEFAULT_IP_QUALIFIER = "ip"
DEFAULT_PATH_FROM_SEED_QUALIFIER = "path-from-seed"
DEFAULT_IS_SEED_QUALIFIER = "is-seed"
DEFAULT_VIA_QUALIFIER = "via"
DEFAULT_URL_QUALIFIER = "url"
DEFAULT_REQUEST_QUALIFIER = "request"
DEFAULT_MAX_CONTENT_BYTES = 20 * 1024 * 1024
# Annotation added to a record the size gate keeps out.
UNWRITTEN_SIZE = "unwritten:size"

# The built-in cells: (logical field, family attribute, qualifier attribute, clock).
# "fetch" cells are versioned by the fetch-begin time, "write" cells by store time.
BUILTIN_CELLS = (
    ("url", "curi_family", "url_qualifier", "fetch"),
    ("ip", "curi_family", "ip_qualifier", "fetch"),
    ("is_seed", "curi_family", "is_seed_qualifier", "write"),
    ("path_from_seed", "curi_family", "path_from_seed_qualifier", "write"),
    ("via", "curi_family", "via_qualifier", "write"),
    ("request", "curi_family", "request_qualifier", "write"),
    ("raw_data", "content_family", "content_qualifier", "write"),
)


def stored_name(family: str, qualifier: str) -> str:
    """Flat column name of a cell in the wide put-row layout."""
    return f"{family}__{qualifier}".replace("-", "_").replace(":", "_")


class _Made(dict):
    def __call__(self, name: str, make: Callable[[], object]):
        if name not in self:
            self[name] = make()
        return self[name]


@dataclass(frozen=True)
class CrawlOptions:
    """Everything an ingest needs to know. ``table`` is required.

    Gates are Columns over the record schema (None = always true); the
    serializer maps a BINARY Column to a BINARY Column; the content hook maps a
    DataFrame ``(row_key, seq, body, ...)`` to one with extra ``family__qualifier``
    columns.
    """

    table: str | None = None
    content_family: str = DEFAULT_CONTENT_FAMILY
    content_qualifier: str = DEFAULT_CONTENT_QUALIFIER
    curi_family: str = DEFAULT_CURI_FAMILY
    url_qualifier: str = DEFAULT_URL_QUALIFIER
    ip_qualifier: str = DEFAULT_IP_QUALIFIER
    is_seed_qualifier: str = DEFAULT_IS_SEED_QUALIFIER
    path_from_seed_qualifier: str = DEFAULT_PATH_FROM_SEED_QUALIFIER
    via_qualifier: str = DEFAULT_VIA_QUALIFIER
    request_qualifier: str = DEFAULT_REQUEST_QUALIFIER
    max_content_bytes: int = DEFAULT_MAX_CONTENT_BYTES
    md5_key: bool = False
    serializer: Callable[[Column], Column] | None = None
    only_write_new: bool = False
    only_process_new: bool = False
    max_total_bytes: int = 0
    base_process_gate: Column | None = None
    base_write_gate: Column | None = None
    content_hook: Callable[[DataFrame], DataFrame] | None = None
    side_outputs: dict = field(default_factory=dict)
    hosts: DataFrame | None = None  # host -> ip, used for records without an ip

    def __post_init__(self) -> None:
        self.validate()

    def validate(self) -> None:
        if not self.table:
            raise ValueError("a table name is required")
        if self.content_family.lower() == self.curi_family.lower():
            raise ValueError(
                f"content and curi families must differ (case-insensitively): "
                f"{self.content_family!r} vs {self.curi_family!r}"
            )
        names = [getattr(self, a) for a in self.__dataclass_fields__ if a.endswith(("_family", "_qualifier"))]
        if any(not n or not isinstance(n, str) for n in names):
            raise ValueError("family and qualifier names must be non-empty strings")
        stored = [stored_name(getattr(self, f), getattr(self, q)) for _, f, q, _ in BUILTIN_CELLS]
        if len({s.lower() for s in stored}) != len(stored):
            raise ValueError(f"two cells map to one stored column: {stored}")
        if self.max_content_bytes < 0 or self.max_total_bytes < 0:
            raise ValueError("byte limits must be >= 0")

    def with_(self, **changes) -> CrawlOptions:
        return replace(self, **changes)

    def made(self, name: str, make: Callable[[], object]):
        """What ``make()`` returns, made once for these options: Columns of a plan that is built again for every micro-batch."""
        from pyspark import SparkContext

        return self.__dict__.setdefault("_made", {}).setdefault(id(SparkContext._gateway), _Made())(name, make)  # noqa: SLF001

    @property
    def only_new(self) -> bool:
        return self.only_write_new or self.only_process_new

    def cell_specs(self) -> list[tuple[str, str, str, str, str]]:
        """(field, family, qualifier, stored column, clock) for the built-in cells."""
        out = []
        for fld, fam_attr, qual_attr, clock in BUILTIN_CELLS:
            fam, qual = getattr(self, fam_attr), getattr(self, qual_attr)
            out.append((fld, fam, qual, stored_name(fam, qual), clock))
        return out

    def stored(self, fld: str) -> str:
        for f, _, _, col, _ in self.cell_specs():
            if f == fld:
                return col
        raise KeyError(fld)

    @property
    def families(self) -> tuple[str, str]:
        return (self.content_family, self.curi_family)
