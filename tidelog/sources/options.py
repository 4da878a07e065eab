"""Options of sources and sinks: names, defaults, checks."""

from __future__ import annotations

import re
from dataclasses import dataclass, field
from urllib.parse import urlsplit

ALL_TABLES = "*"
#: Rows in a page of a snapshot, where no other size is given.
FETCH_SIZE = 50_000


class OptionsError(ValueError):
    """One or more options are wrong; the message has a line for each."""


def option(raw: dict[str, str], name: str) -> str | None:
    """An option by its public name, in whatever case it was given."""
    return next((v for k, v in raw.items() if k.lower() == name.lower()), None)


def _url_error(url: str) -> str | None:
    if not url:
        return "url is required"
    try:
        parts = urlsplit(url.removeprefix("jdbc:"))
        port = parts.port
    except ValueError as e:
        return f"invalid url: {e}"
    del port
    return None if parts.scheme or "=" in url else f'invalid url: cannot parse "{url}"'


@dataclass
class SourceOptions:
    url: str = ""
    tables: list[str] = field(default_factory=list)
    snapshot_mode: str = "initial"
    fetch_size: int = FETCH_SIZE
    cdc_mode: str = "auto"
    publication: str = "tidelog_pub"
    slot: str = "tidelog_slot"
    auto_cleanup: bool = True
    with_avro_schema: bool = True
    #: Snapshots begin after key 0 unless this is set.
    include_nonpositive_keys: bool = False
    #: At most this many changes in a micro-batch; 0: all there are.
    batch_size: int = 0
    batch_delay: str = "1 second"

    def validate(self) -> SourceOptions:
        errors = [e for e in [_url_error(self.url)] if e]
        if not self.tables:
            errors.append("tables is required")
        if self.snapshot_mode not in ("initial", "never"):
            errors.append(f'"snapshotMode" value must be included in the list [initial never], got "{self.snapshot_mode}"')
        if self.cdc_mode not in ("auto", "logrepl"):
            errors.append(f'"cdcMode" value must be included in the list [auto logrepl], got "{self.cdc_mode}"')
        if not re.fullmatch("[a-z0-9_]+", self.slot):
            errors.append(f'slot name "{self.slot}" should match the regex "^[a-z0-9_]+$"')
        if self.fetch_size < 0 or self.batch_size < 0:
            errors.append("sizes must not be negative")
        if errors:
            raise OptionsError("\n".join(errors))
        self.fetch_size = self.fetch_size or FETCH_SIZE
        return self

    @classmethod
    def parse(cls, raw: dict[str, str]) -> SourceOptions:
        """From string options by their public names, in any case."""
        raw = {n: v for n, *_ in SPECIFICATION if (v := option(raw, n)) is not None}
        true = lambda k, d: str(raw.get(k, d)).lower() in ("true", "1", "t")
        return cls(
            url=raw.get("url", ""),
            tables=[t.strip() for t in raw.get("tables", "").split(",") if t.strip()],
            snapshot_mode=raw.get("snapshotMode", "initial"),
            fetch_size=int(raw.get("snapshot.fetchSize", FETCH_SIZE)),
            cdc_mode=raw.get("cdcMode", "auto"),
            publication=raw.get("logrepl.publicationName", cls.publication),
            slot=raw.get("logrepl.slotName", cls.slot),
            auto_cleanup=true("logrepl.autoCleanup", True),
            with_avro_schema=true("logrepl.withAvroSchema", True),
            include_nonpositive_keys=true("snapshot.includeNonpositiveKeys", False),
            batch_size=int(raw.get("batch.size", 0)),
            batch_delay=raw.get("batch.delay", cls.batch_delay),
        ).validate()


@dataclass
class SinkOptions:
    url: str = ""
    #: A table's name, or a Spark SQL expression over the record between {{ and }}.
    table: str = "{{ collection }}"

    def validate(self) -> SinkOptions:
        error = _url_error(self.url)
        if error:
            raise OptionsError(error)
        if self.is_template and not (self.table.startswith("{{") and self.table.endswith("}}") and self.table[2:-2].strip()):
            raise OptionsError(f'invalid table name or table function: table is neither a valid static table nor a valid template: "{self.table}"')
        return self

    @property
    def is_template(self) -> bool:
        return self.table.startswith("{{") or self.table.endswith("}}")

    @property
    def expression(self) -> str:
        return self.table[2:-2].strip()


# Public option names, with type, default and where they belong.
SPECIFICATION = [
    ("url", "string", "", "source, sink"),
    ("tables", "string", "", "source"),
    ("snapshotMode", "string", "initial", "source"),
    ("snapshot.fetchSize", "int", "50000", "source"),
    ("cdcMode", "string", "auto", "source"),
    ("logrepl.publicationName", "string", SourceOptions.publication, "source"),
    ("logrepl.slotName", "string", SourceOptions.slot, "source"),
    ("logrepl.autoCleanup", "bool", "true", "source"),
    ("logrepl.withAvroSchema", "bool", "true", "source"),
    ("snapshot.includeNonpositiveKeys", "bool", "false", "source"),
    ("batch.size", "int", "0", "source"),
    ("batch.delay", "duration", "1 second", "source"),
    ("table", "string", SinkOptions.table, "sink"),
]
