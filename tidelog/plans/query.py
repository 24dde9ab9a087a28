"""The query record: what to read, how to decode it, how to shape it."""

from __future__ import annotations

import hashlib
import json
from dataclasses import asdict, dataclass, field
from datetime import datetime

from tidelog.operators.flatten import FlattenOptions

OFFSETS = ("latest", "earliest", "last_n")
FORMATS = ("json", "avro", "protobuf", "plaintext", "lineprotocol")
KEY_FORMATS = ("none", "string", "json", "base64")
TIME_MODES = ("message", "now")
PRECISIONS = ("auto", "ns", "us", "ms", "s")
SCHEMA_SOURCES = ("registry", "inline")
SHAPES = ("long", "wide", "variant")
DEFAULT_LAST_N = 100


@dataclass(frozen=True)
class TopicQuery:
    """One query over one topic. Unset values take the documented defaults.

    ``start_time`` and ``end_time`` bound the times of messages, both included.
    ``extra`` adds to the wide shape of JSON a map of all paths that are no
    column.
    """

    topic: str
    partition: int | str = "all"
    offset: str = "latest"
    last_n: int = DEFAULT_LAST_N
    start_time: datetime | None = None
    end_time: datetime | None = None
    format: str = "json"
    key_format: str = "none"
    time_mode: str = "message"
    schema_source: str = "registry"
    schema: str | bytes | None = None
    message_name: str | None = None
    wire_format: str = "auto"
    lp_precision: str = "auto"
    lp_measurements: str = ""
    lp_fields: str = ""
    lp_tags: str = ""
    ref_id: str = ""
    alias: str = ""
    shape: str = "wide"
    extra: bool = False
    drop_control: bool = True
    flatten: FlattenOptions = field(default_factory=FlattenOptions)

    def __post_init__(self) -> None:
        _one_of("offset", self.offset, OFFSETS)
        _one_of("format", self.format, FORMATS)
        _one_of("key_format", self.key_format, KEY_FORMATS)
        _one_of("time_mode", self.time_mode, TIME_MODES)
        _one_of("schema_source", self.schema_source, SCHEMA_SOURCES)
        _one_of("lp_precision", self.lp_precision, PRECISIONS)
        _one_of("shape", self.shape, SHAPES)
        _one_of("wire_format", self.wire_format, ("auto", "confluent", "raw"))
        for time in (self.start_time, self.end_time):
            if time is not None and time.tzinfo is None:
                raise ValueError("a time bound needs a time zone")
        if self.extra and (self.format, self.shape) != ("json", "wide"):
            raise ValueError("extra is for the wide shape of JSON")
        object.__setattr__(self, "last_n", effective_last_n(self.last_n))

    @property
    def is_valid(self) -> bool:
        """A query without a topic or partition is skipped, not an error."""
        return bool(self.topic) and self.partition not in ("", None)

    def fingerprint(self) -> str:
        """Stable hash of every setting; names the stream's checkpoint."""
        record = asdict(self)
        if isinstance(self.schema, bytes):
            record["schema"] = self.schema.hex()
        for bound in ("start_time", "end_time"):
            time = record.pop(bound)
            if time is not None:
                record[bound] = time.isoformat()
        if not record["extra"]:
            del record["extra"]
        return hashlib.sha256(json.dumps(record, sort_keys=True).encode()).hexdigest()[:16]


def effective_last_n(n: int) -> int:
    """Zero or less means the default; there is no upper bound."""
    return DEFAULT_LAST_N if n <= 0 else n


def _one_of(name: str, value: object, allowed: tuple[str, ...]) -> None:
    if value not in allowed:
        raise ValueError(f"{name} must be one of {', '.join(allowed)}, got {value!r}")
