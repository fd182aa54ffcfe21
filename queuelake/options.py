"""Option handling for queue sources and sinks (string options, like ``.option``).

Names follow the reader options users already pass to a queue stream:
``queue``, ``queueManager``, ``fileFormat``, ``split``, ``headers``,
``encoding``, ``movePath``, ``dataSource``, ``backoutQueue``, ``ackQueue``,
``error.queue`` (alias ``error queue``), ``error.queueManager`` and the
connection options ``host``/``port``/``channel``/``user`` (plus their
``error.`` forms), which are accepted but have no effect: queues are read
from a queue log, not from a live broker.
"""

from __future__ import annotations

import logging
from dataclasses import dataclass, field
from typing import Mapping

from .schema import FIXED_WIDTH_FORMAT, JSON_FORMAT, XML_FORMAT

log = logging.getLogger(__name__)

_CONNECTION_KEYS = ("host", "port", "channel", "user")

# Fixed value: suffix of the default backout queue name.
BACKOUT_SUFFIX = ".BACKOUT"

# Charset spellings Spark's encode/decode accept without
# legacy settings, and common Java aliases mapped onto them.
_CHARSETS = {
    "UTF8": "UTF-8",
    "UTF-8": "UTF-8",
    "ISO-8859-1": "ISO-8859-1",
    "ISO8859_1": "ISO-8859-1",
    "LATIN1": "ISO-8859-1",
    "US-ASCII": "US-ASCII",
    "ASCII": "US-ASCII",
    "UTF-16": "UTF-16",
    "UTF-16BE": "UTF-16BE",
    "UTF-16LE": "UTF-16LE",
    "UTF-32": "UTF-32",
}


def normalize_charset(name: str | None) -> str:
    if not name:
        return "UTF-8"
    return _CHARSETS.get(name.strip().upper(), name.strip())


def _lower(options: Mapping[str, str] | None) -> dict[str, str]:
    return {str(k).lower(): ("" if v is None else str(v)) for k, v in (options or {}).items()}


def _blank(v: str | None) -> bool:
    return v is None or not str(v).strip()


@dataclass(frozen=True)
class QueueOptions:
    queue: str
    queue_manager: str
    path: str | None = None
    file_format: str = XML_FORMAT
    split: str | None = None
    headers: tuple[str, ...] = ()
    encoding: str = "UTF-8"
    move_paths: tuple[str, ...] = ()
    data_source: str | None = None
    backout_queue: str | None = None
    ack_queue: str | None = None
    error_queue: str | None = None
    error_queue_manager: str | None = None
    num_partitions: int | None = None
    port: int = 0
    error_port: int = 0
    extra: dict = field(default_factory=dict, compare=False)

    @classmethod
    def from_dict(cls, options: Mapping[str, str] | None) -> "QueueOptions":
        o = _lower(options)
        for need in ("queue", "queuemanager"):
            if _blank(o.get(need)):
                raise ValueError(f"option '{need}' is required")
        queue = o["queue"].strip()
        qmgr = o["queuemanager"].strip()
        ignored = [k for k in o if k in _CONNECTION_KEYS or k.startswith("error.") and k[6:] in _CONNECTION_KEYS]
        if ignored:
            log.warning("connection options %s have no effect on a queue log", sorted(ignored))
        fmt = (o.get("fileformat") or XML_FORMAT).strip().upper()
        headers = tuple(h.strip() for h in o.get("headers", "").split(",") if h.strip())
        if len(set(headers)) != len(headers):
            raise ValueError(f"duplicate header block names in {headers}")
        error_queue = o.get("error.queue") or o.get("error queue") or None
        error_queue = None if _blank(error_queue) else error_queue.strip()
        backout = o.get("backoutqueue")
        if error_queue:
            # a configured error queue disables the backout queue
            backout = None
        elif _blank(backout):
            backout = queue + BACKOUT_SUFFIX
        nparts = o.get("numpartitions")
        return cls(
            queue=queue,
            queue_manager=qmgr,
            path=o.get("path") or None,
            file_format=fmt,
            split=None if _blank(o.get("split")) else o["split"].strip(),
            headers=headers,
            encoding=normalize_charset(o.get("encoding")),
            move_paths=tuple(p.strip() for p in o.get("movepath", "").split(",") if p.strip()),
            data_source=o.get("datasource") or queue,
            backout_queue=backout,
            ack_queue=None if _blank(o.get("ackqueue")) else o["ackqueue"].strip(),
            error_queue=error_queue,
            error_queue_manager=None if _blank(o.get("error.queuemanager")) else o["error.queuemanager"].strip(),
            num_partitions=int(nparts) if not _blank(nparts) else None,
            port=int(o.get("port") or 0),
            error_port=int(o.get("error.port") or 0),
            extra={k: v for k, v in o.items()},
        )

    def splitter_options(self) -> dict:
        out: dict = {}
        if self.split:
            out["split"] = self.split
        if self.headers:
            out["headers"] = list(self.headers)
        if self.file_format == FIXED_WIDTH_FORMAT or self.encoding != "UTF-8":
            out["encoding"] = self.encoding
        return out


@dataclass(frozen=True)
class DeadLetterTarget:
    queue_manager: str
    queue: str
    kind: str  # "backout" or "error"


def dead_letter_target(opts: QueueOptions | Mapping[str, str]) -> DeadLetterTarget:
    """Where messages that cannot be processed go.

    A configured error queue wins (it disables the backout queue) and lives on
    ``error.queueManager`` when that is set, else on the primary queue manager.
    Otherwise the backout queue of the primary queue manager is used.  With
    neither, there is nowhere safe to put a failed message, so this raises
    instead of dropping data.
    """
    if not isinstance(opts, QueueOptions):
        opts = QueueOptions.from_dict(opts)
    if opts.error_queue:
        return DeadLetterTarget(opts.error_queue_manager or opts.queue_manager, opts.error_queue, "error")
    if opts.backout_queue:
        return DeadLetterTarget(opts.queue_manager, opts.backout_queue, "backout")
    raise ValueError("no backout queue and no error queue configured: failed messages would be lost")


__all__ = [
    "QueueOptions",
    "DeadLetterTarget",
    "dead_letter_target",
    "normalize_charset",
    "FIXED_WIDTH_FORMAT",
    "JSON_FORMAT",
    "XML_FORMAT",
]
