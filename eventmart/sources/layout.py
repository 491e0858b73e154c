"""Where tables live."""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class Layout:
    """Paths below a root. With a prefix, layers are private to it: `<prefix>_<layer>`.

    `copy_buckets` and `published_buckets` say in how many parts the ids of events and of published ones are kept;
    choose them by size, say 200 MB a part, before the first load.
    """

    root: str
    prefix: str | None = None
    copy_buckets: int = 64
    published_buckets: int = 64

    def layer(self, name: str) -> str:
        """Name of a layer: verbatim, or prefixed."""
        return f"{self.prefix}_{name}" if self.prefix else name

    def path(self, layer: str, table: str) -> str:
        return f"{self.root.rstrip('/')}/{self.layer(layer)}/{table}"

    @property
    def raw_events(self) -> str:
        return self.path("bronze", "raw_events")

    @property
    def dead_letter(self) -> str:
        return self.path("bronze", "dead_letter")

    @property
    def dimension(self) -> str:
        return self.path("gold", "dim_repo_scd2")

    @property
    def fact(self) -> str:
        return self.path("gold", "fct_events_hourly")

    @property
    def run_log(self) -> str:
        return self.path("ops", "run_log")

    @property
    def published(self) -> str:
        return self.path("ops", "published")

    def incoming(self, load: str) -> str:
        return self.path("ops", f"incoming/{load}")

    @property
    def arriving(self) -> str:
        return self.path("ops", "arriving")

    def load_days(self, load: str) -> str:
        return self.path("ops", f"loads/{load}.json")

    @property
    def copies(self) -> str:
        return self.path("ops", "copies")

    @property
    def references(self) -> str:
        return self.path("ops", "references")

    @property
    def ledger(self) -> str:
        return self.path("ops", "check_ledger")

    def days(self, table: str) -> str:
        return self.path("ops", f"days/{table}")

    @property
    def compacting(self) -> str:
        return self.path("ops", "compacting.json")

    def pending(self, table: str) -> str:
        return self.path("ops", f"pending/{table}")

    def started(self, table: str) -> str:
        return self.path("ops", f"started/{table}")

    def columns(self, table: str) -> str:
        return self.path("ops", f"columns/{table}.json")

    def checkpoint(self, stream: str) -> str:
        return self.path("ops", f"checkpoint_{stream}")
