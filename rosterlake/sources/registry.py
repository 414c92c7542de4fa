"""Which source delivers which entity, and how it is read."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame

from rosterlake.schemas import APPLICATION_FIELD_MAP, ENTITY_FIELDS, WORKER_FIELD_MAP
from rosterlake.sources.mapping import (
    map_applications,
    map_workers,
    map_wrapped_applications,
    map_wrapped_employees,
)
from rosterlake.sources.pages import read_pages, read_wrapped


@dataclass(frozen=True)
class Source:
    """A source system: its name in the envelope and one mapping per entity it owns.

    ``field_maps`` lists the names of its own that stand for canonical fields.
    """

    name: str
    read: Callable[..., DataFrame]
    mappings: dict[str, Callable[..., DataFrame]]
    optional: bool = False
    field_maps: dict[str, dict[str, str]] = field(default_factory=dict)

    def field_map(self, entity: str) -> dict[str, str]:
        return self.field_maps.get(entity) or {f.name: f.name for f in ENTITY_FIELDS[entity]}

    def mapping(self, entity: str) -> Callable[..., DataFrame]:
        """Mapping for ``entity``; refused before any job starts when not owned."""
        try:
            return self.mappings[entity]
        except KeyError:
            raise NotImplementedError(f"no mapping of {entity} from {self.name}") from None


WORKDAY = Source(
    "workday", read_pages, {"employees": map_workers}, field_maps={"employees": WORKER_FIELD_MAP}
)
GREENHOUSE = Source(
    "greenhouse",
    read_pages,
    {"job_applications": map_applications},
    field_maps={"job_applications": APPLICATION_FIELD_MAP},
)
AIRTABLE = Source(
    "airtable",
    read_wrapped,
    {"employees": map_wrapped_employees, "job_applications": map_wrapped_applications},
    optional=True,
)

SOURCES = {s.name: s for s in (WORKDAY, GREENHOUSE, AIRTABLE)}
