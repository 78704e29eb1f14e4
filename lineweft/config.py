"""Default names and limits used by the operators."""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class LineageConfig:
    """Names that are used where a document does not carry its own.

    ``max_depth`` is the nesting depth that is parsed into typed columns; deeper levels,
    any number of them, are parsed from text where a document has them.
    """

    source_resource: str = "script"
    target_resource: str = "script"
    source_schema: str = "<default>"
    target_schema: str = "<default>"
    script_database: str = "script_repo"
    script_schema: str = "script_schema"
    excluded_resource: str | None = None
    view_root_resource: str = "calculation_views"
    owned_table: str | None = None
    owned_resource_name: str | None = None
    max_depth: int = 8

    @property
    def script_path(self) -> str:
        return f"{self.script_database}/{self.script_schema}"
