"""Load configuration: text parsing, templates, layered settings."""

from __future__ import annotations

import dataclasses
import re
from dataclasses import dataclass, field
from datetime import datetime
from typing import Any

import yaml

# The texts that mean "true" in a configuration file.
TRUE_TEXTS = ("True", "true", "Yes", "yes", "1")
FALSE_TEXTS = ("false", "no", "0", "")

_PLACEHOLDER = re.compile(r"\{(\w+)\}")
_QUOTED = re.compile(r"""^(['"]).*\1$""", re.DOTALL)


def text_to_bool(text: str) -> bool:
    if not isinstance(text, str):
        raise TypeError(f"expected text, got {type(text).__name__}")
    return text.strip() in TRUE_TEXTS


def as_flag(value: bool | str | None) -> bool:
    """A YAML flag, whether written as a boolean or as text, in any letters; text that is neither raises."""
    if value is None or isinstance(value, bool):
        return bool(value)
    text = str(value).strip().lower()
    if text not in FALSE_TEXTS and text not in {t.lower() for t in TRUE_TEXTS}:
        raise ValueError(f"{value!r} is neither true nor false")
    return text not in FALSE_TEXTS


def date_split(run_date: str) -> tuple[str, str, str]:
    """``'2024-04-30'`` → ``('2024', '04', '30')``."""
    if not isinstance(run_date, str):
        raise TypeError(f"run date must be text, got {type(run_date).__name__}")
    day = datetime.strptime(run_date, "%Y-%m-%d")
    return f"{day:%Y}", f"{day:%m}", f"{day:%d}"


def _quote(value: Any) -> Any:
    if not isinstance(value, str):
        return value
    text = value.strip()
    return text if _QUOTED.match(text) and len(text) > 1 else f"'{text}'"


def render(template: str, values: dict[str, Any], strict: bool = False, add_quotes: bool = False) -> str:
    """Fill ``{name}`` placeholders.

    A name without a value stays as it is, or raises ``KeyError`` when ``strict``.
    ``add_quotes`` quotes text values that are not quoted yet.
    """

    def fill(match: re.Match) -> str:
        name = match.group(1)
        if name not in values:
            if strict:
                raise KeyError(f"no value for placeholder {name!r}")
            return match.group(0)
        return str(_quote(values[name]) if add_quotes else values[name])

    return _PLACEHOLDER.sub(fill, template)


def collate_column_specs(audit: list[dict] | None, table: list[dict] | None) -> list[dict]:
    """Audit columns in order, each replaced by a table column of the same name; then the other table columns."""
    by_name = {spec["column_name"]: spec for spec in audit or []}
    by_name |= {spec["column_name"]: spec for spec in table or []}
    return list(by_name.values())


@dataclass(frozen=True)
class LoadConfig:
    """Settings of one load. Names follow the configuration files."""

    # source
    ingest_type: str = "csv"
    run_date: str | None = None
    run_dates: list[str] | None = None
    source_location: str | None = None
    source_base_location: str = ""
    source_reference_location: str = ""
    source_folder_date_pattern: str = ""
    source_file_name_prefix: str = ""
    source_file_name_date_pattern: str = ""
    source_file_extension: str = ""
    source_table: str | None = None
    sql_query: str | None = None
    sql_file_location: str | None = None
    sqls: list[dict] | None = None
    schema: dict[str, dict] | None = None
    delimiter: str = ","
    quote: str | None = None
    multi_line: bool | str = False
    corrupt_record_column: str | None = None
    corrupt_record_action: str = "ERROR"
    unparsed: str = "fail"
    path_column: str | None = None
    run_date_column: str | None = None
    missing_dates: str = "fail"
    # shape
    columns: list[str] | None = None
    where_clause: str | None = None
    deduplication: dict | None = None
    column_mappings: dict[str, str] | None = None
    custom_transformations: list = field(default_factory=list)
    audit_columns_to_be_added: list[dict] = field(default_factory=list)
    table_columns_to_be_added: list[dict] = field(default_factory=list)
    validations: list = field(default_factory=list)
    # target
    target_catalog: str = "spark_catalog"
    target_schema: str = "default"
    target_table: str | None = None
    quarantine_target_catalog: str | None = None
    quarantine_target_schema: str | None = None
    quarantine_target_table: str | None = None
    write_mode: str = "append"
    partition_by: list[str] | None = None
    merge: dict | None = None
    dry_run: bool | str = False
    skip_write: bool | str = False
    # run ledger
    job_details_table_name: str | None = None
    env: str | None = None
    job_name: str | None = None
    frequency: str | None = None
    source_system: str | None = None
    source: str | None = None
    source_type: str | None = None
    load_type: str | None = None
    job_id: str | None = None
    run_id: str | None = None
    job_run_details_table_name: str | None = None
    validation_run_details_table_name: str | None = None
    wait_before_reprocessing_in_seconds: int = 0
    # anything else is only a template value
    extra: dict[str, Any] = field(default_factory=dict)

    @classmethod
    def from_layers(cls, *layers: dict[str, Any] | None) -> LoadConfig:
        """Merge settings; a later layer wins (common file, table file, arguments)."""
        merged: dict[str, Any] = {}
        for layer in layers:
            merged |= layer or {}
        known = {f.name for f in dataclasses.fields(cls)} - {"extra"}
        settings = {k: v for k, v in merged.items() if k in known}
        return cls(**settings, extra={k: v for k, v in merged.items() if k not in known})

    @classmethod
    def from_arguments(cls, arguments: dict[str, Any]) -> LoadConfig:
        """Settings from the common and table files the arguments name, and then the arguments themselves."""
        names = ("common_config_file_location", "table_config_file_location")
        return cls.from_layers(*[load_yaml(arguments[n]) for n in names if arguments.get(n)], arguments)

    @property
    def values(self) -> dict[str, Any]:
        """Template namespace."""
        own = {f.name: getattr(self, f.name) for f in dataclasses.fields(self) if f.name != "extra"}
        return self.extra | {k: v for k, v in own.items() if v is not None}

    def require(self, *names: str) -> None:
        missing = [n for n in names if not getattr(self, n)]
        if missing:
            raise ValueError(f"missing mandatory settings: {missing}")

    @property
    def target(self) -> str:
        self.require("target_catalog", "target_schema", "target_table")
        return f"{self.target_catalog}.{self.target_schema}.{self.target_table}"

    @property
    def quarantine(self) -> str:
        catalog = self.quarantine_target_catalog or self.target_catalog
        schema = self.quarantine_target_schema or self.target_schema
        table = self.quarantine_target_table or f"{self.target_table}_quarantine"
        return f"{catalog}.{schema}.{table}"


def load_yaml(path: str) -> dict[str, Any]:
    with open(path, encoding="utf-8") as handle:
        return yaml.safe_load(handle) or {}
