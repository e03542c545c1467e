"""Scans of folders named by run date."""

from __future__ import annotations

import re
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from loadkit.config import LoadConfig, date_split, render


@dataclass(frozen=True)
class DatedLayout:
    """Parts of a dated location; patterns may hold ``{year}``, ``{month}`` and ``{day}``."""

    base: str = ""
    reference: str = ""
    folder_pattern: str = ""
    prefix: str = ""
    file_pattern: str = ""
    extension: str = ""

    @classmethod
    def from_config(cls, cfg: LoadConfig) -> DatedLayout:
        return cls(
            base=cfg.source_base_location,
            reference=cfg.source_reference_location,
            folder_pattern=cfg.source_folder_date_pattern,
            prefix=cfg.source_file_name_prefix,
            file_pattern=cfg.source_file_name_date_pattern,
            extension=cfg.source_file_extension,
        )

    def location(self, run_date: str) -> str:
        year, month, day = date_split(run_date)
        parts = {"year": year, "month": month, "day": day}
        folder, file = (render(p, parts, strict=True) for p in (self.folder_pattern, self.file_pattern))
        return "".join([self.base, self.reference, folder, self.prefix, file, self.extension])


    def date_of(self, path: Column) -> Column:
        """The run date that a file's path was named by; null for a path of another form."""
        named = "".join([self.folder_pattern, self.prefix, self.file_pattern, self.extension])
        digits, groups, text = {"year": 4, "month": 2, "day": 2}, [], ""
        for part in re.split(r"(\{(?:year|month|day)\})", named):
            name = part[1:-1]
            if part.startswith("{") and name in digits:
                text += f"[0-9]{{{digits[name]}}}" if name in groups else f"([0-9]{{{digits[name]}}})"
                groups += [name] if name not in groups else []
            else:
                text += re.sub(r"([^A-Za-z0-9_])", r"\\\1", part)
        if sorted(groups) != sorted(digits):
            raise ValueError(f"{named!r} does not name a day, so a path does not tell its run date")
        # paths come URL-encoded; a plus in them stands for itself
        plain = F.url_decode(F.regexp_replace(path, r"\+", "%2B"))
        found = {name: F.regexp_extract(plain, text, i + 1) for i, name in enumerate(groups)}
        return F.concat_ws("-", found["year"], found["month"], found["day"]).try_cast("date")


def present_dates(spark: SparkSession, layout: DatedLayout, run_dates: list[str]) -> tuple[list[str], list[str]]:
    """The run dates that have a location, and those that have none, in the order given.

    The file system that Spark reads the locations with is asked once for each:
    as many questions as a backfill has dates.
    """
    conf = spark._jsparkSession.sessionState().newHadoopConf()
    held = {}
    for location in dict.fromkeys(layout.location(d) for d in run_dates):
        path = spark._jvm.org.apache.hadoop.fs.Path(location)
        held[location] = bool(path.getFileSystem(conf).globStatus(path))
    there = [d for d in run_dates if held[layout.location(d)]]
    return there, [d for d in run_dates if not held[layout.location(d)]]


def read_dated(
    reader: Callable[[list[str]], DataFrame],
    layout: DatedLayout,
    run_dates: str | list[str],
    path_column: str | None = None,
    date_column: str | None = None,
    missing: str = "fail",
) -> DataFrame:
    """Read the locations of one run date, or of many for a backfill, and list no others.

    A location that several dates share is read once. ``date_column`` adds the
    run date that a row's file is named by. A date without a location fails the
    read, or is left out where ``missing`` is ``skip``; if all are, it fails.
    """
    if missing not in ("fail", "skip"):
        raise ValueError(f"missing must be fail or skip, got {missing!r}")
    dates = [run_dates] if isinstance(run_dates, str) else run_dates
    if missing == "skip":
        wanted = dates
        dates, _ = present_dates(SparkSession.active(), layout, wanted)
        if not dates:
            raise ValueError(f"none of {len(wanted)} run dates has a location, {layout.location(wanted[0])!r} say")
    df = reader(list(dict.fromkeys(layout.location(d) for d in dates)))
    file = F.col("_metadata.file_path")
    named = {path_column: file, date_column: layout.date_of(file) if date_column else None}
    added = {name: column for name, column in named.items() if name}
    return df.withColumns(added) if added else df
