"""Validation: rules on rows in one pass, and rules on sets of rows.

A rule on a set (uniqueness, reference, aggregate) first works out which keys
or groups fail, by an aggregate with map-side combine, and marks their rows in
a join that Spark can split for a hot key. Its rows then go the way of others.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, replace
from functools import reduce

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F

from loadkit.functions.types import schema_from_config, spark_type

ERROR, WARNING = "ERROR", "WARNING"
ISSUES = "validation_issues"


@dataclass(frozen=True)
class Check:
    """One condition a row may fail."""

    rule: str
    column: str
    action: str
    failed: Column


@dataclass(frozen=True)
class SetRule:
    """A rule whose verdict on a row depends on others.

    ``failing`` gives the columns to match and the frame of keys, one row each,
    that a row is looked up by; a row fails if it is found there, or, where
    ``known`` is set, if it is not. Rows with a null key pass unless ``nulls``.
    """

    name: str
    column: str
    action: str
    failing: Callable[[DataFrame], tuple[list[str], DataFrame]]
    known: bool = False
    nulls: bool = False

    def mark(self, df: DataFrame, flag: str) -> tuple[DataFrame, Check]:
        """The frame with a column that is true where a row has been looked up, and the check on it."""
        columns, keys = self.failing(df)
        own = [f"{flag}_{i}" for i in range(len(columns))]
        keys = keys.select(*[F.col(f"`{c}`").alias(o) for c, o in zip(keys.columns, own, strict=True)], F.lit(True).alias(flag))
        # null-safe on purpose: the join then has keys of its own, and a shuffle of its own that can be split
        same = reduce(lambda a, b: a & b, [df[f"`{c}`"].eqNullSafe(keys[o]) for c, o in zip(columns, own, strict=True)])
        marked = df.join(keys, same, "left").select(*[df[f"`{c}`"] for c in df.columns], keys[flag])
        found = F.col(flag).isNotNull()
        complete = reduce(lambda a, b: a & b, [c.isNotNull() for c in _named(columns)])
        failed = ~found if self.known else found
        return marked, Check(self.name, self.column, self.action, failed if self.nulls else failed & complete)


Rule = Callable[[DataFrame], list[Check]] | SetRule


def _action(action: str) -> str:
    text = action.strip().upper()
    if text not in (ERROR, WARNING):
        raise ValueError(f"action must be ERROR or WARNING, got {action!r}")
    return text


def null_check(columns: list[str], action: str = WARNING) -> Rule:
    level = _action(action)

    def rule(df: DataFrame) -> list[Check]:
        missing = [c for c in columns if c not in df.columns]
        if missing:
            raise ValueError(f"null_check names unknown columns {missing}")
        return [Check("null_check", c, level, F.col(c).isNull()) for c in columns]

    return rule


def type_check(types: dict[str, str], action: str = ERROR) -> Rule:
    """A value that is not null but does not parse as the type fails."""
    level = _action(action)

    def rule(df: DataFrame) -> list[Check]:
        return [
            Check("type_check", c, level, F.col(c).isNotNull() & F.col(c).try_cast(spark_type(t)).isNull())
            for c, t in types.items()
        ]

    return rule


def expression_check(name: str, sql: str, action: str = ERROR) -> Rule:
    """A row fails where the SQL condition is false; null passes."""
    level = _action(action)
    return lambda df: [Check(name, sql, level, F.coalesce(~F.expr(sql), F.lit(False)))]


def _named(columns: list[str]) -> list[Column]:
    return [F.col(f"`{c}`") for c in columns]


def _whole_keys(df: DataFrame, columns: list[str]) -> DataFrame:
    """The key columns of rows that have all of them."""
    return df.select(*_named(columns)).where(reduce(lambda a, b: a & b, [c.isNotNull() for c in _named(columns)]))


def unique_check(columns: list[str], action: str = ERROR) -> SetRule:
    """Every row of a key that occurs more than once fails; a key with a null in it is no key."""

    def failing(df: DataFrame) -> tuple[list[str], DataFrame]:
        return columns, _whole_keys(df, columns).groupBy(*_named(columns)).agg(F.count("*").alias("_n")).where("_n > 1").drop("_n")

    return SetRule("unique_check", ", ".join(columns), _action(action), failing)


def reference_check(
    columns: list[str], reference: DataFrame | str, reference_columns: list[str] | None = None, action: str = ERROR
) -> SetRule:
    """A row fails if the reference, a frame or a table's name, lacks its key; a key with a null in it refers to nothing."""
    theirs = reference_columns or columns
    if len(theirs) != len(columns):
        raise ValueError(f"reference_check compares {columns} to {theirs}")

    def failing(df: DataFrame) -> tuple[list[str], DataFrame]:
        held = df.sparkSession.table(reference) if isinstance(reference, str) else reference
        return columns, _whole_keys(held, theirs).distinct()

    return SetRule("reference_check", ", ".join(columns), _action(action), failing, known=True)


def aggregate_check(name: str, sql: str, group_by: list[str] | None = None, action: str = ERROR) -> Rule:
    """All rows of a group fail where a condition on its aggregates is false, ``sum(amount) >= 0`` say; null passes.

    Rows with a null in ``group_by`` are grouped like others. Without it all rows are one group.
    """
    level = _action(action)
    if not group_by:
        return lambda df: [Check(name, sql, level, F.coalesce(~df.agg(F.expr(sql).alias("held")).scalar(), F.lit(False)))]

    def failing(df: DataFrame) -> tuple[list[str], DataFrame]:
        groups = df.groupBy(*_named(group_by)).agg(F.expr(sql).alias("_held"))
        return group_by, groups.where(~F.col("_held")).drop("_held")

    return SetRule(name, f"{sql} by {', '.join(group_by)}", level, failing, nulls=True)


def schema_differences(df: DataFrame, schema: dict[str, dict]) -> list[tuple[str, str | None, str | None]]:
    """``(column, expected type, actual type)`` where the frame departs from a configured schema.

    Columns go by their source names, as they are read. Columns the schema does
    not name are allowed: audit columns are among them.
    """
    actual = {f.name: f.dataType.simpleString() for f in df.schema}
    expected = {f.name: f.dataType.simpleString() for f in schema_from_config(schema)}
    return [(c, t, actual.get(c)) for c, t in expected.items() if actual.get(c) != t]


def schema_check(schema: dict[str, dict], action: str = ERROR) -> Rule:
    """Compare column names and types. No data is read; a difference fails every row."""
    level = _action(action)

    def rule(df: DataFrame) -> list[Check]:
        return [
            Check("schema_check", f"{c}: expected {expected}, found {found or 'nothing'}", level, F.lit(True))
            for c, expected, found in schema_differences(df, schema)
        ]

    return rule


def schema_findings(df: DataFrame, validations: list, schema: dict[str, dict] | None = None) -> list[Row]:
    """What the schema checks among the settings find: (rule, column, action, failed_rows), told from the schema alone.

    Counts are null: a difference holds for every row, and none is read.
    """
    found = []
    for item in validations:
        if isinstance(item, dict) and item["name"] == "schema_check":
            declared = item.get("schema") or schema
            if not declared:
                raise ValueError("schema_check needs a schema")
            level = _action(item.get("action_on_unexpected", WARNING))
            for c, expected, actual in schema_differences(df, declared):
                text = f"{c}: expected {expected}, found {actual or 'nothing'}"
                found.append(Row(rule="schema_check", column=text, action=level, failed_rows=None))
    return found


def rules_from_config(validations: list, schema: dict[str, dict] | None = None) -> list[Rule]:
    """Rules from ``{name, action_on_unexpected, …}`` settings; a callable is a rule already."""
    rules: list[Rule] = []
    for item in validations:
        if callable(item) or isinstance(item, SetRule):
            rules.append(item)
            continue
        name, action = item["name"], item.get("action_on_unexpected", WARNING)
        if name == "schema_check":
            declared = item.get("schema") or schema
            if not declared:
                raise ValueError("schema_check needs a schema")
            rules.append(schema_check(declared, action))
        elif name == "null_check":
            rules.append(null_check(item["columns"], action))
        elif name == "type_check":
            rules.append(type_check(item["columns"], action))
        elif name == "unique_check":
            rules.append(unique_check(item["columns"], action))
        elif name == "reference_check":
            rules.append(reference_check(item["columns"], item["reference_table"], item.get("reference_columns"), action))
        elif "aggregate" in item:
            rules.append(aggregate_check(name, item["aggregate"], item.get("group_by"), action))
        elif "expression" in item:
            rules.append(expression_check(name, item["expression"], action))
        else:
            raise ValueError(f"unknown validation {name!r}")
    return rules


@dataclass(frozen=True)
class ValidationResult:
    """Frames of a validation; nothing has run yet.

    ``checked`` is the input with ``validation_issues``, an array of (rule,
    column, action) that is null for a clean row; ``issue_rows`` are the others.
    ``checks`` are the conditions tested; without any, no row can fail.
    """

    checked: DataFrame
    issue_rows: DataFrame
    checks: tuple[Check, ...] = ()

    @property
    def can_fail(self) -> bool:
        return bool(self.checks)

    @property
    def can_block(self) -> bool:
        """Whether a row can keep the others from the target."""
        return any(c.action == ERROR for c in self.checks)

    @property
    def summary(self) -> DataFrame:
        return summarize(self.issue_rows)


def _has_issue(check: Check) -> Column:
    same = lambda i: (i["rule"] == check.rule) & (i["column"] == check.column) & (i["action"] == check.action)
    return F.coalesce(F.exists(ISSUES, same), F.lit(False))


def run_validations(df: DataFrame, rules: list[Rule]) -> ValidationResult:
    """Test every rule on every row in one projection.

    Rules on sets read the frame once more each, and join it to what they find.
    """
    if ISSUES in df.columns:
        raise ValueError(f"the frame already has a column {ISSUES!r}")
    plain, checks, marks = df, [], []
    for rule in rules:
        if isinstance(rule, SetRule):
            marks.append(f"_validation_mark_{len(marks)}")
            df, check = rule.mark(df, marks[-1])
            checks.append(check)
        else:
            checks += rule(plain)
    kind = "array<struct<rule:string,column:string,action:string>>"
    if not checks:
        checked = df.withColumn(ISSUES, F.lit(None).cast(kind))
        return ValidationResult(checked, checked.where(F.lit(False)))
    found = [
        F.when(
            c.failed,
            F.struct(F.lit(c.rule).alias("rule"), F.lit(c.column).alias("column"), F.lit(c.action).alias("action")),
        )
        for c in checks
    ]
    any_failed = reduce(lambda a, b: a | b, [c.failed for c in checks])
    checked = df.withColumn(ISSUES, F.when(any_failed, F.array_compact(F.array(*found)))).drop(*marks)
    if marks:  # later steps see the issues, not the marks
        checks = [replace(c, failed=_has_issue(c)) for c in checks]
    return ValidationResult(checked, checked.where(F.col(ISSUES).isNotNull()), tuple(checks))


def summarize(issue_rows: DataFrame) -> DataFrame:
    """Failed rows per rule and column."""
    return (
        issue_rows.select(F.explode(ISSUES).alias("i"))
        .groupBy(F.col("i.rule"), F.col("i.column"), F.col("i.action"))
        .agg(F.count("*").alias("failed_rows"))
    )


def has_error(summary: list[Row]) -> bool:
    """Whether a rule with action ERROR failed; ``summary`` has one row per failed rule and column."""
    return any(row["action"] == ERROR for row in summary)
