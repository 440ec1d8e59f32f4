"""Declared constraints as validation jobs. Spark does not enforce them; each
rule returns the rows, or the count of rows, that break it."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskloom.sources.schemas import TableSpec


def key_violations(df: DataFrame, key: Sequence[str]) -> DataFrame:
    """Keys that occur more than once, with their number of rows."""
    return df.groupBy(*key).agg(F.count(F.lit(1)).alias("rows")).filter(F.col("rows") > 1)


def orphan_keys(child: DataFrame, column: str, parent: DataFrame, parent_column: str) -> DataFrame:
    """Child keys without a parent, with their number of rows; NULL keys are
    allowed. Rows are first counted per key, so the join sees each key once."""
    keys = child.filter(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias("rows"))
    known = parent.select(F.col(parent_column).alias(column))
    return keys.join(known, column, "left_anti")


def _columns(conditions: Mapping[str, Column]) -> list[Column]:
    return [F.count_if(cond).alias(name) for name, cond in conditions.items()]


def _long(counts: DataFrame, names: Sequence[str], table: str, kind: str) -> DataFrame:
    rows = F.array(*[F.struct(F.lit(n).alias("rule"), F.col(f"`{n}`").alias("violations")) for n in names])
    return counts.select(F.explode(rows).alias("r")).select(
        F.lit(table).alias("table_name"), F.lit(kind).alias("kind"), "r.rule", "r.violations"
    )


def row_rules(spec: TableSpec) -> dict[str, dict[str, Column]]:
    """Per kind, the condition under which a row breaks each declared rule."""
    lengths = {c: F.length(c) > n for c, n in spec.lengths.items()}
    numbers = {
        f"{c}_precision": F.col(c).isNotNull()
        & F.col(c).cast("string").try_cast(f"decimal({t.precision},{t.scale})").isNull()
        for c, t in spec.decimals.items()
    }
    return {
        "not_null": {c: F.col(c).isNull() for c in spec.required},
        # A check passes on NULL: only a false condition breaks it.
        "check": {name: F.expr(sql) == F.lit(False) for name, sql in spec.checks.items()},
        "limit": {**lengths, **numbers},
    }


def _stack(parts: Sequence[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)


def row_violations(tables: Mapping[str, DataFrame], specs: Mapping[str, TableSpec], kinds: Sequence[str]) -> DataFrame:
    """(table_name, kind, rule, violations) for the row-level rules; one pass per table."""
    parts = []
    for name, spec in specs.items():
        rules = {f"{kind}:{r}": (kind, r, cond) for kind in kinds for r, cond in row_rules(spec)[kind].items()}
        if not rules:
            continue
        counts = tables[name].agg(*_columns({full: cond for full, (_, _, cond) in rules.items()}))
        rows = _long(counts, list(rules), name, "")
        parts.append(
            rows.withColumns({"kind": F.split_part("rule", F.lit(":"), F.lit(1))}).withColumn(
                "rule", F.split_part("rule", F.lit(":"), F.lit(2))
            )
        )
    return _stack(parts)


def table_violations(tables: Mapping[str, DataFrame], specs: Mapping[str, TableSpec]) -> DataFrame:
    """(table_name, kind, rule, violations) for primary and foreign keys:
    surplus or orphaned rows."""
    parts = []
    for name, spec in specs.items():
        twice = key_violations(tables[name], spec.key).agg(
            F.coalesce(F.sum(F.col("rows") - 1), F.lit(0)).cast("bigint").alias("violations")
        )
        parts.append(
            twice.select(
                F.lit(name).alias("table_name"),
                F.lit("primary_key").alias("kind"),
                F.lit(",".join(spec.key)).alias("rule"),
                "violations",
            )
        )
        for column, (parent, parent_column) in spec.foreign.items():
            if parent not in tables:
                continue
            lost = orphan_keys(tables[name], column, tables[parent], parent_column).agg(
                F.coalesce(F.sum("rows"), F.lit(0)).cast("bigint").alias("violations")
            )
            parts.append(
                lost.select(
                    F.lit(name).alias("table_name"),
                    F.lit("foreign_key").alias("kind"),
                    F.lit(f"{column}->{parent}").alias("rule"),
                    "violations",
                )
            )
    return _stack(parts)


def violations(tables: Mapping[str, DataFrame], specs: Mapping[str, TableSpec]) -> DataFrame:
    """Every declared rule with its number of violations. ``tables`` may hold
    parents that are not checked themselves."""
    return table_violations(tables, specs).unionByName(
        row_violations(tables, specs, ("not_null", "check", "limit"))
    )


class BrokenRules(ValueError):
    """Declared rules that published tables break."""


def enforce(tables: Mapping[str, DataFrame], specs: Mapping[str, TableSpec], report: str, stop: bool = True) -> None:
    """Check the declared rules of stored tables, append what was found to the
    table ``report``, and raise if ``stop`` and any rule is broken."""
    names = ", ".join(specs)
    found = violations(tables, specs).coalesce(1)
    found.write.mode("append").parquet(report)
    rules = found.sparkSession.read.parquet(report).filter(F.col("table_name").isin(*specs) & (F.col("violations") > 0))
    broken = rules.distinct().orderBy("table_name", "kind", "rule").collect()  # at most one row per declared rule and run
    if stop and broken:
        raise BrokenRules(f"{names}: " + "; ".join(f"{r.table_name} {r.kind} {r.rule}: {r.violations} rows" for r in broken))
