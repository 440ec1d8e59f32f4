"""Business measures and their filter context.

A measure is an aggregate that may fix the value of some columns ("fraud
transactions": ``is_fraud`` is true). Fixing a column *replaces* any filter the
report puts on that column; all other filters apply. An aggregate without rows
is blank (NULL), counts included, and rows whose measures are all blank do not
show.
"""

from __future__ import annotations

from collections.abc import Callable, Collection, Mapping, Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

REVIEW_COST = 5

Filter = object  # a value, a collection of values, or a function Column -> Column


@dataclass(frozen=True)
class Base:
    """Aggregate over the rows that satisfy ``where`` (column -> fixed value)."""

    kind: str  # count | sum | avg | selected
    column: str | None = None
    where: Mapping[str, object] = field(default_factory=dict)
    default: str | None = None

    def over(self, condition: Column) -> Column:
        if self.kind == "count":
            return F.nullif(F.count_if(condition), F.lit(0))
        kept = F.when(condition, F.col(self.column))
        if self.kind == "selected":
            return F.when(F.min(kept) == F.max(kept), F.min(kept)).otherwise(self.default)
        return F.sum(kept) if self.kind == "sum" else F.avg(kept.cast("double"))


@dataclass(frozen=True)
class Derived:
    needs: tuple[str, ...]
    formula: Callable[..., Column]


def divide(a: Column, b: Column) -> Column:
    """Blank when the divisor is blank or zero."""
    return a.cast("double") / F.nullif(b.cast("double"), F.lit(0.0))


def minus(a: Column, b: Column) -> Column:
    """Blank counts as zero unless both are blank."""
    zero = F.lit(0)
    return F.when(a.isNotNull() | b.isNotNull(), F.coalesce(a, zero) - F.coalesce(b, zero))


def _subtitle(version: Column, period: Column, n: Column) -> Column:
    shown = F.coalesce(F.format_number(n, 0), F.lit(""))
    return F.concat(F.lit("Model "), version, F.lit("  |  "), period, F.lit("  |  "), shown, F.lit(" transactions scored"))


def measures(review_cost: int = REVIEW_COST) -> dict[str, Base | Derived]:
    fraud, prevented = {"is_fraud": True}, {"outcome": "Fraud Prevented"}
    return {
        "total_transactions": Base("count"),
        "total_volume": Base("sum", "amount"),
        "fraud_transactions": Base("count", where=fraud),
        "fraud_exposure": Base("sum", "amount", fraud),
        "fraud_rate": Derived(("fraud_transactions", "total_transactions"), divide),
        "fraud_prevented": Base("sum", "amount", prevented),
        "fraud_missed": Base("sum", "amount", {"outcome": "Fraud Missed"}),
        "prevention_rate": Derived(("fraud_prevented", "fraud_exposure"), divide),
        "flagged_alerts": Base("count", where={"is_flagged": True}),
        "critical_alerts": Base("count", where={"risk_tier": "Critical"}),
        "frauds_caught": Base("count", where=prevented),
        "false_alarms": Base("count", where={"outcome": "False Alarm"}),
        "legit_transactions": Base("count", where={"is_fraud": False}),
        "alert_precision": Derived(("frauds_caught", "flagged_alerts"), divide),
        "fraud_catch_rate": Derived(("frauds_caught", "fraud_transactions"), divide),
        "false_positive_rate": Derived(("false_alarms", "legit_transactions"), divide),
        "avg_risk_score": Base("avg", "anomaly_risk_score"),
        "review_cost": Derived(("flagged_alerts",), lambda n: n * F.lit(review_cost)),
        "net_savings": Derived(("fraud_prevented", "review_cost"), minus),
        "fraud_prevented_per_alert": Derived(("fraud_prevented", "flagged_alerts"), divide),
        "selected_version": Base("selected", "model_version", default="v1.0"),
        "selected_period": Base("selected", "model_period", default="All periods"),
        "report_subtitle": Derived(("selected_version", "selected_period", "total_transactions"), _subtitle),
        # Implicit sums of columns, as charts use them.
        "sum_amount": Base("sum", "amount"),
        "sum_risk_score": Base("sum", "anomaly_risk_score"),
    }


MEASURES = measures()


def matches(column: Column, wanted: Filter) -> Column:
    if callable(wanted):
        return wanted(column)
    if isinstance(wanted, (list, tuple, set, frozenset)):
        return column.isin(*wanted)
    return column == F.lit(wanted)


def between(low, high) -> Callable[[Column], Column]:
    """Range slicer, both ends included."""
    return lambda c: c.between(low, high)


def all_of(conditions: Sequence[Column]) -> Column:
    return reduce(lambda a, b: a & b, conditions, F.lit(True))


@dataclass(frozen=True)
class StarModel:
    """Fact with many-to-one dimensions: name -> (table, fact column, key)."""

    fact: DataFrame
    dimensions: Mapping[str, tuple[DataFrame, str, str]] = field(default_factory=dict)

    def rows(self, columns: Sequence[str], filters: Mapping[str, Filter]) -> DataFrame:
        """Filtered fact rows with the dimension columns asked for. A filter on
        a dimension alone is a semi-join; fact rows without a dimension row stay
        under a blank member."""
        out = self.fact
        own = set(out.columns)
        known = own.union(*[table.columns for table, _, _ in self.dimensions.values()])
        if unknown := {*columns, *filters} - known:
            raise ValueError(f"no such columns: {sorted(unknown)}")
        out = out.filter(all_of([matches(F.col(c), w) for c, w in filters.items() if c in own]))
        for table, fact_column, key in self.dimensions.values():
            held = [c for c in table.columns if c not in own]
            shown = [c for c in held if c in columns]
            kept = [matches(F.col(c), w) for c, w in filters.items() if c in held]
            if not shown and not kept:
                continue
            link = "_key"
            side = table.filter(all_of(kept)).select(F.col(key).alias(link), *shown)
            # A filter drops blank members, so with one the join is inner.
            how = ("inner" if kept else "left") if shown else "left_semi"
            out = out.join(side, F.col(fact_column) == F.col(link), how).drop(link)
        return out

    def source(
        self, columns: Sequence[str], filters: Mapping[str, Filter], bases: Collection[Base] = ()
    ) -> tuple[DataFrame, Callable[[Base, Column], Column]]:
        """Filtered rows to aggregate for ``bases`` and how to aggregate one of them under a condition."""
        return self.rows(columns, filters), Base.over


def _closure(names: Sequence[str], registry: Mapping[str, Base | Derived]) -> list[str]:
    seen: list[str] = []
    for name in names:
        m = registry[name]
        for n in _closure(m.needs, registry) + [name] if isinstance(m, Derived) else [name]:
            if n not in seen:
                seen.append(n)
    return seen


def summarize(
    model: StarModel,
    axes: Sequence[str],
    names: Sequence[str],
    filters: Mapping[str, Filter] | None = None,
    registry: Mapping[str, Base | Derived] = MEASURES,
) -> DataFrame:
    """Measures per combination of axis values, one aggregation over the fact."""
    axes, filters = list(axes), dict(filters or {})
    needed = _closure(names, registry)
    bases = {n: registry[n] for n in needed if isinstance(registry[n], Base)}
    fixed = {c for b in bases.values() for c in b.where}
    contested = {c: w for c, w in filters.items() if c in fixed}
    plain = {c: w for c, w in filters.items() if c not in fixed}
    rows, over = model.source([*axes, *contested], plain, bases.values())

    def condition(b: Base) -> Column:
        own = [matches(F.col(c), v) for c, v in b.where.items()]
        outer = [matches(F.col(c), w) for c, w in contested.items() if c not in b.where]
        return F.coalesce(all_of(own + outer), F.lit(False))

    out = rows.groupBy(*axes).agg(*[over(b, condition(b)).alias(n) for n, b in bases.items()])
    for n, b in bases.items():
        if not set(axes) & set(b.where):
            continue
        if b.kind not in ("count", "sum"):
            raise ValueError(f"{n}: only counts and sums may fix a column that is also an axis")
        # The measure ignores this axis: every value shows the total over it.
        rest = [a for a in axes if a not in b.where]
        whole = F.sum(n).over(Window.partitionBy(*rest)) if rest else out.agg(F.sum(n)).scalar()
        out = out.withColumn(n, whole)
    out = out.filter(all_of([matches(F.col(a), contested[a]) for a in axes if a in contested]))
    for n in needed:
        m = registry[n]
        if isinstance(m, Derived):
            out = out.withColumn(n, m.formula(*[F.col(x) for x in m.needs]))
    if axes:
        out = out.filter(reduce(lambda a, b: a | b, [F.col(n).isNotNull() for n in names]))
    return out.select(*axes, *names)
