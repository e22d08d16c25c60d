"""Declarative data-quality rules, evaluated into a table of verdicts.

A rule is data: a metric of a table or column, a comparison and a bound. All simple metrics of a
table come from one aggregate pass, or from the job that writes the table (``Measured``), all its duplicate
counts from a second.
"""

from __future__ import annotations

import operator
from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from decimal import Decimal
from functools import reduce
from typing import Any

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from hourstar import schemas
from hourstar.session import literal_table

RESULTS = {
    "table": "STRING", "check": "STRING", "column": "STRING", "expected": "STRING", "actual": "STRING",
    "passed": "BOOLEAN",
}


COMPARISONS = {"=": operator.eq, ">=": operator.ge, "<=": operator.le}


@dataclass(frozen=True)
class Rule:
    """``metric`` of ``column`` compared with ``bound``; ``valid`` lists the values of an invalid count."""

    metric: str
    column: str | None = None
    compare: str = "="
    bound: Any = 0
    valid: tuple = ()

    @property
    def expected(self) -> str:
        return f"{self.compare} {self.bound}"


@dataclass(frozen=True)
class SchemaRule:
    """Columns that must be present, with their simple type names."""

    columns: tuple[tuple[str, str], ...]


def _simple_metric(rule: Rule) -> Column:
    column = F.col(rule.column) if rule.column else None
    match rule.metric:
        case "row_count":
            return F.count("*")
        case "missing_count":
            return F.count_if(column.isNull())
        case "min":
            return F.min(column)
        case "max":
            return F.max(column)
        case "min_length":
            return F.min(F.length(column))
        case "max_length":
            return F.max(F.length(column))
        case "invalid_count":
            # Nulls are missing, not invalid.
            return F.count_if(column.isNotNull() & ~column.isin(*rule.valid))
    raise ValueError(f"unknown metric {rule.metric!r}")


def counts_by_column(df: DataFrame, columns: Sequence[str]) -> tuple[DataFrame, dict[str, int]]:
    """``_set, _value, _n``: the rows per non-null value of each column, from one pass; and each column's ``_set``.

    Values are compared as text, so that columns of all types share the pass.
    """
    own = df.select(*[F.col(c).cast("string").alias(c) for c in columns])
    sets = own.groupingSets([[F.col(c)] for c in columns], *columns).agg(F.grouping_id().alias("_set"), F.count("*").alias("_n"))
    # In the grouping id a zero bit marks the column that a row is grouped by; the first column has the highest bit.
    every = (1 << len(columns)) - 1
    ids = {c: every ^ 1 << (len(columns) - 1 - i) for i, c in enumerate(columns)}
    return sets.select("_set", F.coalesce(*columns).alias("_value"), "_n").where("_value IS NOT NULL"), ids


def duplicate_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """One row with ``_d0, _d1, ..``: per column, how many non-null values occur more than once."""
    counts, ids = counts_by_column(df, columns)
    return counts.agg(*[
        F.count_if((F.col("_set") == ids[c]) & (F.col("_n") > 1)).alias(f"_d{i}") for i, c in enumerate(columns)
    ])


def _literal(value: Any) -> str:
    if value is None:
        return "cast(null as string)"
    if isinstance(value, (int, float, Decimal)):
        return str(value)
    text = str(value).replace("\\", "\\\\").replace("'", "\\'")
    return f"'{text}'"


def _check_comparison(rule: Rule) -> None:
    if rule.compare not in COMPARISONS:
        raise ValueError(f"unknown comparison {rule.compare!r}")


def _verdicts(metrics: DataFrame, table: str, rules: Mapping[str, Rule]) -> DataFrame:
    """Verdict rows from one row of metrics; ``rules`` maps its columns to rules."""
    def verdict(metric: str, rule: Rule) -> str:
        _check_comparison(rule)
        # A metric over no rows is null and fails.
        parts = {
            "table": _literal(table), "check": _literal(rule.metric), "column": _literal(rule.column),
            "expected": _literal(rule.expected), "actual": f"cast({metric} as string)",
            "passed": f"coalesce({metric} {rule.compare} {_literal(rule.bound)}, false)",
        }
        return "named_struct(" + ", ".join(f"'{name}', {value}" for name, value in parts.items()) + ")"

    return metrics.selectExpr(f"inline(array({', '.join(verdict(m, r) for m, r in rules.items())}))")


def _schema_rows(table: str, df: DataFrame, rule: SchemaRule) -> list[tuple]:
    found = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    wanted = dict(rule.columns)
    missing = [c for c in wanted if c not in found]
    wrong = [f"{c}: {found[c]}" for c in wanted if c in found and not _same_type(found[c], wanted[c])]
    return [
        (table, "required_columns", None, ", ".join(wanted), "missing: " + ", ".join(missing) if missing else "all",
         not missing),
        (table, "column_types", None, ", ".join(f"{c}: {t}" for c, t in wanted.items()),
         ", ".join(wrong) if wrong else "all", not wrong),
    ]


def _same_type(found: str, wanted: str) -> bool:
    """Equal names; a bare ``decimal`` accepts any precision and scale."""
    return found == wanted or (wanted == "decimal" and found.startswith("decimal("))


class Measured:
    """The simple metrics of one table, taken by the job that writes it, so that no scan is needed for them.

    ``observe`` must be the last step before the write, behind any exchange: the tasks of the writing stage count
    once each, however often they are tried, while those of an earlier stage that is run again after a lost
    executor would count twice. Ask for ``rows`` only after the write; before, they would be waited for.
    """

    def __init__(self, rules: Sequence[Rule | SchemaRule]):
        self.rules = [r for r in rules if isinstance(r, Rule) and r.metric != "duplicate_count"]
        self.observation: Observation | None = None
        self.taken: list[Rule] = []

    def observe(self, df: DataFrame) -> DataFrame:
        self.taken = [r for r in self.rules if r.column is None or r.column in df.columns]
        if not self.taken:
            return df
        metrics = []
        for i, rule in enumerate(self.taken):
            _check_comparison(rule)
            metric = _simple_metric(rule)
            passed = COMPARISONS[rule.compare](metric, F.expr(_literal(rule.bound)))
            metrics += [metric.cast("string").alias(f"actual_{i}"), F.coalesce(passed, F.lit(False)).alias(f"passed_{i}")]
        self.observation = Observation()
        return df.observe(self.observation, *metrics)

    def rows(self, table: str) -> dict[Rule, tuple]:
        """The verdict of each rule that was measured; none if Spark wrote the table without running the plan."""
        found = self.observation.get if self.observation else {}
        return {
            rule: (table, rule.metric, rule.column, rule.expected, found[f"actual_{i}"], found[f"passed_{i}"])
            for i, rule in enumerate(self.taken) if f"passed_{i}" in found
        }


def evaluate(table: str, df: DataFrame, rules: Sequence[Rule | SchemaRule], measured: Measured | None = None) -> DataFrame:
    """One verdict row per rule (two per schema rule). What was ``measured`` at the write is not computed again."""
    known = measured.rows(table) if measured else {}
    static = [row for r in rules if isinstance(r, SchemaRule) for row in _schema_rows(table, df, r)]
    present = [r for r in rules if isinstance(r, Rule) and (r.column is None or r.column in df.columns)]
    for r in rules:
        if isinstance(r, Rule) and r not in present:
            static.append((table, r.metric, r.column, r.expected, "no such column", False))
        elif r in known:
            static.append(known[r])
    parts = []
    if static:
        parts.append(literal_table(df.sparkSession, static, RESULTS))
    simple = [r for r in present if r.metric != "duplicate_count" and r not in known]
    if simple:
        named = {f"_m{i}": r for i, r in enumerate(simple)}
        parts.append(_verdicts(df.agg(*[_simple_metric(r).alias(n) for n, r in named.items()]), table, named))
    unique = [r for r in present if r.metric == "duplicate_count"]
    if unique:
        columns = list(dict.fromkeys(r.column for r in unique))
        counts = duplicate_counts(df, columns).select(*[F.col(f"_d{columns.index(r.column)}").alias(f"_m{i}") for i, r in enumerate(unique)])
        parts.append(_verdicts(counts, table, {f"_m{i}": r for i, r in enumerate(unique)}))
    return reduce(DataFrame.unionByName, parts)


def scan(tables: Mapping[str, DataFrame], rules: Mapping[str, Sequence[Rule | SchemaRule]],
         measured: Mapping[str, Measured] | None = None) -> DataFrame:
    """Verdicts for several tables."""
    return reduce(DataFrame.unionByName, [evaluate(t, tables[t], rs, (measured or {}).get(t)) for t, rs in rules.items()])


class QualityError(RuntimeError):
    """At least one rule failed."""


def gate(results: DataFrame) -> DataFrame:
    """Raise if any verdict failed. There is one row per rule, so collecting the failures is bounded."""
    failed = results.filter(~F.col("passed")).collect()
    if failed:
        lines = [f"{r.table}.{r.column or '*'} {r.check} {r.expected}, found {r.actual}" for r in failed]
        raise QualityError(f"{len(failed)} failed: " + "; ".join(lines))
    return results


def fk_orphans(child: DataFrame, fk: str, parent: DataFrame, pk: str) -> DataFrame:
    """Foreign-key values without a parent and how many rows carry each.

    Child rows are counted per key before the join, so a frequent key crosses it as one row.
    """
    keys = child.filter(F.col(fk).isNotNull()).groupBy(fk).agg(F.count("*").alias("n_rows"))
    return keys.join(parent.select(F.col(pk).alias(fk)), fk, "left_anti")


def _common_type(child: DataFrame, fk: str, parent: DataFrame, pk: str) -> str:
    """The type in which a key is compared: what Spark widens both to; text if just one of them is text."""
    types = [df.schema[c].dataType.simpleString() for df, c in ((child, fk), (parent, pk))]
    if types.count("string") == 1:
        return "string"
    nulls = [F.lit(None).cast(t) for t in types]
    return child.sparkSession.range(0).select(F.coalesce(*nulls).alias("v")).schema["v"].dataType.simpleString()


def foreign_key_verdicts(table: str, child: DataFrame, keys: Mapping[str, tuple[DataFrame, str]]) -> DataFrame:
    """Orphan counts of all foreign keys (``fk -> (parent, pk)``) from one pass over the child.

    Its rows are counted per value of each key before the join. Values are compared as values, in a column of its own
    per key and in a type common to both sides: an integer equals a double or a decimal of any scale.
    """
    names = list(keys)
    types = {c: _common_type(child, c, *keys[c]) for c in names}
    columns = [f"_v{i}" for i in range(len(names))]
    own = child.select(*[F.col(c).cast(types[c]).alias(v) for c, v in zip(names, columns)])
    sets = own.groupingSets([[F.col(v)] for v in columns], *columns).agg(F.count("*").alias("_n"))
    # A row belongs to the one key whose value it has; rows of null keys have none.
    values = sets.where(" OR ".join(f"{v} IS NOT NULL" for v in columns))
    parents = reduce(DataFrame.unionByName, [
        parent.select(*[(F.col(pk) if c == d else F.lit(None)).cast(types[d]).alias(v) for d, v in zip(names, columns)])
        .where(f"{columns[i]} IS NOT NULL")
        for i, (c, (parent, pk)) in enumerate(keys.items())
    ]).distinct()
    same = reduce(lambda a, b: a & b, [values[v].eqNullSafe(parents[v]) for v in columns])
    orphans = values.join(parents, same, "left_anti")
    counts = orphans.agg(*[
        F.coalesce(F.sum(F.when(F.col(v).isNotNull(), F.col("_n"))), F.lit(0)).alias(f"_o{i}") for i, v in enumerate(columns)
    ])
    return _verdicts(counts, table, {f"_o{i}": Rule("orphan_count", c) for i, c in enumerate(names)})


def foreign_key_verdict(table: str, child: DataFrame, fk: str, parent: DataFrame, pk: str) -> DataFrame:
    return foreign_key_verdicts(table, child, {fk: (parent, pk)})


def missing_keys(expected: DataFrame, found: DataFrame, key: str) -> DataFrame:
    """Expected keys that were not found, by equality."""
    return expected.select(key).distinct().join(found.select(key).distinct(), key, "left_anti")


def completeness(expected: DataFrame, found: DataFrame, key: str) -> DataFrame:
    """One row: how many keys were expected, how many of them were found and are missing."""
    seen = found.select(key).distinct().withColumn("_seen", F.lit(1))
    return (
        expected.select(key).distinct().join(seen, key, "left")
        .agg(F.count("*").alias("expected"), F.count("_seen").alias("found"))
        .withColumn("missing", F.col("expected") - F.col("found"))
    )


# The abbreviations of the date dimension.
DAYS_OF_WEEK = ("Mon", "Tue", "Wed", "Thu", "Fri", "Sat", "Sun")


def _columns(table: str) -> SchemaRule:
    return SchemaRule(tuple(
        (c, schemas.simple_type(t).split("(")[0].lower()) for c, t in schemas.STAR[table].items()
    ))


# The bounds of the rules.
def star_rules(n_entities: int, record_id_type: str = "int") -> dict[str, list[Rule | SchemaRule]]:
    """The rules of the star schema; ``n_entities`` is the number of provinces expected."""
    def not_null(*columns: str) -> list[Rule]:
        return [Rule("missing_count", c) for c in columns]

    def unique(*columns: str) -> list[Rule]:
        return [Rule("duplicate_count", c) for c in columns]

    def within(column: str, low: int | None = None, high: int | None = None, compare: tuple = (">=", "<=")) -> list[Rule]:
        rules = [Rule("min", column, compare[0], low)] if low is not None else []
        return rules + ([Rule("max", column, compare[1], high)] if high is not None else [])

    def length(column: str, n: int) -> list[Rule]:
        return [Rule("min_length", column, "=", n), Rule("max_length", column, "=", n)]

    exactly = ("=", "=")
    rules = {
        "dim_province": [
            Rule("row_count", None, "=", n_entities),
            *not_null("province_id", "province_name", "latitude", "longitude"),
            *unique(schemas.PRIMARY_KEYS["dim_province"], "province_name"),
            *within("province_id", 1, n_entities, exactly),
        ],
        "dim_date": [
            *not_null(*schemas.STAR["dim_date"]),
            *unique(schemas.PRIMARY_KEYS["dim_date"], "date"),
            *length("date_key", 8), *length("day_of_week", 3),
            *within("quarter", 1, 4), *within("month", 1, 12), *within("day", 1, 31),
            Rule("invalid_count", "day_of_week", valid=DAYS_OF_WEEK),
        ],
        "dim_time": [
            *not_null("time_key", "hour"),
            *unique(schemas.PRIMARY_KEYS["dim_time"], "hour"),
            *length("time_key", 2),
            *within("hour", 0, 23),
        ],
        "fact_air_quality": [
            *not_null(*schemas.STAR["fact_air_quality"]),
            *unique(schemas.PRIMARY_KEYS["fact_air_quality"]),
            *within("record_id", 1),
            *length("record_date", 8), *length("record_time", 2),
            *within("province_id", 1, n_entities, exactly),
            *within("aqi", 0, 500),
        ],
    }
    tables = {t: [_columns(t), *rs] for t, rs in rules.items()}
    if record_id_type != "int":
        wider = tuple((c, record_id_type if c == "record_id" else t) for c, t in tables["fact_air_quality"][0].columns)
        tables["fact_air_quality"][0] = SchemaRule(wider)
    return tables


def star_foreign_keys(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Verdicts on the three foreign keys of the fact."""
    keys = {fk: (tables[dim], pk) for fk, (dim, pk) in schemas.FOREIGN_KEYS.items()}
    return foreign_key_verdicts("fact_air_quality", tables["fact_air_quality"], keys)
