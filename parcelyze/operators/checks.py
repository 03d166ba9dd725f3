"""Declared data-quality checks, compiled to as few scans as their grouping keys need.

A check is declared, not coded: a row rule, a unique key, a reference, a domain, an
equal row count, a coverage or a recorded fact, on a table by name. ``CheckSet``
holds them and users add their own. ``compile`` plans all checks of a set together:

* every (table, grouping key) that a check needs is one grouping. A key that is
  part of a longer key already planned for the table is rolled up from it, and
  row rules, counts and coverages ride on the table's first grouping, so a table is
  scanned once for each key that no other one contains (once, if it needs none);
* groupings that references tie together (child key = parent key) are
  full-joined on that key, one row per key and table. A child key without a parent
  row (a NULL key too) counts with its rows, so a key that holds a third of a table
  is one row in the join;
* each joined family becomes one row of counts, expanded to result rows.

Result rows: (layer, check_id, check_name, category, passed 0/1, violations, detail,
run_ts). ``rows`` gives the violating rows behind a check. Nothing is collected.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field, replace
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.rules import fmt_fixed
from ..session import merged

RESULT_COLS = ["layer", "check_id", "check_name", "category", "passed", "violations", "detail", "run_ts"]


@dataclass(frozen=True)
class Check:
    """``detail`` is a text with placeholders: {n} (violations), {run_ts}, and what a kind adds."""
    name: str
    category: str
    detail: str = "{n} violations"
    check_id: int | None = field(default=None, kw_only=True)

    #: passes whatever it counts
    informative = False

    def table_names(self) -> list:
        return []


@dataclass(frozen=True)
class RowRule(Check):
    """Rows of ``table`` where ``broken`` (a function that gives a boolean Column) holds."""
    table: str = field(default="", kw_only=True)
    broken: Callable[[], Column] | None = field(default=None, kw_only=True)


@dataclass(frozen=True)
class UniqueKey(Check):
    """Values of ``keys`` that ``table`` holds more than once."""
    table: str = field(default="", kw_only=True)
    keys: tuple = field(default=(), kw_only=True)


@dataclass(frozen=True)
class Reference(Check):
    """Rows of ``table`` whose ``key`` is no ``parent_key`` of ``parent``; NULL is none."""
    table: str = field(default="", kw_only=True)
    key: str = field(default="", kw_only=True)
    parent: str = field(default="", kw_only=True)
    parent_key: str = field(default="", kw_only=True)


@dataclass(frozen=True)
class Domain(Check):
    """Distinct values of ``column`` outside ``allowed``; NULL is outside. ``clear`` is
    the detail when there is none."""
    table: str = field(default="", kw_only=True)
    column: str = field(default="", kw_only=True)
    allowed: tuple = field(default=(), kw_only=True)
    clear: str | None = field(default=None, kw_only=True)


@dataclass(frozen=True)
class SameCount(Check):
    """``table`` has as many rows as ``other``. Adds {count} and {other_count}."""
    table: str = field(default="", kw_only=True)
    other: str = field(default="", kw_only=True)


@dataclass(frozen=True)
class Coverage(Check):
    """How many rows of ``table`` have a value in ``column``; always passes. Adds {pct},
    {valid} and {total}."""
    table: str = field(default="", kw_only=True)
    column: str = field(default="", kw_only=True)
    informative = True


@dataclass(frozen=True)
class Recorded(Check):
    """A fact of the run; always passes and reads nothing."""
    informative = True


@dataclass(frozen=True)
class Custom(Check):
    """``count(tables)`` gives a DataFrame of one row with the violations in column
    ``v``; it is a plan of its own."""
    count: Callable | None = field(default=None, kw_only=True)


class CheckSet:
    """The checks of a layer, numbered in order."""

    def __init__(self, layer: str, checks=()):
        self.layer, self.checks = layer, []
        for c in checks:
            self.add(c)

    def add(self, check: Check) -> Check:
        """Register a check; without a number it gets the next one."""
        if check.check_id is None:
            check = replace(check, check_id=max([c.check_id for c in self.checks], default=0) + 1)
        if any(c.check_id == check.check_id for c in self.checks):
            raise ValueError(f"check {self.layer}/{check.check_id} exists")
        if isinstance(check, UniqueKey) and not check.keys:
            raise ValueError(f"{check.name}: a unique key needs columns")
        self.checks.append(check)
        return check

    def check(self, name: str, category: str, detail: str = "{n} violations"):
        """Decorator: register a function of the tables that gives one row with column v."""
        def register(fn):
            self.add(Custom(name, category, detail, count=fn))
            return fn
        return register

    def copy(self) -> CheckSet:
        return CheckSet(self.layer, self.checks)

    def __getitem__(self, check_id: int) -> Check:
        for c in self.checks:
            if c.check_id == check_id:
                return c
        raise KeyError(check_id)

    def compile(self, tables, run_ts: str) -> DataFrame:
        """``tables``: a mapping or a function from table name to DataFrame."""
        return _Plan(self, tables, run_ts).result()

    def scans(self) -> list:
        """(table, keys) of every scan that ``compile`` plans, in order."""
        return [(s.table, s.keys) for s in _Plan(self, None, "").scans]

    def rows(self, check_id: int, tables) -> DataFrame:
        """The violating rows behind a check; keys or values for uniqueness and domains."""
        get = _getter(tables)
        c = self[check_id]
        if isinstance(c, RowRule):
            return get(c.table).filter(c.broken())
        if isinstance(c, UniqueKey):
            return get(c.table).groupBy(*c.keys).count().filter("count > 1")
        if isinstance(c, Reference):
            return orphan_rows(get(c.table), c.key, get(c.parent), c.parent_key)
        if isinstance(c, Domain):
            return unexpected_values(get(c.table), c.column, c.allowed)
        raise ValueError(f"check {self.layer}/{check_id} has no row-level drill-down")


# ------------------------------------------------------------- single checks
def duplicate_key_count(df: DataFrame, keys) -> DataFrame:
    """AGG20: number of key values occurring more than once (one row, col v)."""
    return (df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_c"))
            .agg(F.count_if(F.col("_c") > 1).alias("v")))


def orphan_count(child: DataFrame, child_key: str, parent: DataFrame, parent_key: str) -> DataFrame:
    """JN6: child rows whose key has no parent row (one row, col v)."""
    per_key = child.groupBy(F.col(child_key).alias("_k")).agg(F.count(F.lit(1)).alias("_c"))
    parents = parent.select(F.col(parent_key).alias("_k"))
    return (per_key.join(merged(parents), "_k", "left_anti")
            .agg(F.coalesce(F.sum("_c"), F.lit(0)).cast("bigint").alias("v")))


def orphan_rows(child: DataFrame, child_key: str, parent: DataFrame, parent_key: str) -> DataFrame:
    """The violating child rows themselves (for drill-down). Rows without a key are
    orphans by a filter and meet no join, however many there are. The other orphan
    keys are found on one row per key, and only they meet the child rows."""
    parents = parent.select(F.col(parent_key).alias("_pk"))
    keyed = child.filter(F.col(child_key).isNotNull())
    keys = keyed.groupBy(F.col(child_key).alias("_pk")).agg(F.count(F.lit(1)).alias("_n")) \
        .join(merged(parents), "_pk", "left_anti").select("_pk")
    found = keyed.join(merged(keys), keyed[child_key] == keys["_pk"], "left_semi")
    return child.filter(F.col(child_key).isNull()).unionByName(found)


def unexpected_values(df: DataFrame, col: str, allowed) -> DataFrame:
    """AGG21: distinct values outside the allowed set (NULL is unexpected), with counts."""
    c = F.col(col)
    return (df.groupBy(c.alias(col)).agg(F.count(F.lit(1)).alias("row_count"))
            .filter(c.isNull() | ~c.isin(list(allowed))))


# ------------------------------------------------------------------ compiler
def _getter(tables):
    return tables if callable(tables) else tables.__getitem__


def _fmt(template: str, **cols) -> Column:
    """Fill {name} placeholders of a text with column values."""
    parts, rest = [], template
    while "{" in rest:
        pre, _, tail = rest.partition("{")
        key, _, rest = tail.partition("}")
        parts += [F.lit(pre), cols[key].cast("string")]
    parts.append(F.lit(rest))
    return F.concat(*parts)


@dataclass
class _Group:
    """A grouping of a table: scanned, or rolled up from the scan of a longer key."""
    table: str
    keys: tuple
    source: _Group | None = None
    riders: list = field(default_factory=list)              # checks that count on this scan
    unique: list = field(default_factory=list)              # uniqueness of exactly these keys


class _Plan:
    def __init__(self, checks: CheckSet, tables, run_ts: str):
        self.set, self.get, self.run_ts = checks, _getter(tables) if tables is not None else None, run_ts
        self.groups, self.references = [], []
        needs: dict = {}
        for c in checks.checks:
            for table, keys in self._needs(c):
                wanted = needs.setdefault(table, [])
                if keys not in wanted:
                    wanted.append(keys)
        for table, wanted in needs.items():
            for keys in sorted((k for k in wanted if k), key=len, reverse=True):
                longer = next((g for g in self.groups if g.table == table and g.source is None
                               and set(keys) < set(g.keys) and not self._rolled(g)), None)
                self.groups.append(_Group(table, keys, longer))
            if not any(g.table == table for g in self.groups):
                self.groups.append(_Group(table, ()))
        for c in checks.checks:
            if isinstance(c, UniqueKey):
                self._group(c.table, c.keys).unique.append(c)
            elif isinstance(c, Reference):
                self.references.append((c, self._group(c.table, (c.key,)), self._group(c.parent, (c.parent_key,))))
            elif isinstance(c, (RowRule, SameCount, Coverage)):
                next(g for g in self.groups if g.table == c.table and g.source is None).riders.append(c)

    def _rolled(self, scan: _Group) -> bool:
        """Has a shorter key been rolled up from this scan? One family reads a scan."""
        return any(g.source is scan for g in self.groups)

    @staticmethod
    def _needs(c: Check) -> list:
        if isinstance(c, UniqueKey):
            return [(c.table, c.keys)]
        if isinstance(c, Reference):
            return [(c.table, (c.key,)), (c.parent, (c.parent_key,))]
        if isinstance(c, Domain):
            return [(c.table, (c.column,))]
        return [(c.table, ())] if isinstance(c, (RowRule, SameCount, Coverage)) else []

    def _group(self, table: str, keys: tuple) -> _Group:
        return next(g for g in self.groups if g.table == table and g.keys == keys)

    @property
    def scans(self) -> list:
        return [g for g in self.groups if g.source is None]

    # a grouping as a DataFrame: its key as _k, rows per key as <i>_c, measures as <i>_m<check>
    def _frame(self, g: _Group) -> DataFrame:
        i = self.groups.index(g)
        if g.source is None:
            df = self.get(g.table)
            measures = [F.count(F.lit(1)).alias(f"{i}_c")]
            for c in g.riders:
                if isinstance(c, RowRule):
                    measures.append(F.count_if(c.broken()).alias(f"m{c.check_id}"))
                elif isinstance(c, Coverage):
                    measures.append(F.count(F.col(c.column)).alias(f"m{c.check_id}"))
            out = df.groupBy(*g.keys).agg(*measures) if g.keys else df.agg(*measures)
            for c in g.unique:
                out = out.withColumn(f"m{c.check_id}", (F.col(f"{i}_c") > 1).cast("bigint"))
            return out
        below = self._frame(g.source)
        j = self.groups.index(g.source)
        out = below.groupBy(*g.keys).agg(F.sum(f"{j}_c").alias(f"{i}_c"), *[
            F.sum(m).alias(m) for m in below.columns if m.startswith("m")])
        for c in g.unique:
            out = out.withColumn(f"m{c.check_id}", (F.col(f"{i}_c") > 1).cast("bigint"))
        return out

    def _families(self) -> list:
        """Groupings that references join, each with the scans that feed them."""
        top = [g for g in self.groups if not self._rolled(g) or g.source is not None]
        family = {id(g): [g] for g in top}
        for _, child, parent in self.references:
            a, b = family[id(self._top(child))], family[id(self._top(parent))]
            if a is not b:
                a.extend(b)
                for g in b:
                    family[id(g)] = a
        seen, out = set(), []
        for g in top:
            f = family[id(g)]
            if id(f) not in seen:
                seen.add(id(f))
                out.append(f)
        return out

    def _top(self, g: _Group) -> _Group:
        return next((h for h in self.groups if h.source is g), g)

    def _joined(self, family: list) -> DataFrame:
        # start with a parent: a family is a tree of references, joined edge by edge
        frames = {}
        for g in family:
            f = self._frame(g)
            keyed = f.withColumn("_k", F.col(g.keys[0])).drop(*g.keys) if len(g.keys) == 1 else f.drop(*g.keys)
            frames[id(g)] = keyed
        out = frames[id(family[0])]
        for g in family[1:]:
            right = frames[id(g)].withColumnRenamed("_k", "_k2")
            out = out.join(merged(right), F.col("_k") == F.col("_k2"), "full_outer").withColumn(
                "_k", F.coalesce("_k", "_k2")).drop("_k2")
        return out

    def _family_rows(self, family: list, first: bool) -> DataFrame | None:
        scans = {id(g.source or g) for g in family}
        inside = [g for g in self.groups if id(g) in {id(x) for x in family} or id(g) in scans]
        aggs, rows = [], []

        def total(c: Column, name: str):
            aggs.append(F.coalesce(F.sum(c), F.lit(0)).cast("bigint").alias(name))
        for g in inside:
            for c in [*g.riders, *g.unique]:
                name = f"c{c.check_id}"
                if isinstance(c, SameCount):
                    total(F.col(f"{self.groups.index(self._top(g))}_c"), name)
                elif isinstance(c, Coverage):
                    total(F.col(f"m{c.check_id}"), f"{name}_valid")
                    total(F.col(f"{self.groups.index(self._top(g))}_c"), name)
                else:
                    total(F.col(f"m{c.check_id}"), name)
                rows.append(c)
        for c, child, parent in self.references:
            if child in family:
                i, j = self.groups.index(child), self.groups.index(parent)
                total(F.when(F.col(f"{j}_c").isNull(), F.col(f"{i}_c")), f"c{c.check_id}")
                rows.append(c)
        for c in self.set.checks:
            if isinstance(c, Domain) and self._group(c.table, (c.column,)) in family:
                outside = F.col("_k").isNull() | ~F.col("_k").isin(list(c.allowed))
                i = self.groups.index(self._group(c.table, (c.column,)))
                aggs.append(F.count_if(outside & F.col(f"{i}_c").isNotNull()).alias(f"c{c.check_id}"))
                rows.append(c)
        if first:
            rows += [c for c in self.set.checks if isinstance(c, Recorded)]
        if not rows:
            return None
        one = self._joined(family).agg(*(aggs or [F.lit(0).alias("_none")]))
        for c in rows:
            if isinstance(c, SameCount):
                one = one.withColumn(f"c{c.check_id}_other", self.get(c.other).agg(F.count(F.lit(1))).scalar())
        return one.select(F.inline(F.array(*[F.struct(*self._row(c)) for c in rows])))

    def _row(self, c: Check) -> list:
        v, more, passed = F.col(f"c{c.check_id}") if not isinstance(c, Recorded) else F.lit(0), {}, None
        if isinstance(c, SameCount):
            other = F.col(f"c{c.check_id}_other")
            more = {"count": F.format_number(v, 0), "other_count": F.format_number(other, 0)}
            v = F.abs(other - v)
        elif isinstance(c, Coverage):
            valid = F.col(f"c{c.check_id}_valid")
            more = {"pct": fmt_fixed(F.try_divide(F.lit(100.0) * valid, v), 1), "valid": F.format_number(valid, 0),
                    "total": F.format_number(v, 0)}
            v = v - valid
        detail = _fmt(c.detail, n=v, run_ts=F.lit(self.run_ts), **more)
        if isinstance(c, Domain) and c.clear is not None:
            detail = F.when(v == 0, F.lit(c.clear)).otherwise(detail)
        passed = F.lit(True) if c.informative else v == 0
        return [F.lit(self.set.layer).alias("layer"), F.lit(c.check_id).alias("check_id"), F.lit(c.name).alias("check_name"),
                F.lit(c.category).alias("category"), passed.cast("int").alias("passed"),
                v.cast("bigint").alias("violations"), detail.alias("detail")]

    def result(self) -> DataFrame:
        parts = []
        for family in self._families():
            rows = self._family_rows(family, first=not parts)
            if rows is not None:
                parts.append(rows)
        for c in self.set.checks:
            if isinstance(c, Custom):
                one = c.count(self.get).select(F.col("v").cast("bigint").alias(f"c{c.check_id}"))
                parts.append(one.select(F.inline(F.array(F.struct(*self._row(c))))))
        if not parts:
            raise ValueError(f"layer {self.set.layer}: no check reads a table")
        return reduce(DataFrame.unionByName, parts).withColumn("run_ts", F.lit(self.run_ts)).select(*RESULT_COLS)
