"""A small metric compiler over a :class:`~confluo.plans.star.Star`.

Metrics are declared once (a governed registry) and evaluated per group:

* ``Sum`` / ``Count``: additive, optionally filtered (``where``).  A metric's
  own filter on a column *replaces* an outer filter on that same column.
* ``SemiAdditive``: sum per (group, ``over``) then mean over the ``over``
  values that have data (e.g. average daily on-hand).
* ``Formula``: arithmetic over other metrics (ratios use ``try_divide``, so
  zero or missing denominators give null, never an error).
* ``PeerAverage``: mean of a per-member metric over the member's peer group,
  ignoring outer filters on the member dimension (a category benchmark).

Physical shape, chosen for scale:
* each fact is read once with its common filters pushed to the scan;
* bounded dimensions (calendar, locations, channels) are broadcast-joined to
  fact rows; the product dimension, which grows with the catalogue, is
  joined only after the fact is pre-aggregated to SKU grain (eager
  aggregation: the big side shrinks before any shuffle join);
* several facts in one query (drill-across) are combined by ``unionByName``
  and ONE ``groupBy`` on the group key, never by joining facts to facts; the
  map-side partial aggregate means only per-group partials are shuffled;
* peer averages aggregate members per peer with ``groupBy`` (partial
  aggregation, skew-safe for hot peer groups) and join the small result back,
  instead of a window partitioned by the peer key.
"""

from __future__ import annotations

import calendar
import datetime as dt
from collections.abc import Callable, Iterable, Mapping, Sequence
from dataclasses import dataclass, field
from functools import reduce
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from confluo.plans.star import Star


# ----------------------------------------------------------------- filters
# suffix of the column that tells whether a row is below its peer average
BELOW = "__below"


@dataclass(frozen=True)
class Between:
    """Inclusive range."""
    lo: Any
    hi: Any


@dataclass(frozen=True)
class HalfOpen:
    """lo <= x < hi."""
    lo: Any
    hi: Any


@dataclass(frozen=True)
class NotIn:
    values: tuple


@dataclass(frozen=True)
class AtLeast:
    lo: Any


def _months(ref, spec):
    """The months (yyyymm) that a filter on a day, or on a calendar column, can meet; None if it says nothing."""
    name = ref.column if ref.kind == "fact" else f"{ref.dim}.{ref.column}"
    if name in ("month_key", "dim_date.month_key"):
        return spec if name.startswith("dim_date") else None
    if name in ("date_key", "dim_date.date_key"):
        month = lambda x: int(x) // 100
    elif name == "dim_date.date":
        month = lambda x: x.year * 100 + x.month
    elif name == "dim_date.year" and isinstance(spec, int):
        return Between(spec * 100 + 1, spec * 100 + 12)
    else:
        return None
    if isinstance(spec, (Between, HalfOpen)):
        return Between(month(spec.lo), month(spec.hi))
    if isinstance(spec, AtLeast):
        return AtLeast(month(spec.lo))
    return None if spec is None or isinstance(spec, (NotIn, list, tuple, set, frozenset)) else month(spec)


def _key(day: dt.date) -> int:
    return day.year * 10000 + day.month * 100 + day.day


def _day(key: int) -> dt.date:
    return dt.date(key // 10000, key // 100 % 100, key % 100)


def _ends(spec) -> tuple[Any, Any, bool] | None:
    """(least, greatest, whether the greatest is left out) of a filter's values, None for an open side; None if it sets no range."""
    if isinstance(spec, Between):
        return spec.lo, spec.hi, False
    if isinstance(spec, HalfOpen):
        return spec.lo, spec.hi, True
    if isinstance(spec, AtLeast):
        return spec.lo, None, False
    if isinstance(spec, (list, tuple, set, frozenset)) and spec:
        return min(spec), max(spec), False
    return None if spec is None or isinstance(spec, (NotIn, list, tuple, set, frozenset)) else (spec, spec, False)


def days(ref, spec) -> tuple[int | None, int | None]:
    """The first and last day (yyyymmdd) that a filter on a day, or on a calendar column, can meet; None where it is open."""
    name = "date_key" if ref.column == "date_key" else ref.column if ref.kind == "dim" and ref.dim == "dim_date" else None
    first, last = {
        "date_key": (_day, _day), "date": (lambda x: x, lambda x: x),
        "month_key": (lambda m: dt.date(m // 100, m % 100, 1), lambda m: dt.date(m // 100, m % 100, calendar.monthrange(m // 100, m % 100)[1])),
        "year": (lambda y: dt.date(y, 1, 1), lambda y: dt.date(y, 12, 31)),
    }.get(name, (None, None))
    ends = _ends(spec) if first else None
    if ends is None:
        return None, None
    lo, hi, open_ = ends
    end = None if hi is None else _key(first(hi) - dt.timedelta(days=1) if open_ else last(hi))
    return None if lo is None else _key(first(lo)), end


def within(periods: Iterable[tuple[int | None, int | None]]) -> tuple[int | None, int | None]:
    """The days that all periods share."""
    periods = list(periods)
    return max((lo for lo, _ in periods if lo is not None), default=None), min((hi for _, hi in periods if hi is not None), default=None)


def predicate(c: Column, spec) -> Column:
    if isinstance(spec, Between):
        return c.between(spec.lo, spec.hi)
    if isinstance(spec, HalfOpen):
        return (c >= spec.lo) & (c < spec.hi)
    if isinstance(spec, AtLeast):
        return c >= spec.lo
    if isinstance(spec, NotIn):
        return ~c.isin(list(spec.values))      # SQL semantics: null is not kept
    if isinstance(spec, (list, tuple, set, frozenset)):
        return c.isin(list(spec))
    if spec is None:
        return c.isNull()
    return c == F.lit(spec)


def _items(where) -> tuple:
    if where is None:
        return ()
    if isinstance(where, Mapping):
        return tuple(where.items())
    return tuple(where)


# ----------------------------------------------------------------- metrics
@dataclass(frozen=True)
class Sum:
    name: str
    fact: str
    column: str
    where: tuple = ()

    def __post_init__(self):
        object.__setattr__(self, "where", _items(self.where))


@dataclass(frozen=True)
class Count:
    name: str
    fact: str
    where: tuple = ()

    def __post_init__(self):
        object.__setattr__(self, "where", _items(self.where))


@dataclass(frozen=True)
class SemiAdditive:
    name: str
    fact: str
    column: str
    over: str = "date_key"
    where: tuple = ()

    def __post_init__(self):
        object.__setattr__(self, "where", _items(self.where))


@dataclass(frozen=True)
class Formula:
    """``references``: the measures whose rows name a product that may not be found; the answer then says how many didn't.
    ``plausible``: the range [lo, hi) of a sound value; the answer flags others."""
    name: str
    deps: tuple
    fn: Callable[..., Column]
    references: tuple = ()
    plausible: tuple[float, float] | None = None


@dataclass(frozen=True)
class PeerAverage:
    name: str
    base: str
    member: str = "dim_product.sku"
    peer: str = "dim_product.category"
    dim: str = "dim_product"
    exclude: tuple = ()


BASE = (Sum, Count, SemiAdditive)


def safe_ratio(num: Column, den: Column, scale: float | int = 1) -> Column:
    r = F.try_divide(num.cast("double"), den.cast("double"))
    return r if scale == 1 else r * F.lit(float(scale))


def ratio(name: str, num: str, den: str, scale: float | int = 1, references: tuple = (),
          plausible: tuple[float, float] | None = None) -> Formula:
    return Formula(name, (num, den), lambda a, b: safe_ratio(a, b, scale), references, plausible)


# suffix of the column that tells whether a ratio lies where it should
CHECK = "_check"


def plausible(value: Column, lo: float, hi: float) -> Column:
    """``near zero`` and ``too large`` are what a denominator of another source or grain, or a single snapshot, leads to."""
    return F.when(value < lo, "near zero").when(value >= hi, "too large").when(value.isNotNull(), "ok")


def blank_add(*cs: Column) -> Column:
    """Addition where a missing value counts as 0 unless all are missing."""
    total = reduce(lambda a, b: a + b, [F.coalesce(c, F.lit(0)) for c in cs])
    return F.when(reduce(lambda a, b: a & b, [c.isNull() for c in cs]), F.lit(None)).otherwise(total)


class Registry:
    def __init__(self, metrics: Iterable = ()):
        self.metrics: dict[str, Any] = {}
        for m in metrics:
            self.add(m)

    def add(self, m) -> None:
        self.metrics[m.name] = m

    def __getitem__(self, name):
        return self.metrics[name]

    def __contains__(self, name):
        return name in self.metrics

    def closure(self, names: Sequence[str]) -> list:
        """Requested metrics plus everything they depend on, dependencies first."""
        seen: dict[str, Any] = {}

        def visit(n):
            if n in seen:
                return
            m = self.metrics[n]
            if isinstance(m, Formula):
                for d in m.deps:
                    visit(d)
            elif isinstance(m, PeerAverage):
                pass   # evaluated by a sub-query
            seen[n] = m
        for n in names:
            visit(n)
        return list(seen.values())


# ------------------------------------------------------------ the compiler
@dataclass(frozen=True)
class _Ref:
    """A resolved column reference for one fact."""
    kind: str           # 'fact' | 'dim'
    column: str
    dim: str | None = None
    fk: str | None = None
    dk: str | None = None

    @property
    def key(self):
        return (self.dim or "", self.column) if self.kind == "dim" else ("", self.column)


#: A bounded dimension is broadcast by hint up to this size, by the optimizer's estimate from files and literals.
BROADCAST_BYTES = 64 << 20


def small(df: DataFrame) -> bool:
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())) <= BROADCAST_BYTES


def _bare(ref: str) -> str:
    return ref.split(".", 1)[1] if "." in ref else ref


@dataclass
class MetricQuery:
    star: Star
    registry: Registry
    metrics: Sequence[str]
    by: Sequence[str] = ()
    where: Any = None
    having: Column | None = None
    order: Sequence[tuple[str, str]] = ()
    limit: int | None = None
    keep_empty: bool = False
    below: bool = False
    scope: bool = False
    _where: tuple = field(init=False, default=())

    def __post_init__(self):
        self._where = _items(self.where)

    # -- column resolution ---------------------------------------------
    def _resolve(self, fact: str, ref: str) -> _Ref | None:
        fdf = self.star[fact]
        edges = self.star.edges(fact)
        if "." in ref:
            table, col = ref.split(".", 1)
            if table == fact:
                return _Ref("fact", col) if col in fdf.columns else None
            for fk, dim, dk in edges:
                if dim == table:
                    if col == dk:
                        return _Ref("fact", fk)
                    if col in self.star[dim].columns:
                        return _Ref("dim", col, dim, fk, dk)
            return None
        if ref in fdf.columns:
            return _Ref("fact", ref)
        for fk, dim, dk in edges:
            if ref in self.star[dim].columns:
                return _Ref("dim", ref, dim, fk, dk) if ref != dk else _Ref("fact", fk)
        return None

    # -- one fact -------------------------------------------------------
    def _fact_frame(self, fact: str, measures: list) -> DataFrame:
        groups = []
        for g in self.by:
            r = self._resolve(fact, g)
            if r is None:
                raise ValueError(f"{fact} cannot be grouped by {g}: no relationship")
            groups.append((_bare(g), r))
        outer = [(self._resolve(fact, c), spec) for c, spec in self._where]
        outer = [(r, s) for r, s in outer if r is not None]   # unrelated filters do not apply

        def own(m):
            out = []
            for c, spec in m.where:
                r = self._resolve(fact, c)
                if r is None or r.kind != "fact":
                    raise ValueError(f"metric {m.name}: filter column {c} must be on {fact}")
                out.append((r, spec))
            return out

        own_f = {m.name: own(m) for m in measures}
        overridden = {r.key for m in measures for r, _ in own_f[m.name]}
        common = [(r, s) for r, s in outer if r.key not in overridden]

        # the filters stay; a star that isn't written yet also leaves other days out at its sources
        df = self.star.between(fact, *within(days(r, s) for r, s in common))
        for r, s in common:
            if r.kind == "fact":
                df = df.where(predicate(F.col(r.column), s))
            # a written fact is stored by month: say which months a date filter can meet
            months = _months(r, s) if "month_key" in df.columns else None
            if months is not None:
                df = df.where(predicate(F.col("month_key"), months))

        values = {}
        for m in measures:
            keys_m = {r.key for r, _ in own_f[m.name]}
            conds = [predicate(F.col(r.column), s) for r, s in outer
                     if r.key in overridden and r.key not in keys_m]
            conds += [predicate(F.col(r.column), s) for r, s in own_f[m.name]]
            cond = reduce(lambda a, b: a & b, conds) if conds else None
            base = F.lit(1).cast("bigint") if isinstance(m, Count) else F.col(m.column)
            values[m.name] = F.when(cond, base) if cond is not None else base

        semi = [m for m in measures if isinstance(m, SemiAdditive)]
        over = semi[0].over if semi else None
        if any(m.over != over for m in semi):
            raise ValueError("semi-additive metrics of one fact must share 'over'")

        # dims needed for grouping or filtering
        need: dict[str, tuple[str, str]] = {}
        for _, r in groups:
            if r.kind == "dim":
                need[r.dim] = (r.fk, r.dk)
        for r, _ in common:
            if r.kind == "dim":
                need[r.dim] = (r.fk, r.dk)
        bounded = {d: v for d, v in need.items() if d in self.star.bounded}
        unbounded = {d: v for d, v in need.items() if d not in self.star.bounded}

        def dim_cols(dim):
            cols = {r.column for _, r in groups if r.kind == "dim" and r.dim == dim}
            cols |= {r.column for r, _ in common if r.kind == "dim" and r.dim == dim}
            return cols

        def join_dim(frame, dim, fk, dk, hint):
            cols = dim_cols(dim)
            d = self.star[dim].select(F.col(dk).alias(f"__k_{dim}"), *[F.col(c).alias(f"{dim}__{c}") for c in cols])
            for r, s in common:
                if r.kind == "dim" and r.dim == dim:
                    d = d.where(predicate(F.col(f"{dim}__{r.column}"), s))
                    # a dimension filter restricts the fact: inner join
            has_filter = any(r.kind == "dim" and r.dim == dim for r, _ in common)
            d = F.broadcast(d) if hint and small(d) else d.hint("merge")   # neither side goes through the driver by a wrong estimate
            return frame.join(d, F.col(fk) == F.col(f"__k_{dim}"), "inner" if has_filter else "left")

        def gcol(r: _Ref) -> str:
            return f"{r.dim}__{r.column}" if r.kind == "dim" else r.column

        # row-level projection
        fact_cols = {r.column for _, r in groups if r.kind == "fact"}
        fact_cols |= {fk for fk, _ in need.values()}
        if over:
            fact_cols.add(over)
        frame = df.select(*sorted(fact_cols), *[v.alias(n) for n, v in values.items()])
        for dim, (fk, dk) in bounded.items():
            frame = join_dim(frame, dim, fk, dk, hint=True)
        if unbounded:
            # eager aggregation to the FK grain before joining the large dimension
            keys = set(fact_cols) | {f"{d}__{c}" for d in bounded for c in dim_cols(d)}
            frame = frame.groupBy(*sorted(keys)).agg(*[F.sum(n).alias(n) for n in values])
            for dim, (fk, dk) in unbounded.items():
                frame = join_dim(frame, dim, fk, dk, hint=False)

        out_groups = [F.col(gcol(r)).alias(name) for name, r in groups]
        if semi:
            per = frame.groupBy(*[F.col(gcol(r)).alias(name) for name, r in groups], F.col(over).alias("__over")) \
                       .agg(*[F.sum(n).alias(n) for n in values])
            names = [name for name, _ in groups]
            return per.groupBy(*names).agg(
                *[(F.avg(n) if isinstance(m, SemiAdditive) else F.sum(n)).alias(n)
                  for n, m in zip(values, measures)])
        return frame.select(*out_groups, *values.keys())

    # -- the whole query ------------------------------------------------
    def _base_frame(self, closure: list) -> DataFrame:
        base = [m for m in closure if isinstance(m, BASE)]
        by_fact: dict[str, list] = {}
        for m in base:
            by_fact.setdefault(m.fact, []).append(m)
        frames = [self._fact_frame(f, ms) for f, ms in by_fact.items()]
        names = [_bare(g) for g in self.by]
        if len(frames) == 1 and not any(isinstance(m, SemiAdditive) for m in base):
            u = frames[0]
        else:
            u = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)
        aggs = []
        for m in base:
            if isinstance(m, SemiAdditive):
                aggs.append(F.max(m.name).alias(m.name))    # already final per group
            else:
                aggs.append(F.sum(m.name).alias(m.name))
        return u.groupBy(*names).agg(*aggs) if names else u.agg(*aggs)

    def _peer(self, pm: PeerAverage, result: DataFrame) -> DataFrame:
        names = [_bare(g) for g in self.by]
        peer_name = _bare(pm.peer)
        if peer_name not in names:
            return result.withColumns({pm.name: F.lit(None).cast("double"), pm.name + BELOW: F.lit(None).cast("boolean")})
        member_bare = _bare(pm.member)
        facts = sorted({m.fact for m in self.registry.closure([pm.base]) if isinstance(m, BASE)})

        def of_dim(ref):
            """Whether ``ref``, qualified or bare, means a column (or the key) of the peer dimension."""
            for fact in facts:
                r = self._resolve(fact, ref)
                if r is not None and (r.dim == pm.dim if r.kind == "dim" else any(
                        fk == r.column and d == pm.dim for fk, d, _ in self.star.edges(fact))):
                    return True
            return False

        others = [g for g in self.by if _bare(g) != peer_name and not of_dim(g)]
        where = [(c, s) for c, s in self._where if not of_dim(c)]
        if pm.exclude:
            where.append((pm.member, NotIn(tuple(pm.exclude))))
        keys = [peer_name, *[_bare(g) for g in others]]

        def canon(ref):
            same_member = _bare(ref) == member_bare and ("." not in ref or ref.startswith(pm.dim + "."))
            return pm.member if same_member else ref

        main_where = {(canon(c), repr(s)) for c, s in self._where}
        sub_where = {(canon(c), repr(s)) for c, s in where}
        same_grain = set(names) == {member_bare, peer_name, *[_bare(g) for g in others]}
        if pm.base in result.columns and same_grain and main_where == sub_where:
            # the sub-query would recompute exactly the main result's base metric
            sub = result.where(F.col(pm.base).isNotNull())
        else:
            sub = MetricQuery(self.star, self.registry, [pm.base], by=[pm.member, pm.peer, *others],
                              where=where).run()
        # exact: ratios become whole numbers of 1e-12, whose sum depends on no
        # order, and a member is below its peers if n times its own is less than
        # that sum; a member alone, or among equals, is never below
        whole = F.floor(F.col(pm.base) * 1e12 + 0.5).cast("decimal(38,0)")
        bench = sub.groupBy(*keys).agg(F.sum(whole).alias("__sum"), F.count(pm.base).alias("__n"))
        cond = reduce(lambda a, b: a & b, [result[k].eqNullSafe(bench[k]) for k in keys])
        mean = (F.col("__sum").cast("double") / F.col("__n") / 1e12).alias(pm.name)
        below = (whole * F.col("__n") < F.col("__sum")).alias(pm.name + BELOW)
        joined = result.join(bench, cond, "left").select(result["*"], "__sum", "__n")
        return joined.select(*result.columns, mean, below)

    # -- what the answer covers ------------------------------------------
    def _measures(self) -> list:
        """All base measures, those below peer averages included."""
        out = {}
        todo = list(self.metrics)
        while todo:
            for m in self.registry.closure([todo.pop()]):
                if isinstance(m, PeerAverage):
                    todo.append(m.base)
                elif isinstance(m, BASE):
                    out[m.name] = m
        return list(out.values())

    def scope_columns(self, out: DataFrame) -> dict[str, Column]:
        """What the answer covers, derived from its measures and filters: period_from, period_to (the calendar's ends where
        no filter sets them), sources, basis; unresolved_share beside ratios with references, and a check beside those
        with a plausible range."""
        measures = self._measures()
        facts = list(dict.fromkeys(m.fact for m in measures))
        found = [(fact, self._resolve(fact, c), c, s) for fact in facts for c, s in self._where]
        found = [x for x in found if x[1] is not None]
        period = within(days(r, s) for _, r, _, s in found)
        columns = period_columns(self.star, *period)
        columns |= {"sources": self._sources(measures), "basis": F.lit(basis(self.star, measures))}
        formulas = [m for m in self.registry.closure(self.metrics) if isinstance(m, Formula)]
        refs = {self.registry[n].fact for m in formulas for n in m.references}
        if refs:
            columns["unresolved_share"] = unresolved(self.star, sorted(refs), *period)
        for m in formulas:
            if m.plausible and m.name in out.columns:
                columns[m.name + CHECK] = plausible(F.col(m.name), *m.plausible)
        return columns

    def _sources(self, measures: list) -> Column:
        """The systems that the measures read: by their own and the query's filters on source and grain, and, if places are
        filtered, those of the places left."""
        cfg, names = self.star.config, set()
        for m in measures:
            own = set(cfg.fact_sources.get(m.fact, (m.fact,)))
            for c, spec in (*self._where, *m.where):
                if _bare(c) == "source":
                    own &= {x for x in own if _meets(x, spec)}
                elif _bare(c) == "grain":
                    own &= {x for g, x in cfg.grain_sources.items() if _meets(g, spec)}
            names |= own
        out = F.array(*[F.lit(x) for x in sorted(names)])
        places = [(_bare(c), s) for c, s in self._where if c.startswith("dim_location.") and "source" in self.star["dim_location"].columns]
        if places:
            d = self.star["dim_location"]
            for c, spec in places:
                d = d.where(predicate(F.col(c), spec))
            everywhere = [x for x in sorted(names) if x not in cfg.place_sources]
            out = F.array_intersect(out, F.concat(d.agg(F.collect_set("source")).scalar(), F.array(*[F.lit(x) for x in everywhere]).cast("array<string>")))
        return F.array_join(out, ", ")

    def run(self) -> DataFrame:
        closure = self.registry.closure(self.metrics)
        out = self._base_frame(closure)
        for m in closure:   # dependencies come first
            if isinstance(m, Formula):
                out = out.withColumn(m.name, m.fn(*[F.col(d) for d in m.deps]))
            elif isinstance(m, PeerAverage):
                out = self._peer(m, out)
        names = [_bare(g) for g in self.by]
        flags = [c for c in out.columns if c.endswith(BELOW)] if self.below else []
        out = out.select(*names, *[_present(out, m) for m in self.metrics], *flags)
        if not self.keep_empty and self.metrics:
            out = out.where(reduce(lambda a, b: a | b, [F.col(m).isNotNull() for m in self.metrics]))
        if self.having is not None:
            out = out.where(self.having)
        if self.order:
            out = out.orderBy(*[(F.col(c).desc_nulls_last() if d == "desc" else F.col(c).asc_nulls_last())
                                for c, d in self.order])
        if self.limit is not None:
            out = out.limit(self.limit)
        return out.withColumns(self.scope_columns(out)) if self.scope else out


def _meets(value, spec) -> bool:
    if isinstance(spec, NotIn):
        return value not in spec.values
    return value in spec if isinstance(spec, (list, tuple, set, frozenset)) else value == spec


def basis(star: Star, measures: Iterable) -> str:
    """Net or gross money, or both, else quantities."""
    money = sorted({star.config.bases[m.column] for m in measures if isinstance(m, Sum) and m.column in star.config.bases})
    return ", ".join(money) or "quantity"


def period_columns(star: Star, lo: int | None = None, hi: int | None = None) -> dict[str, Column]:
    """The period's ends; open ones are those of the calendar, which is the data window."""
    if lo is None or hi is None:
        window = star["dim_date"].agg(F.struct(F.min("date_key").alias("lo"), F.max("date_key").alias("hi"))).scalar()
    ends = {"period_from": window.getField("lo") if lo is None else F.lit(lo), "period_to": window.getField("hi") if hi is None else F.lit(hi)}
    return {k: v.cast("int") for k, v in ends.items()}


def unresolved(star: Star, facts: Sequence[str], lo: int | None = None, hi: int | None = None, key: str = "sku") -> Column:
    """Of the facts' rows in the period, the share whose product wasn't found."""
    parts = []
    for fact in facts:
        df = star.between(fact, lo, hi)
        if lo is not None:
            df = df.where(F.col("date_key") >= lo)
        if hi is not None:
            df = df.where(F.col("date_key") <= hi)
        parts.append(df.agg(F.count_if(F.col(key).isin(*star.config.unknown_labels)).alias("a"), F.count(F.lit(1)).alias("b")))
    both = reduce(lambda x, y: x.unionByName(y), parts)
    return both.agg(safe_ratio(F.sum("a"), F.sum("b"))).scalar()


def _present(df: DataFrame, name: str) -> Column:
    """Money totals leave as DECIMAL(38,2) whatever the aggregation depth."""
    from pyspark.sql.types import DecimalType
    if isinstance(df.schema[name].dataType, DecimalType):
        return F.col(name).cast("decimal(38,2)").alias(name)
    return F.col(name)


def query(star: Star, registry: Registry, metrics: Sequence[str], by: Sequence[str] = (),
          where=None, having: Column | None = None, order: Sequence[tuple[str, str]] = (),
          limit: int | None = None, below: bool = False, scope: bool = False) -> DataFrame:
    """``below`` adds, for each peer average asked for, whether the row is below it (``<name>__below``); ``scope`` what the
    answer covers (see ``MetricQuery.scope_columns``)."""
    return MetricQuery(star, registry, list(metrics), list(by), where, having, list(order), limit, below=below, scope=scope).run()
