"""The eight portfolio cohort analyses as declarative specs run by one function.

Each analysis is data: derived key columns, grouping keys, named measures, an
optional group-size floor (HAVING), relabels applied after grouping, and an
output order. ``analyse`` turns a spec into one lazy Catalyst plan:

    scan -> filter (pushed down) -> project derived keys -> partial agg
         -> shuffle on the keys -> final agg -> having -> relabel

All measures are algebraic (count, avg), so Spark aggregates map-side before
the shuffle: a key holding a third of all rows costs one partial row per
task, never a hot reducer. The credit/income quintile (analysis 2) aggregates
per tile without ranking the table (``tiles.tile_sums``).
"""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import derive as D
from ..functions import labels as L
from ..schema import ID_COL
from .filters import portfolio_filter
from .tiles import tile_sums

ColumnFn = Callable[[], Column]


def _count() -> Column:
    return F.count(F.lit(1))


def _avg_rounded(col: str, places: int) -> ColumnFn:
    return lambda: F.round(F.avg(col), places)


@dataclass(frozen=True)
class CohortSpec:
    number: int
    name: str
    keys: tuple[str, ...]
    measures: tuple[tuple[str, ColumnFn], ...]
    chart_type: str
    axes: Mapping[str, str]
    derived: tuple[tuple[str, ColumnFn], ...] = ()
    compute: Callable[[DataFrame], DataFrame] | None = None  # instead of grouping by the keys
    min_count: tuple[str, int] | None = None
    after: tuple[tuple[str, ColumnFn], ...] = ()
    order_by: tuple[str, ...] = ()

    @property
    def title(self) -> str:
        return L.TITLES[self.number]

    @property
    def output_columns(self) -> list[str]:
        cols = list(self.keys) + [n for n, _ in self.measures]
        return cols + [n for n, _ in self.after if n not in cols]


def _ratio_quintiles(df: DataFrame) -> DataFrame:
    """Count, mean ratio and default rate per quintile of the credit/income
    ratio over the whole filtered table (ties broken by client id so the
    tiles are repeatable)."""
    sums = tile_sums(df, 5, D.credit_income_ratio(), F.col(ID_COL), D.is_default())
    return sums.select(
        F.col("tile").alias("RATIO_CATEGORY"), F.col("n").alias("COUNT"),
        F.round(F.try_divide("s", "m"), 2).alias("AVG_RATIO"),
        F.round(F.col("d") / F.col("n") * 100, 2).alias("DEFAULT_RATE"))


_RATE = ("DEFAULT_RATE", lambda: D.default_rate())

SPECS: dict[int, CohortSpec] = {s.number: s for s in (
    CohortSpec(
        1, "age_band", keys=("AGE_GROUP",),
        derived=(("AGE_GROUP", lambda: D.age_band()),),
        measures=(("CLIENT_COUNT", _count), _RATE),
        chart_type="bar", axes={"x_col": "AGE_GROUP", "y_col": "DEFAULT_RATE"}),
    CohortSpec(
        2, "credit_income_quintile", keys=("RATIO_CATEGORY",),
        compute=_ratio_quintiles,
        measures=(("COUNT", _count),
                  ("AVG_RATIO", _avg_rounded("CREDIT_INCOME_RATIO", 2)), _RATE),
        chart_type="scatter", axes={"x_col": "AVG_RATIO", "y_col": "DEFAULT_RATE"}),
    CohortSpec(
        3, "income_type", keys=("NAME_INCOME_TYPE",),
        measures=(("CLIENT_COUNT", _count),
                  ("AVG_INCOME", _avg_rounded("AMT_INCOME_TOTAL", 0)), _RATE),
        min_count=("CLIENT_COUNT", 100),
        chart_type="scatter", axes={"x_col": "AVG_INCOME", "y_col": "DEFAULT_RATE"}),
    CohortSpec(
        4, "employment_band", keys=("EMPLOYMENT_LENGTH",),
        derived=(("EMPLOYMENT_LENGTH", lambda: D.employment_band()),),
        measures=(("CLIENT_COUNT", _count), _RATE),
        order_by=("EMPLOYMENT_LENGTH",),
        chart_type="bar", axes={"x_col": "EMPLOYMENT_LENGTH", "y_col": "DEFAULT_RATE"}),
    CohortSpec(
        5, "enquiry_band", keys=("ENQUIRY_GROUP",),
        derived=(("ENQUIRY_GROUP", lambda: D.enquiry_band()),),
        measures=(("CLIENT_COUNT", _count), _RATE),
        chart_type="scatter", axes={"x_col": "ENQUIRY_GROUP", "y_col": "DEFAULT_RATE"}),
    CohortSpec(
        6, "contract_realty", keys=("NAME_CONTRACT_TYPE", "FLAG_OWN_REALTY"),
        measures=(("CLIENT_COUNT", _count),
                  ("AVG_CREDIT", _avg_rounded("AMT_CREDIT", 0)), _RATE),
        after=(("FLAG_OWN_REALTY", lambda: D.realty_label()),),
        chart_type="bar_grouped",
        axes={"x_col": "NAME_CONTRACT_TYPE", "y_col": "DEFAULT_RATE",
              "group_col": "FLAG_OWN_REALTY"}),
    CohortSpec(
        7, "family_children", keys=("NAME_FAMILY_STATUS", "CNT_CHILDREN"),
        measures=(("CLIENT_COUNT", _count), _RATE),
        min_count=("CLIENT_COUNT", 50),
        chart_type="heatmap",
        axes={"x_col": "NAME_FAMILY_STATUS", "y_col": "CNT_CHILDREN",
              "z_col": "DEFAULT_RATE"}),
    CohortSpec(
        8, "weekday", keys=("WEEKDAY_APPR_PROCESS_START",),
        measures=(("APPLICATION_COUNT", _count), _RATE,
                  ("AVG_CREDIT", _avg_rounded("AMT_CREDIT", 0))),
        after=(("WEEKDAY_ORDER", lambda: D.weekday_rank()),),
        order_by=("WEEKDAY_ORDER",),
        chart_type="polar",
        axes={"theta_col": "WEEKDAY_APPR_PROCESS_START", "r_col": "DEFAULT_RATE"}),
)}

_BY_NAME = {s.name: s for s in SPECS.values()}


def spec(analysis: int | str) -> CohortSpec:
    """Resolve an analysis by number (1-8, also as text) or by name."""
    if isinstance(analysis, str):
        if analysis in _BY_NAME:
            return _BY_NAME[analysis]
        if analysis.strip().isdigit():
            analysis = int(analysis)
    if isinstance(analysis, int) and analysis in SPECS:
        return SPECS[analysis]
    raise ValueError(f"unknown analysis {analysis!r}: expected 1-8 or one of {sorted(_BY_NAME)}")


def run_spec(s: CohortSpec, df: DataFrame) -> DataFrame:
    """Apply one spec to an already filtered table."""
    if s.compute is not None:
        return s.compute(df)
    if s.derived:
        df = df.withColumns({n: fn() for n, fn in s.derived})
    out = df.groupBy(*s.keys).agg(*[fn().alias(n) for n, fn in s.measures])
    if s.min_count is not None:
        col, floor = s.min_count
        out = out.where(F.col(col) > F.lit(floor))
    if s.after:
        out = out.withColumns({n: fn() for n, fn in s.after})
    out = out.select(*s.output_columns)
    if s.order_by:
        out = out.orderBy(*s.order_by)
    return out


_FILTER_KEYS = ("min_credit", "max_credit", "min_income")


def analyse(df: DataFrame, analysis: int | str = 1, min_credit=None, max_credit=None,
            min_income=None, filters: Mapping | None = None) -> DataFrame:
    """Run one cohort analysis on the portfolio after the amount filters,
    given as keywords or as a ``filters`` mapping with the same keys."""
    s = spec(analysis)
    if filters:
        unknown = set(filters) - set(_FILTER_KEYS)
        if unknown:
            raise ValueError(f"unknown filters {sorted(unknown)}; expected {_FILTER_KEYS}")
        min_credit = filters.get("min_credit", min_credit)
        max_credit = filters.get("max_credit", max_credit)
        min_income = filters.get("min_income", min_income)
    return run_spec(s, portfolio_filter(df, min_credit, max_credit, min_income))


def metadata(analysis: int | str, filters: Mapping | None = None) -> dict:
    """Chart metadata for a result: type, title, filters and axis columns."""
    s = spec(analysis)
    return {"analysis_type": s.number, "chart_type": s.chart_type, "title": s.title,
            "filters": dict(filters or {}), **s.axes}


# --- Chart-shaped results -----------------------------------------------------

NULL_LABEL = "(null)"


def _quoted(label: Column, taken) -> Column:
    """A label that would be mistaken for one of ``taken`` stands in quotes."""
    return F.when(label.isin(list(taken)), F.concat(F.lit('"'), label, F.lit('"'))).otherwise(label)


def _matrix(grouped: DataFrame, row: str, label: Column, value: Column, known) -> DataFrame:
    """Chart shape of a grouped result: one row per ``row``, one column per
    label. The columns are the known labels and, sorted after them, every
    other label in the result; a null label has the column ``(null)``, and a
    label of that text stands in quotes. The
    other labels are read from the grouped result (a row per group), which
    takes a job when the matrix is built."""
    named = grouped.select(row, F.coalesce(_quoted(label, [NULL_LABEL]), F.lit(NULL_LABEL)).alias("_label"),
                           value.alias("_value"))
    others = [r[0] for r in named.select("_label").distinct().collect() if r[0] not in known]
    return (named.groupBy(row).pivot("_label", [*known, *sorted(others)]).agg(F.sum("_value")))


def contract_realty_matrix(df: DataFrame, **filters) -> DataFrame:
    """Grouped-bar shape of analysis 6: one row per contract type, one
    default-rate column per ownership label; an unmapped flag is its own
    label, so no group hides another."""
    bare = replace(spec(6), after=())
    grouped = run_spec(bare, portfolio_filter(df, **filters))
    label = F.coalesce(D.realty_label(), _quoted(F.col("FLAG_OWN_REALTY"), L.REALTY_LABELS.values()))
    return _matrix(grouped, "NAME_CONTRACT_TYPE", label, F.col("DEFAULT_RATE"),
                   list(L.REALTY_LABELS.values()))


def family_children_matrix(df: DataFrame, statuses=None, **filters) -> DataFrame:
    """Heat-map shape of analysis 7: one row per number of children, one
    column per family status (the usual ones or ``statuses`` first, then any
    other in the result), cell = default rate of the group if it passed the
    size floor."""
    known = list(statuses or L.TRANSLATIONS["family_status"].keys())
    return _matrix(analyse(df, 7, **filters), "CNT_CHILDREN", F.col("NAME_FAMILY_STATUS"),
                   F.col("DEFAULT_RATE"), known).orderBy("CNT_CHILDREN")


def matrix_cells(matrix: DataFrame) -> DataFrame:
    """Long form of a chart matrix: its first column, ``LABEL`` and ``VALUE``
    of every filled cell."""
    row, *labels = matrix.columns
    return matrix.unpivot([row], [f"`{c}`" for c in labels], "LABEL", "VALUE").where("VALUE is not null")


def as_records(df: DataFrame, col: str = "record") -> DataFrame:
    """One JSON text per result row (the records form of a cohort result);
    the caller writes or collects it."""
    return df.select(F.to_json(F.struct(*[F.col(c) for c in df.columns])).alias(col))


# --- Whole dashboard in one scan ------------------------------------------------

REPORT_ANALYSES = (1, 3, 4, 5, 6, 7, 8)  # every analysis without a global rank

_REPORT_MEASURES = (
    ("CLIENT_COUNT", _count),
    ("DEFAULT_RATE", lambda: D.default_rate()),
    ("AVG_INCOME", _avg_rounded("AMT_INCOME_TOTAL", 0)),
    ("AVG_CREDIT", _avg_rounded("AMT_CREDIT", 0)),
)
_MEASURE_ALIASES = {"APPLICATION_COUNT": "CLIENT_COUNT"}


def cohort_report(df: DataFrame, analyses=REPORT_ANALYSES, min_credit=None,
                  max_credit=None, min_income=None) -> DataFrame:
    """Several analyses from ONE scan and ONE shuffle, in long form.

    The derived keys of all requested analyses are projected once, then a
    ``GROUPING SETS`` aggregate (one set per analysis) computes count,
    default rate and mean amounts for every set; the expand and partial
    aggregation happen map-side, so the shuffle carries only group rows.
    Each analysis's floor and relabels are applied afterwards. Output:
    ``ANALYSIS, KEY1, KEY2`` (text keys; ``KEY2`` for the two-key analyses),
    ``CLIENT_COUNT, DEFAULT_RATE`` and ``AVG_INCOME`` / ``AVG_CREDIT`` /
    ``WEEKDAY_ORDER`` where the analysis reports them (else null). An unknown
    weekday fails the report as it fails analysis 8. The ranked analysis (2) needs a
    global order and is not part of the report.
    """
    specs = list({spec(a).number: spec(a) for a in analyses}.values())
    if any(s.compute is not None for s in specs):
        raise ValueError("the ranked analysis cannot share the grouping scan")
    if len({frozenset(s.keys) for s in specs}) != len(specs):
        raise ValueError("analyses with the same keys cannot share one grouping set")
    base = portfolio_filter(df, min_credit, max_credit, min_income)
    derived = {n: fn() for s in specs for n, fn in s.derived}
    base = base.withColumns(derived) if derived else base
    keys = list(dict.fromkeys(k for s in specs for k in s.keys))
    sets = [[F.col(k) for k in s.keys] for s in specs]
    grouped = base.groupingSets(sets, *[F.col(k) for k in keys]).agg(
        *[fn().alias(n) for n, fn in _REPORT_MEASURES],
        F.grouping_id(*[F.col(k) for k in keys]).alias("_gid"))

    # One projection over the single aggregate (separate filtered branches
    # would each be planned as their own scan). grouping_id has a bit set for
    # every key NOT in the set, first key = highest bit.
    gid = {s.number: sum(1 << (len(keys) - 1 - i) for i, k in enumerate(keys) if k not in s.keys)
           for s in specs}
    g = F.col("_gid")

    def by_analysis(value_of) -> Column:
        expr = None
        for s in specs:
            v = value_of(s)
            if v is None:
                continue
            expr = F.when(g == gid[s.number], v) if expr is None else expr.when(g == gid[s.number], v)
        return expr if expr is not None else F.lit(None)

    def key(s: CohortSpec, i: int) -> Column | None:
        if len(s.keys) <= i:
            return None
        after = dict(s.after)
        k = s.keys[i]
        return (after[k]() if k in after else F.col(k)).cast("string")

    def reports(name: str):
        return lambda s: F.col(name) if any(_MEASURE_ALIASES.get(n, n) == name
                                              for n, _ in s.measures) else None

    keep = F.lit(True)
    for s in specs:
        if s.min_count is not None:
            col, floor = s.min_count
            keep = keep & ~((g == gid[s.number]) & (F.col(_MEASURE_ALIASES.get(col, col)) <= floor))
    return grouped.where(keep).select(
        by_analysis(lambda s: F.lit(s.number)).cast("int").alias("ANALYSIS"),
        by_analysis(lambda s: key(s, 0)).cast("string").alias("KEY1"),
        by_analysis(lambda s: key(s, 1)).cast("string").alias("KEY2"),
        F.col("CLIENT_COUNT"), F.col("DEFAULT_RATE"),
        by_analysis(reports("AVG_INCOME")).cast("double").alias("AVG_INCOME"),
        by_analysis(reports("AVG_CREDIT")).cast("double").alias("AVG_CREDIT"),
        by_analysis(lambda s: dict(s.after)["WEEKDAY_ORDER"]() if "WEEKDAY_ORDER" in dict(s.after) else None)
        .cast("int").alias("WEEKDAY_ORDER"))
