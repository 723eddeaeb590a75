"""The table builder: group-bys, metrics, filters and one or two periods over a transaction table, in one pass."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerline.functions.casting import quoted
from ledgerline.functions.fields import change, dataset, filters, obligation, period_mask, resolve, vendor

METRICS = ("obligations", "transactions", "vendors", "vendors_nonzero_net")
MOST_DETAIL = 100_000


@dataclass(frozen=True)
class TableRequest:
    dataset: str = "contracts"
    rows: tuple[str, ...] = ("funding_subagency",)
    metrics: tuple[str, ...] = ("obligations",)
    period_a: tuple[str, str] | None = None
    period_b: tuple[str, str] | None = None
    date_field: str = "action_date"
    filters: dict[str, str] = field(default_factory=dict)
    top: int | None = None
    round_to: int | None = None


def _in_period(df: DataFrame, request: TableRequest) -> tuple[Column, Column | None, DataFrame]:
    """Masks of A and B, and the rows that are in one of them; B alone does not filter."""
    a = period_mask(df, request.period_a, request.date_field)
    b = period_mask(df, request.period_b, request.date_field) if request.period_b else None
    if request.period_a:
        df = df.where(a | b if b is not None else a)
    return a, b, df


def build_table(df: DataFrame, request: TableRequest) -> DataFrame:
    """One row a group: group columns g0.., per metric <metric>_a, and with a second period <metric>_b, _delta and _pct.

    All metrics come from one grouping. Nonzero-net vendors need the net of each vendor first; then everything is summed
    from (group, vendor), so that the rows are read once. As the only metric, groups without a vendor are absent; among
    others its value is NULL for them.
    """
    dataset(request.dataset)
    if bad := [m for m in request.metrics if m not in METRICS]:
        raise ValueError(f"unknown metrics: {bad}")
    for c in filters(df, request.filters):
        df = df.where(c)
    groups = [c for c in (resolve(df, f) for f in request.rows) if c is not None] or [resolve(df, "funding_subagency")]
    amount = obligation(df)
    a, b, df = _in_period(df, request)
    masks = {"a": a} | ({"b": b} if b is not None else {})
    keys = [f"g{i}" for i in range(len(groups))]
    # what a mask needs is computed once a row
    rows = df.select(*[g.alias(k) for g, k in zip(groups, keys, strict=True)], amount.alias("_obl"), vendor().alias("_uei"), *[m.alias(f"_{p}") for p, m in masks.items()])
    aggs: list[Column] = []
    nets = "vendors_nonzero_net" in request.metrics
    if nets:
        each = []
        for p in masks:
            each += [F.sum(F.when(F.col(f"_{p}"), F.col("_obl"))).alias(f"_obl_{p}"), F.sum(F.when(F.col(f"_{p}"), 1).otherwise(0)).alias(f"_n_{p}")]
        rows = rows.groupBy(*keys, "_uei").agg(*each)
        if request.metrics == ("vendors_nonzero_net",):
            rows = rows.where("_uei IS NOT NULL")
    for p in masks:
        obl, n, uei = (F.col(f"_obl_{p}"), F.col(f"_n_{p}"), F.col("_uei")) if nets else (F.when(F.col(f"_{p}"), F.col("_obl")), F.when(F.col(f"_{p}"), 1).otherwise(0), F.when(F.col(f"_{p}"), F.col("_uei")))
        net = F.round(obl, 2) != 0
        made = {
            "obligations": F.sum(obl) if request.round_to is None else F.round(F.sum(obl), request.round_to),
            "transactions": F.sum(n),
            # with vendors grouped already, one row is one vendor
            "vendors": F.sum(F.when(uei.isNotNull() & (n > 0), 1).otherwise(0)) if nets else F.count_distinct(uei),
            "vendors_nonzero_net": F.when(F.count("_uei") > 0, F.sum(F.when(F.col("_uei").isNotNull() & net, 1).otherwise(0))),
        }
        aggs += [made[m].alias(f"{m}_{p}") for m in request.metrics]
    out = rows.groupBy(*keys).agg(*aggs)
    if b is not None:
        for m in request.metrics:
            delta, pct = change(F.col(f"{m}_a"), F.col(f"{m}_b"))
            out = out.withColumns({f"{m}_delta": F.round(delta, 2) if m == "obligations" else delta, f"{m}_pct": pct})
    order = [F.desc_nulls_last(f"{request.metrics[0]}_a"), *[F.asc_nulls_last(k) for k in keys]]
    return out.orderBy(*order).limit(request.top) if request.top is not None else out.orderBy(*order)


def detail(df: DataFrame, request: TableRequest, limit: int = MOST_DETAIL) -> tuple[DataFrame, Column]:
    """Filtered rows in full, largest amounts first, at most limit; and the test of a count whether they were cut."""
    spec = dataset(request.dataset)
    limit = max(1, min(limit, MOST_DETAIL))
    for c in filters(df, request.filters):
        df = df.where(c)
    amount = obligation(df)
    _, _, df = _in_period(df, request)
    rows = df.orderBy(amount.desc_nulls_last(), F.asc_nulls_last(spec.transaction_key)) if spec.transaction_key in df.columns else df.orderBy(amount.desc_nulls_last())
    return rows.limit(limit).select(*[quoted(c) for c in spec.detail if c in df.columns]), F.count("*") >= limit


def metric_join(tables: list[DataFrame], keys: list[str]) -> DataFrame:
    """Full outer join of one-metric tables on group keys, NULL keys equal; the keys of whichever side has the row."""
    out = tables[0]
    for i, t in enumerate(tables[1:]):
        other = t.withColumnsRenamed({k: f"_{i}_{k}" for k in keys})
        same = [F.col(k).eqNullSafe(F.col(f"_{i}_{k}")) for k in keys]
        left = out.withColumn("_l", F.lit(1))
        out = left.join(other, same, "full")
        out = out.withColumns({k: F.when(F.col("_l").isNotNull(), F.col(k)).otherwise(F.col(f"_{i}_{k}")) for k in keys}).drop("_l", *[f"_{i}_{k}" for k in keys])
    return out


def fields(df: DataFrame) -> DataFrame:
    """The table's fields, without partition columns: field, label."""
    names = [(c, c.replace("_", " ")) for c in df.columns if c not in ("fiscal_year", "agency")]
    return df.sparkSession.createDataFrame(names, "field string, label string")


def top(df: DataFrame, by: str, n: int, where: Column | None = None) -> DataFrame:
    """The n groups with the largest obligations: (by, obligations)."""
    rows = df if where is None else df.where(where)
    sums = rows.groupBy(quoted(by).alias(by)).agg(F.round(F.sum(obligation(df)), 2).alias("obligations"))
    return sums.orderBy(F.desc_nulls_last("obligations"), F.asc_nulls_last(by)).limit(n)


def large(df: DataFrame, over: float, columns: list[str]) -> DataFrame:
    """Transactions over an amount, largest first."""
    return df.where(obligation(df) > over).orderBy(obligation(df).desc_nulls_last(), *columns).select(*columns)


