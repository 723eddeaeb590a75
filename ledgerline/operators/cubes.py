"""Dashboard aggregates: trends, breakdowns with a top list per period, option lists, ZIP summary and what is read off them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerline.functions.casting import quoted
from ledgerline.functions.fields import ALIASES, DIMENSIONS, DatasetSpec, county_fips, county_label, obligation, option_label, or_unknown, resolve, slug, zip5

YEAR = "action_date_fiscal_year"
TOP, TOP_BY_AGENCY = 25, 15
#: Values up to which a field has a list of options; computed ahead, and live.
MOST_OPTIONS, MOST_LIVE = 10_000, 400
#: Fields that are known to have more values than any list may hold, never scanned.
SEARCHED_ONLY = {"recipient", "recipient_parent", "recipient_name", "recipient_parent_name", "recipient_uei"}
#: Relative error of the sketches of how many values a field has.
SKETCH_ERROR = 0.02
# Dimensions in which agencies are broken down, and the name columns of code fields.
BY_AGENCY = ("recipient", "recipient_parent", "state", "county", "zip", "naics", "psc", "competition", "set_aside", "assistance_type", "cfda", "business_size")
CODE_NAMES = {"funding_sub_agency_code": "funding_sub_agency_name", "awarding_sub_agency_code": "awarding_sub_agency_name"}


def _sums(df: DataFrame) -> list[Column]:
    return [F.round(F.coalesce(F.sum("_obl"), F.lit(0.0)), 2).alias("obligations"), F.count("*").alias("transactions")]


def _slim(df: DataFrame, **columns: Column) -> DataFrame:
    return df.select(*[c.alias(k) for k, c in columns.items()], obligation(df).alias("_obl"))


def dimension(spec: DatasetSpec, key: str) -> Column:
    """A breakdown dimension: valid county codes, five-digit ZIPs, other columns as they are."""
    c = quoted(spec.breakdowns[key][0])
    return county_fips(c) if key == "county" else zip5(c) if key == "zip" else c


def trend(df: DataFrame) -> DataFrame:
    """KPIs per fiscal year and `all`; rows without a year count in `all` only. (period, obligations, transactions)."""
    both = _slim(df, fy=quoted(YEAR)).rollup("fy").agg(F.grouping_id().alias("_all"), *_sums(df))
    return both.where("_all = 1 OR fy IS NOT NULL").select(F.when(F.col("_all") == 1, "all").otherwise(F.col("fy")).alias("period"), "obligations", "transactions")


def _series(df: DataFrame) -> DataFrame:
    """Unrounded sums (o, n) by year, agency and sub-agency, blanks as (unknown); without rows that have no year."""
    rows = _slim(df, fy=quoted(YEAR), agency=or_unknown(F.col("awarding_agency_name")), subagency=or_unknown(F.col("awarding_sub_agency_name")))
    return rows.where("fy IS NOT NULL").groupBy("fy", "agency", "subagency").agg(F.coalesce(F.sum("_obl"), F.lit(0.0)).alias("o"), F.count("*").alias("n"))


def timeseries(df: DataFrame) -> DataFrame:
    """Year, agency and sub-agency, blanks as (unknown); without rows that have no year."""
    return _series(df).select("fy", "agency", "subagency", F.round("o", 2).alias("obligations"), F.col("n").alias("transactions"))


def _ranked(df: DataFrame, group: list[str], n: int | None) -> DataFrame:
    order = Window.partitionBy(*group).orderBy(F.desc_nulls_last("obligations"), F.asc_nulls_last("label"))
    out = df.withColumn("rank", F.row_number().over(order))
    return out if n is None else out.where(F.col("rank") <= n)


def breakdown(df: DataFrame, spec: DatasetSpec, key: str, n: int = TOP) -> DataFrame:
    """A dimension per year and over all years: (period, label, obligations, transactions, rank).

    Dimensions that are not kept whole have the n largest labels of each period. Rows without a year are in no period.
    """
    rows = _slim(df, fy=quoted(YEAR), label=dimension(spec, key)).where("fy IS NOT NULL AND label IS NOT NULL")
    # years first: all years are then summed from far fewer rows
    years = rows.groupBy("fy", "label").agg(F.sum("_obl").alias("_obl"), F.count("*").alias("_n"))
    sets = years.groupingSets([["fy", "label"], ["label"]], "fy", "label").agg(F.grouping("fy").alias("_all"), F.round(F.coalesce(F.sum("_obl"), F.lit(0.0)), 2).alias("obligations"), F.sum("_n").alias("transactions"))
    out = sets.select(F.when(F.col("_all") == 1, "all").otherwise(F.col("fy")).alias("period"), "label", "obligations", "transactions")
    return _ranked(out, ["period"], None if spec.breakdowns[key][1] else n)


def agency_breakdown(df: DataFrame, spec: DatasetSpec, key: str, n: int = TOP_BY_AGENCY) -> DataFrame:
    """The n largest labels of each agency and year, and of each agency over all rows: (agency, period, label, ..., rank).

    Rows without an agency are in no list; dimensions not in BY_AGENCY are errors. Grouped by agency, year and label before
    anything is ranked, so that a large agency is never one group of its rows.
    """
    if key not in BY_AGENCY:
        raise ValueError(f"not a dimension of agencies: {key!r}")
    rows = _slim(df, agency=F.col("awarding_agency_name"), fy=quoted(YEAR), label=dimension(spec, key)).where("agency IS NOT NULL AND label IS NOT NULL")
    years = rows.groupBy("agency", "fy", "label").agg(F.sum("_obl").alias("_obl"), F.count("*").alias("_n"))
    sets = years.groupingSets([["agency", "fy", "label"], ["agency", "label"]], "agency", "fy", "label")
    sums = sets.agg(F.grouping("fy").alias("_all"), F.round(F.coalesce(F.sum("_obl"), F.lit(0.0)), 2).alias("obligations"), F.sum("_n").alias("transactions"))
    out = sums.where("_all = 1 OR fy IS NOT NULL").select("agency", F.when(F.col("_all") == 1, "all").otherwise(F.col("fy")).alias("period"), "label", "obligations", "transactions")
    return _ranked(out, ["agency", "period"], n)


def agency_kpis(df: DataFrame) -> DataFrame:
    """KPIs of every agency for every year, zeros where it has none, and `all` of its years: (agency, slug, period, ...)."""
    cube = _series(df).groupBy("agency", "fy").agg(F.sum("o").alias("o"), F.sum("n").alias("n"))
    # a row an agency with its years, so that df is read once; joins of agencies and years would each read it again
    own = cube.groupBy("agency").agg(F.collect_list(F.struct("fy", "o", "n")).alias("own"), F.sum("o").alias("o"), F.sum("n").alias("n"))
    years = own.withColumn("years", F.array_distinct(F.flatten(F.collect_list(F.col("own.fy")).over(Window.partitionBy(F.lit(0))))))
    zero = F.struct(F.lit(0.0).alias("o"), F.lit(0).cast("bigint").alias("n"))
    found = F.transform("years", lambda y: F.struct(y.alias("period"), F.coalesce(F.get(F.transform(F.filter("own", lambda x: x["fy"] == y), lambda x: F.struct(x["o"].alias("o"), x["n"].alias("n"))), F.lit(0)), zero).alias("sums")))
    total = F.array(F.struct(F.lit("all").alias("period"), F.struct("o", "n").alias("sums")))
    rows = years.select("agency", F.explode(F.concat(found, total)).alias("x"))
    return rows.select("agency", slug(F.col("agency")).alias("slug"), "x.period", F.round("x.sums.o", 2).alias("obligations"), F.col("x.sums.n").alias("transactions"))


def county_names(df: DataFrame) -> DataFrame:
    """One display name per county code."""
    rows = df.select(county_fips(F.col("prime_award_transaction_recipient_county_fips_code")).alias("fips"), "recipient_county_name", "recipient_state_code").where("fips IS NOT NULL")
    one = rows.groupBy("fips").agg(F.min("recipient_county_name").alias("county"), F.min("recipient_state_code").alias("state"))
    return one.select("fips", "county", "state", county_label(F.col("county"), F.col("state")).alias("label"))


def _with_smallest(sums: DataFrame, group: list[str], text: str) -> DataFrame:
    """Sums (group.., text, o, n) put together by group, with the group's smallest text. Least texts by aggregation would sort raw rows."""
    own = Window.partitionBy(*group)
    first = F.row_number().over(own.orderBy(F.asc_nulls_last(text)))
    both = sums.withColumns({"_o": F.sum("o").over(own), "_c": F.sum("n").over(own), "_n": first}).where("_n = 1")
    return both.select(*group, text, F.col("_o").alias("o"), F.col("_c").alias("n"))


def filter_candidates(df: DataFrame) -> list[str]:
    """The dimensions, coded fields and further codes that may have a list of options, those that df lacks left out."""
    names = [*DIMENSIONS, *ALIASES]
    return [n for n in names if n not in SEARCHED_ONLY and (DIMENSIONS.get(n) or ALIASES[n]) in df.columns]


def filter_options(df: DataFrame, fields: list[str] | None = None, most: int = MOST_OPTIONS) -> DataFrame:
    """Values of each field by obligations, of fields with at most `most` values: (field, value, label, obligations, rank).

    fields: dimensions, aliases or columns; filter_candidates if not given. Codes with a name column (CODE_NAMES) are
    labelled `name (code)`, with the smallest name where there are several; other values are their own labels. Fields that
    only are searched, and those that are not there, are left out. A first pass sketches how many values each field has, so
    that the values of fields far beyond `most` are never shuffled; those that are left are counted exactly, all in one pass.
    """
    own = {f: resolve(df, f) for f in (filter_candidates(df) if fields is None else fields) if f not in SEARCHED_ONLY and (DIMENSIONS.get(f) or ALIASES.get(f) or f) in df.columns}
    own = {f: c.cast("string") for f, c in own.items() if c is not None}
    none = df.sparkSession.createDataFrame([], "field string, value string, label string, obligations double, rank int")
    if not own:
        return none
    sketch = df.agg(*[F.approx_count_distinct(c, SKETCH_ERROR).alias(f"f{i}") for i, c in enumerate(own.values())]).first()
    kept = {f: c for i, (f, c) in enumerate(own.items()) if sketch[f"f{i}"] <= most * (1 + 10 * SKETCH_ERROR) + 10}
    if not kept:
        return none
    of = {f: CODE_NAMES.get(DIMENSIONS.get(f) or ALIASES.get(f) or f) for f in kept}
    name = {f: quoted(n).cast("string") if n in df.columns else F.lit(None).cast("string") for f, n in of.items()}
    pairs = F.array(*[F.struct(F.lit(f).alias("field"), c.alias("value"), name[f].alias("name")) for f, c in kept.items()])
    rows = df.select(F.explode(pairs).alias("x"), obligation(df).alias("_obl")).select("x.*", "_obl").where("value IS NOT NULL")
    sums = _with_smallest(rows.groupBy("field", "value", "name").agg(F.sum("_obl").alias("o"), F.count("*").alias("n")), ["field", "value"], "name")
    sums = sums.select("field", "value", "name", F.round(F.coalesce("o", F.lit(0.0)), 2).alias("obligations"))
    # after the sketches a field has a bounded number of values
    sums = sums.withColumn("_values", F.count("*").over(Window.partitionBy("field"))).where(F.col("_values") <= most)
    order = Window.partitionBy("field").orderBy(F.desc("obligations"), "value")
    return sums.withColumn("rank", F.row_number().over(order)).select("field", "value", option_label(F.col("value"), F.col("name")).alias("label"), "obligations", "rank")


def live_options(df: DataFrame, field: str, labels: DataFrame | None = None, most: int = MOST_LIVE) -> DataFrame:
    """Distinct values of a field: (value, label, searchable). Coded ones by label, others by value.

    A field with more than `most` values, or one that the rows do not have, is one row without a value that says searchable.
    labels: rows (value, label) of a codebook.
    """
    none = F.lit(None).cast("string")
    if field not in df.columns:
        return df.sparkSession.range(1).select(none.alias("value"), none.alias("label"), F.lit(True).alias("searchable"))
    values = df.select(quoted(field).cast("string").alias("value")).where("value IS NOT NULL").distinct().limit(most + 1)
    # at most `most` + 1 rows from here on
    over = values.agg((F.count("*") > most).alias("searchable"))
    shown = over.join(values, ~F.col("searchable"), "left").where("searchable OR value IS NOT NULL")
    if labels is not None:
        shown = shown.join(F.broadcast(labels), "value", "left").withColumn("label", option_label(F.col("value"), F.col("label")))
        return shown.select("value", "label", "searchable").orderBy(F.asc_nulls_last("label"), "value")
    return shown.select("value", F.col("value").alias("label"), "searchable").orderBy("value")


def search(df: DataFrame, column: str, text: str, n: int = 200) -> DataFrame:
    """Rows whose column holds the text in any case, the first n by it."""
    return df.where(F.lower(quoted(column)).contains(text.lower())).orderBy(column).limit(n)


def zip_summary(df: DataFrame, spec: DatasetSpec) -> DataFrame:
    """Product, year, agency and ZIP: smallest state, obligations, transactions.

    Grouped with the state first, in hash tables; only those sums are sorted for a ZIP's smallest state.
    """
    rows = _slim(df, fiscal_year=quoted(YEAR), agency=F.col("awarding_agency_name"), zip=zip5(quoted(spec.zip_column)), state=F.col("recipient_state_code"))
    states = rows.groupBy("fiscal_year", "agency", "zip", "state").agg(F.sum("_obl").alias("o"), F.count("*").alias("n"))
    sums = _with_smallest(states, ["fiscal_year", "agency", "zip"], "state").select("fiscal_year", "agency", "zip", "state", F.round("o", 2).alias("obligations"), F.col("n").alias("transactions"))
    return sums.select(F.lit(spec.name).alias("product"), "*")


def zip_stats(summary: DataFrame) -> DataFrame:
    return summary.agg(F.count("*").alias("n_rows"), F.count_distinct("zip").alias("zips"), F.round(F.sum("obligations"), 2).alias("obligations"))


def coverage(df: DataFrame, agency: str | None = None) -> DataFrame:
    """Transactions and billions per fiscal year; of a raw table without its All slices."""
    rows = df if agency is None else df.where(F.col(agency) != "All")
    return rows.groupBy(quoted(YEAR).alias("fiscal_year")).agg(F.count("*").alias("transactions"), F.round(F.sum(obligation(df)) / 1e9, 2).alias("billions"))


def spend_series(df: DataFrame) -> DataFrame:
    return df.where(quoted(YEAR).isNotNull()).groupBy(quoted(YEAR).alias("fiscal_year")).agg(F.round(F.sum(obligation(df)) / 1e9, 6).alias("billions"))


def over_time(cube: DataFrame, by: str | None, metric: str, years: list[str], agency: str | None = None) -> DataFrame:
    """Years across, a total column, zeros for what is missing: of a timeseries cube, by agency, subagency or nothing."""
    rows = cube.where(F.col("fy").isin(years))
    if agency is not None:
        rows = rows.where(F.col("agency") == agency)
    rows = rows.withColumn("label", F.col(by) if by else F.lit("all"))
    wide = rows.groupBy("label").pivot("fy", years).agg(F.sum(metric)).na.fill(0)
    total = sum((F.col(f"`{y}`") for y in years[1:]), F.col(f"`{years[0]}`"))
    return wide.select("label", *[F.round(f"`{y}`", 2).alias(f"fy{y}") for y in years], F.round(total, 2).alias("total"))


def top_series(cube: DataFrame, by: str, metric: str, years: list[str], n: int = 8) -> DataFrame:
    """over_time of the n labels with the largest totals."""
    return over_time(cube, by, metric, years).orderBy(F.desc("total"), "label").limit(n)


def range_sum(whole: DataFrame, first: str, last: str) -> DataFrame:
    """Exact sums of a breakdown that is kept whole over a range of years."""
    rows = whole.where((F.col("period") != "all") & F.col("period").between(first, last))
    return rows.groupBy("label").agg(F.round(F.sum("obligations"), 2).alias("obligations"), F.sum("transactions").alias("transactions"))


def map_missing(whole: DataFrame, kpis: DataFrame, period: str) -> DataFrame:
    """The share of a period's obligations that has no place on the map, between 0 and 1; NULL if the total is 0."""
    mapped = whole.where(F.col("period") == period).agg(F.coalesce(F.sum("obligations"), F.lit(0.0)).alias("m"))
    total = kpis.where(F.col("period") == period).agg(F.sum("obligations").alias("t"))
    share = F.when(F.col("t") != 0, F.greatest(F.lit(0.0), F.least(F.lit(1.0), 1 - F.col("m") / F.col("t"))))
    return mapped.crossJoin(total).select(F.lit(period).alias("period"), F.round(share, 6).alias("missing"))


def headline(df: DataFrame) -> DataFrame:
    one = _slim(df).agg(F.round(F.sum("_obl"), 2).alias("obligations"), F.count("*").alias("transactions"))
    return one.withColumn("average", F.when(F.col("transactions") > 0, F.round(F.col("obligations") / F.col("transactions"), 4)))


def shown(breakdown_: DataFrame, period: str, metric: str, n: int = 15) -> DataFrame:
    """The n largest labels of a period by the chosen metric; of top lists, among those that made them by obligations."""
    return breakdown_.where(F.col("period") == period).orderBy(F.desc(metric), "label").limit(n).select("label", "obligations", "transactions")
