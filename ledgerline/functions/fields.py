"""Datasets, dimensions, metrics and the scalar expressions of award transactions."""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.functions.casting import as_date, as_double, quoted, try_double

# Dimension keys and their columns; coded ones have labels in the codebook.
DIMENSIONS = {
    "fiscal_year": "action_date_fiscal_year",
    "month": "action_date",
    "awarding_agency": "awarding_agency_name",
    "awarding_subagency": "awarding_sub_agency_name",
    "funding_agency": "funding_agency_name",
    "funding_subagency": "funding_sub_agency_name",
    "recipient": "recipient_name",
    "recipient_parent": "recipient_parent_name",
    "state": "recipient_state_code",
    "county": "recipient_county_name",
    "naics": "naics_code",
    "naics_desc": "naics_description",
    "psc": "product_or_service_code",
    "psc_desc": "product_or_service_code_description",
    "award_type": "award_type_code",
    "extent_competed": "extent_competed",
    "set_aside": "type_of_set_aside",
    "pricing": "type_of_contract_pricing",
    "business_size": "contracting_officers_determination_of_business_size",
}
CODED = {"award_type", "extent_competed", "set_aside", "pricing"}
ALIASES = {"funding_subagency_code": "funding_sub_agency_code", "awarding_subagency_code": "awarding_sub_agency_code", "naics_code": "naics_code", "psc_code": "product_or_service_code"}
DATE_FIELDS = ["action_date", "period_of_performance_start_date", "period_of_performance_current_end_date", "last_modified_date"]
# Postal codes and names of states and territories.
STATE_NAMES = {
    "AL": "Alabama",
    "AK": "Alaska",
    "AZ": "Arizona",
    "AR": "Arkansas",
    "CA": "California",
    "CO": "Colorado",
    "CT": "Connecticut",
    "DE": "Delaware",
    "DC": "District of Columbia",
    "FL": "Florida",
    "GA": "Georgia",
    "HI": "Hawaii",
    "ID": "Idaho",
    "IL": "Illinois",
    "IN": "Indiana",
    "IA": "Iowa",
    "KS": "Kansas",
    "KY": "Kentucky",
    "LA": "Louisiana",
    "ME": "Maine",
    "MD": "Maryland",
    "MA": "Massachusetts",
    "MI": "Michigan",
    "MN": "Minnesota",
    "MS": "Mississippi",
    "MO": "Missouri",
    "MT": "Montana",
    "NE": "Nebraska",
    "NV": "Nevada",
    "NH": "New Hampshire",
    "NJ": "New Jersey",
    "NM": "New Mexico",
    "NY": "New York",
    "NC": "North Carolina",
    "ND": "North Dakota",
    "OH": "Ohio",
    "OK": "Oklahoma",
    "OR": "Oregon",
    "PA": "Pennsylvania",
    "RI": "Rhode Island",
    "SC": "South Carolina",
    "SD": "South Dakota",
    "TN": "Tennessee",
    "TX": "Texas",
    "UT": "Utah",
    "VT": "Vermont",
    "VA": "Virginia",
    "WA": "Washington",
    "WV": "West Virginia",
    "WI": "Wisconsin",
    "WY": "Wyoming",
    "PR": "Puerto Rico",
    "GU": "Guam",
    "VI": "U.S. Virgin Islands",
    "AS": "American Samoa",
    "MP": "Northern Mariana Islands",
}


@dataclass(frozen=True)
class DatasetSpec:
    """What differs between the products. Breakdown dimensions: key, then column, then whether it is kept whole."""

    name: str
    award_key: str
    transaction_key: str
    zip_column: str
    detail: tuple[str, ...]
    breakdowns: dict[str, tuple[str, bool]]


# Keys, columns of the detail extract and breakdown dimensions of the products.
_COMMON = {
    "awarding_agency": ("awarding_agency_name", False),
    "awarding_subagency": ("awarding_sub_agency_name", False),
    "recipient": ("recipient_name", False),
    "recipient_parent": ("recipient_parent_name", False),
    "state": ("recipient_state_code", True),
    "county": ("prime_award_transaction_recipient_county_fips_code", True),
}
CONTRACTS = DatasetSpec(
    "contracts",
    "contract_award_unique_key",
    "contract_transaction_unique_key",
    "recipient_zip_4_code",
    (
        "award_id_piid",
        "recipient_name",
        "recipient_uei",
        "awarding_agency_name",
        "funding_sub_agency_name",
        "action_date",
        "federal_action_obligation",
        "naics_code",
        "product_or_service_code",
        "extent_competed",
        "recipient_state_code",
        "recipient_county_name",
        "award_type_code",
    ),
    _COMMON
    | {
        "zip": ("recipient_zip_4_code", False),
        "naics": ("naics_description", False),
        "psc": ("product_or_service_code_description", False),
        "competition": ("extent_competed", True),
        "set_aside": ("type_of_set_aside", True),
        "business_size": ("contracting_officers_determination_of_business_size", True),
    },
)
ASSISTANCE = DatasetSpec(
    "assistance",
    "assistance_award_unique_key",
    "assistance_transaction_unique_key",
    "recipient_zip_code",
    (
        "award_id_fain",
        "recipient_name",
        "recipient_uei",
        "awarding_agency_name",
        "funding_sub_agency_name",
        "action_date",
        "federal_action_obligation",
        "cfda_number",
        "assistance_type_code",
        "recipient_state_code",
        "recipient_county_name",
    ),
    _COMMON | {"zip": ("recipient_zip_code", False), "assistance_type": ("assistance_type_code", True), "cfda": ("cfda_number", False)},
)
DATASETS = {d.name: d for d in (CONTRACTS, ASSISTANCE)}


def dataset(name: str) -> DatasetSpec:
    if name not in DATASETS:
        raise ValueError(f"unknown dataset: {name!r}")
    return DATASETS[name]


def obligation(df: DataFrame) -> Column:
    return as_double(df, "federal_action_obligation")


def vendor() -> Column:
    """The vendor id, blank as NULL."""
    return F.nullif(F.trim(F.col("recipient_uei")), F.lit(""))


def month(df: DataFrame, name: str = "action_date") -> Column:
    return F.date_format(as_date(df, name), "yyyy-MM")


def zip5(c: Column) -> Column:
    return F.nullif(F.substring(c, 1, 5), F.lit(""))


def county_fips(c: Column) -> Column:
    """Five digits whose county part is a county; else NULL."""
    return F.when(c.rlike(r"\A[0-9]{5}\z") & ~F.substring(c, 3, 3).isin("000", "999"), c)


def slug(c: Column) -> Column:
    """Lower case with single hyphens; `unknown` if nothing is left."""
    return F.coalesce(F.nullif(F.regexp_replace(F.regexp_replace(F.lower(c), "[^a-z0-9]+", "-"), r"^-+|-+\z", ""), F.lit("")), F.lit("unknown"))


def title(c: Column) -> Column:
    """Each run of letters capitalised: O'BRIEN as O'Brien."""
    marked = F.regexp_replace(c, r"([^\p{L}\s])", "$1\u0001 ")
    return F.regexp_replace(F.initcap(marked), "\u0001 ", "")


def county_label(name: Column, state: Column) -> Column:
    """`Name, ST`; one of both if the other is missing; NULL if both are."""
    n, s = F.nullif(F.trim(name), F.lit("")), F.nullif(F.trim(state), F.lit(""))
    return F.nullif(F.concat_ws(", ", title(n), s), F.lit(""))


def or_unknown(c: Column) -> Column:
    return F.coalesce(F.nullif(c, F.lit("")), F.lit("(unknown)"))


def option_label(value: Column, label: Column) -> Column:
    """`label (value)`, or the value alone."""
    return F.when(label.isNotNull() & (label != ""), F.concat(label, F.lit(" ("), value, F.lit(")"))).otherwise(value)


def logical_id(product: Column, year: Column, agency: Column) -> Column:
    return F.concat_ws("/", F.lower(product), year, agency)


def id_parts(c: Column) -> list[Column]:
    """product, fiscal_year and agency of a logical id."""
    parts = F.split(c, "/")
    return [F.get(parts, i).alias(n) for i, n in enumerate(("product", "fiscal_year", "agency"))]


def fiscal_year(c: Column) -> Column:
    """The federal fiscal year of a date: October starts the next."""
    return (F.year(c) + F.when(F.month(c) >= 10, 1).otherwise(0)).cast("string")


def nan_to_null(c: Column) -> Column:
    return F.when(~F.isnan(c), c)


def change(a: Column, b: Column) -> tuple[Column, Column]:
    """b - a, and that in percent of a to one decimal; NULL if a side is missing or a is 0."""
    return b - a, F.when(a != 0, F.round((b - a) / a * 100, 1))


def state_names(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(sorted(STATE_NAMES.items()), "state_code string, state_name string")


def with_state_name(df: DataFrame, code: str, out: str) -> DataFrame:
    """Adds the state's full name, or the code where it has none."""
    names = state_names(df.sparkSession).withColumnsRenamed({"state_code": code, "state_name": "_name"})
    return df.join(F.broadcast(names), code, "left").withColumn(out, F.coalesce("_name", code)).drop("_name")


def resolve(df: DataFrame, field: str) -> Column | None:
    """The column of a dimension, an alias or a plain column name; None for anything else."""
    if field == "month":
        return month(df)
    name = DIMENSIONS.get(field) or ALIASES.get(field) or (field if re.fullmatch(r"[a-z0-9_]{1,80}", field) else None)
    return None if name is None else quoted(name)


def date_field(field: str | None) -> str:
    return field if field in DATE_FIELDS else "action_date"


def filters(df: DataFrame, wanted: dict[str, str]) -> list[Column]:
    """Conditions of request filters: `field: a|b` is one of, `field_min` and `field_max` are inclusive bounds.

    Empty items do not count, fields that cannot be resolved or are not there are left out, values are compared as text.
    """
    out = []
    for key, value in wanted.items():
        bound = re.fullmatch(r"(.+)_(min|max)", key)
        field = bound[1] if bound else key
        c = resolve(df, field)
        if c is None or (field != "month" and (DIMENSIONS.get(field) or ALIASES.get(field) or field) not in df.columns):
            continue
        if bound:
            try:
                limit = float(value)
            except ValueError:
                out.append(F.lit(False))
                continue
            number = try_double(c)
            out.append(number >= limit if bound[2] == "min" else number <= limit)
        elif items := [x for x in value.split("|") if x]:
            out.append(c.cast("string").isin(*items))
    return out


def period_mask(df: DataFrame, period: tuple[str, str] | None, field: str | None = None) -> Column:
    """Whether the date lies in the period, ends included; always if there is none. Other spellings than YYYY-MM-DD are errors."""
    if period is None:
        return F.lit(True)
    if not all(re.fullmatch(r"\d{4}-\d{2}-\d{2}", x) for x in period):
        raise ValueError(f"not a period of dates: {period!r}")
    return F.coalesce(as_date(df, date_field(field)).between(*[F.lit(x).cast("date") for x in period]), F.lit(False))
