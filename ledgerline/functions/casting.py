"""Column types by name, and casts that give NULL where a value does not fit.

Guards keep the accepted spellings to dates like 2024-01-31 or 2024/1/31 with an optional time, and to plain numbers:
Spark alone would also take `2024`, `12d` or `0x1p3`.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Parts of column names that hold money.
MONEY = ["obligation", "_amount", "value_of_award", "outlayed_amount", "_outlay", "total_dollars", "face_value", "subsidy", "_funding_amount", "indirect_cost", "pragmatic_obligations"]

_DATE = r"^\s*[0-9]{4}([-/])[0-9]{1,2}\1[0-9]{1,2}\s*(?:[0-9]{2}:[0-9]{2}(?::[0-9]{2}.*)?)?\z"
_NOT_NUMBER = r"(?i)^\s*[+-]?[0-9.]+(e[+-]?[0-9]+)?[df]\s*$|0x"


def quoted(name: str) -> Column:
    """The column of exactly this name, whatever characters it has."""
    return F.col("`" + name.replace("`", "``") + "`")


#: Types by name: of the patterns that fit a name, the first one decides.
TYPE_RULES = (
    (r"_fiscal_year\Z", "string"),
    (r"_date\Z", "date"),
    (r"_(code|name|description)\Z", "string"),
    ("|".join(MONEY), "double"),
    ("", "string"),
)


def try_date(c: Column) -> Column:
    """A date, or NULL for what is none; dates and timestamps pass."""
    text = c.cast("string")
    return F.when(text.rlike(_DATE), F.substring_index(F.trim(F.translate(text, "/", "-")), " ", 1).try_cast("date"))


def try_double(c: Column) -> Column:
    """A double, or NULL for what is none; numbers pass."""
    text = c.cast("string")
    return F.when(~text.rlike(_NOT_NUMBER), F.regexp_replace(text, "(?<=[0-9])_(?=[0-9])", "").try_cast("double"))


def as_date(df: DataFrame, name: str) -> Column:
    """try_date where the column is text; the column itself where it is a date already."""
    return quoted(name) if df.schema[name].dataType.typeName() == "date" else try_date(quoted(name))


def as_double(df: DataFrame, name: str) -> Column:
    return quoted(name) if df.schema[name].dataType.typeName() == "double" else try_double(quoted(name))


def typed(df: DataFrame) -> DataFrame:
    """Every column in the type of its name, values that do not fit as NULL."""
    casts = {"string": lambda c: c.cast("string"), "date": try_date, "double": try_double}
    types = {c: next(kind for pattern, kind in TYPE_RULES if re.search(pattern, c)) for c in df.columns}
    return df.select(*[casts[kind](quoted(c)).alias(c) for c, kind in types.items()])
