"""Typed getters on a parsed JSON message (a VARIANT column), with the reference's acceptance rules.

A message is parsed once with ``try_parse_json``, which says whether it is JSON at all; :func:`extract` then pulls all
needed fields out at once, as variants with their JSON type (``schema_of_variant``). The getters check that type, so
``"symbol": 123`` is not a symbol and ``"last": true`` is not a price. Texts of strings, whole numbers and booleans come
from ``from_json``: a cast of a variant builds a new cast expression for every value, which costs several times as much as
reading the message a second time. All of it stays in JVM expressions; keeping the steps in separate projections stops
the optimizer from re-parsing the message per getter.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..schema import PRICE

# The strict ISO-8601 instant form accepted by the reference's instant parser
INSTANT_PATTERN = r"^-?\d{4}-\d{2}-\d{2}[Tt]\d{2}:\d{2}:\d{2}(\.\d{1,9})?([Zz]|[+-]\d{2}:\d{2})$"

WHOLE_TYPES = ("TINYINT", "SMALLINT", "INT", "BIGINT")
NUMERIC_TYPES = (*WHOLE_TYPES, "FLOAT", "DOUBLE")

VARIANT = "_v"


def parse(df: DataFrame, value: str = "value") -> DataFrame:
    """Adds ``_v`` (VARIANT, null when the text is not JSON)."""
    return df.withColumn(VARIANT, F.try_parse_json(F.col(value)))


def extract(df: DataFrame, names: Iterable[str], value: str = "value") -> DataFrame:
    """Adds ``_f_<name>`` (the field as a variant), ``_t_<name>`` (its JSON type, null when absent) and ``_s_<name>`` (its
    text, of use where the type is a string, a whole number or a boolean) for every name, plus ``_is_object``. Needs
    :func:`parse` first."""
    names = list(names)
    struct = lambda kind: f"struct<{', '.join(f'`{n}`: {kind}' for n in names)}>"
    out = df.select("*", F.try_variant_get(F.col(VARIANT), "$", struct("variant")).alias("_f"),
                    F.from_json(F.col(value), struct("string")).alias("_s"))
    return out.select(
        *df.columns, F.col("_f").isNotNull().alias("_is_object"),
        *[F.col("_f")[n].alias(f"_f_{n}") for n in names], *[F.col("_s")[n].alias(f"_s_{n}") for n in names],
        *[F.schema_of_variant(F.col("_f")[n]).alias(f"_t_{n}") for n in names])


def drop_extracted(df: DataFrame) -> DataFrame:
    return df.drop(*[c for c in df.columns if c.startswith(("_f_", "_s_", "_t_"))], "_is_object", VARIANT)


def _f(name: str) -> Column:
    return F.col(f"_f_{name}")


def _t(name: str) -> Column:
    return F.col(f"_t_{name}")


def _text(name: str) -> Column:
    return F.col(f"_s_{name}")


def _is_number(name: str) -> Column:
    t = _t(name)
    return t.isin(*NUMERIC_TYPES) | t.startswith("DECIMAL")


def string_field(name: str, allow_empty: bool = False) -> Column:
    """A JSON string (numbers are not strings); the tick parser also rejects ``""``."""
    ok = _t(name) == "STRING"
    if not allow_empty:
        ok = ok & (_text(name) != "")
    return F.when(ok, _text(name))


def decimal_field(name: str) -> Column:
    """A JSON number, or a non-empty string holding a number; anything else is missing."""
    return (
        F.when(_is_number(name), F.try_variant_get(_f(name), "$", PRICE.simpleString()))
        .when((_t(name) == "STRING") & (_text(name) != ""), _text(name).try_cast(PRICE))
    )


def instant_us(name: str) -> Column:
    """Epoch micros of a strict ISO instant string (zone required), else null."""
    s = string_field(name)
    return F.when(s.rlike(INSTANT_PATTERN), F.unix_micros(F.upper(s).try_cast("timestamp")))


def string_or_number_field(name: str) -> Column:
    """A string as it is (empty allowed) or a number as its decimal text."""
    return F.when(_t(name) == "STRING", _text(name)).when(_is_number(name), F.try_variant_get(_f(name), "$", "string"))


def long_field(name: str) -> Column:
    """A number (truncated) or a string holding a whole number."""
    return (
        F.when(_t(name).isin(*WHOLE_TYPES), _text(name).try_cast("double").cast("long"))
        .when(_is_number(name), F.try_variant_get(_f(name), "$", "double").cast("long"))
        .when(_t(name) == "STRING", _text(name).try_cast("bigint"))
    )


def boolean_field(name: str) -> Column:
    return F.when(_t(name) == "BOOLEAN", _text(name) == "true")


def settle(df: DataFrame) -> DataFrame:
    """Evaluate every column of ``df`` once before anything downstream sees it.

    A filter on a derived column is pushed below the projections that define it, with each definition inlined
    at each reference; for parsed JSON that means re-parsing the message for every field a filter touches. A
    one-row ``inline`` (a Generate) is the boundary such filters stop at.
    """
    return df.select(F.inline(F.array(F.struct(*[F.col(c) for c in df.columns]))))
