"""Seasoned terminal loans from a text export (T6): month-year dates, terms in words, rejects by reason.

All columns arrive as text.  A loan is kept if its issue month parses and is not after the
cut-off, its term is the wanted one and its status is terminal; otherwise it is a reject with
its first reason: ``date``, ``term`` (not parsed), ``other_term``, ``late``, ``status``.  A score
that does not parse is NULL and counted in ``malformed``; an empty or NULL cell is only NULL.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Month names, and the statuses of loans that have ended.
MONTHS = {"JAN": 1, "FEB": 2, "MAR": 3, "APR": 4, "MAY": 5, "JUN": 6, "JUL": 7, "AUG": 8, "SEP": 9, "OCT": 10, "NOV": 11, "DEC": 12}
ADVERSE = ("Charged Off", "Default")
BENIGN = ("Fully Paid",)
REASONS = ("date", "term", "other_term", "late", "status")


def month_year(text: Column) -> Column:
    """The first day of a month like ``Dec-2015``, in any case; NULL where it does not parse."""
    known = F.when(F.upper(text).rlike("^[A-Z]{3}-[0-9]{4}$"), F.upper(text))
    month = F.try_element_at(F.create_map(*[F.lit(x) for kv in MONTHS.items() for x in kv]), F.substring(known, 1, 3))
    year = F.substring(known, 5, 4).cast("int")
    return F.when(month.isNotNull() & (year > 0), F.make_date(year, month, F.lit(1)))


def months_of_term(text: Column) -> Column:
    """The first number in a term like `` 36 months``."""
    return F.regexp_extract(text, r"(\d+)", 1).try_cast("int")


def examined(raw: DataFrame, cutoff: dt.date, term: int = 36) -> DataFrame:
    """Adds issue_date, vintage, target, score_mean, malformed and ``reason`` (NULL for a kept loan)."""
    issued, months = month_year(F.col("issue_d")), months_of_term(F.col("term"))
    scores = [F.col(c) for c in ("fico_range_low", "fico_range_high")]
    parsed = [F.when(~F.isnan(s.try_cast("double")), s.try_cast("double")) for s in scores]
    bad = [(F.length(F.trim(s)) > 0) & p.isNull() for s, p in zip(scores, parsed)]
    reason = (F.when(F.col("issue_date").isNull(), "date").when(months.isNull(), "term").when(months != term, "other_term")
              .when(F.col("issue_date") > F.lit(cutoff), "late").when(~F.coalesce(F.col("loan_status").isin(*ADVERSE, *BENIGN), F.lit(False)), "status"))
    return raw.withColumn("issue_date", issued).withColumns({
        "vintage": F.year("issue_date"), "target": F.col("loan_status").isin(*ADVERSE).cast("int"), "score_mean": (parsed[0] + parsed[1]) / 2,
        "malformed": sum(F.coalesce(b, F.lit(False)).cast("int") for b in bad), "reason": reason})


def prepare(raw: DataFrame, cutoff: dt.date, term: int = 36) -> DataFrame:
    """(id, vintage, score_mean, malformed, target) of the kept loans."""
    return examined(raw, cutoff, term).filter("reason is null").select("id", "vintage", "score_mean", "malformed", "target")


def rejects(raw: DataFrame, cutoff: dt.date, term: int = 36) -> DataFrame:
    """(reason, loans): how many were left out and why."""
    return examined(raw, cutoff, term).filter("reason is not null").groupBy("reason").agg(F.count(F.lit(1)).alias("loans"))
