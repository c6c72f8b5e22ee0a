"""Quality checks: one aggregate over the table answers all of them."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quotelake.functions import lag_minutes
from quotelake.schemas import REQUIRED_COLUMNS

# Texts of the reasons a table is not published for.
BAD_PRICE = "price_usd_null_or_non_positive"
NAN_PRICE = "price_usd_nan"
NO_EVENT_TIME = "no_event_time_ts_found"


class QualityError(RuntimeError):
    """A table failed its checks; ``reasons`` says which."""

    def __init__(self, reasons: list[str]):
        super().__init__(f"quality checks failed: {reasons}")
        self.reasons = reasons


def missing_columns(quotes: DataFrame) -> list[str]:
    """Required columns the table lacks; looks at the schema only."""
    present = set(quotes.columns)
    return [c for c in REQUIRED_COLUMNS if c not in present]


def _row_checks(reject_nan: bool) -> dict[str, Column]:
    """Name of each check and the condition a bad row meets, in report order."""
    price = F.col("price_usd")
    checks = {f"null_{c}": F.col(c).isNull() for c in REQUIRED_COLUMNS}
    checks[BAD_PRICE] = price.isNull() | (price <= 0)
    if reject_nan:
        checks[NAN_PRICE] = F.isnan(price)
    return checks


def quality_metrics(reject_nan: bool = False) -> list[Column]:
    """Aggregates behind ``quality_summary``, to take as rows pass by."""
    counts = [F.count_if(bad).alias(name) for name, bad in _row_checks(reject_nan).items()]
    return [*counts, F.max("event_time_ts").alias("newest_event_time")]


def sum_metrics(parts: Sequence[Mapping[str, object]]) -> dict[str, object]:
    """``quality_metrics`` of several parts of a table as those of the whole."""
    names = [name for name in parts[0] if name != "newest_event_time"]
    total: dict[str, object] = {name: sum(part[name] for part in parts) for name in names}
    newest = [part["newest_event_time"] for part in parts]
    total["newest_event_time"] = max((time for time in newest if time is not None), default=None)
    return total


# A day's part of the checks, as it is stored.
CHECK_STATE_SCHEMA = ", ".join(
    [
        "dt date",
        "checked_rows long",
        *[f"null_{c} long" for c in REQUIRED_COLUMNS],
        f"{BAD_PRICE} long",
        f"{NAN_PRICE} long",
        "newest_event_time timestamp",
    ]
)


def check_states(quotes: DataFrame) -> DataFrame:
    """One row a day: its rows, the bad ones by check, its newest event time."""
    return quotes.groupBy("dt").agg(F.count("*").alias("checked_rows"), *quality_metrics(reject_nan=True))


def merge_states(states: DataFrame, more: DataFrame) -> DataFrame:
    """The states of two sets of rows without a common one as those of both."""
    both = states.unionByName(more.select(*states.columns))
    counts = [c for c in states.columns if c not in ("dt", "newest_event_time")]
    return both.groupBy("dt").agg(*[F.sum(c).alias(c) for c in counts], F.max("newest_event_time").alias("newest_event_time"))


def states_summary(states: DataFrame, *, as_of: Column | None = None, reject_nan: bool = False) -> DataFrame:
    """``quality_summary`` of the rows that the states are of."""
    names = list(_row_checks(reject_nan))
    counts = [F.coalesce(F.sum(n), F.lit(0)).alias(n) for n in names]
    return _freshness(states, counts, as_of, "newest_event_time")


def quality_summary(
    quotes: DataFrame, *, as_of: Column | None = None, reject_nan: bool = False
) -> DataFrame:
    """One row: bad rows per check, newest event time, and its age in minutes."""
    counts = [F.count_if(bad).alias(name) for name, bad in _row_checks(reject_nan).items()]
    return _freshness(quotes, counts, as_of)


def freshness(quotes: DataFrame, *, as_of: Column | None = None) -> DataFrame:
    """One row: newest event time and its age in minutes."""
    return _freshness(quotes, [], as_of)


def _freshness(
    quotes: DataFrame, more: list[Column], as_of: Column | None, time: str = "event_time_ts"
) -> DataFrame:
    as_of = F.current_timestamp() if as_of is None else as_of
    return quotes.agg(*more, F.max(time).alias("newest_event_time")).withColumn(
        "lag_minutes", lag_minutes(F.col("newest_event_time"), as_of)
    )


def quality_report(
    quotes: DataFrame, *, as_of: Column | None = None, reject_nan: bool = False
) -> DataFrame:
    """``quality_summary`` as rows of ``check_name`` and ``bad_rows``."""
    names = list(_row_checks(reject_nan))
    summary = quality_summary(quotes, as_of=as_of, reject_nan=reject_nan)
    pairs = F.array(
        *[
            F.struct(F.lit(n).alias("check_name"), F.col(n).alias("bad_rows"))
            for n in names
        ]
    )
    return summary.select(F.inline(pairs))


def quality_failures(
    summary: Mapping[str, object], max_lag_minutes: float | None = None
) -> list[str]:
    """Reason texts for a row of ``quality_summary``; none when all is well."""
    checks = [n for n in summary if n not in ("newest_event_time", "lag_minutes")]
    reasons = [n for n in checks if summary[n]]
    if max_lag_minutes is None:
        return reasons
    lag = summary["lag_minutes"]
    if lag is None:
        reasons.append(NO_EVENT_TIME)
    elif lag > max_lag_minutes:
        reasons.append(f"freshness_lag_minutes={lag:.1f}")
    return reasons
