"""Deduplicated quotes and daily metrics kept up to date by what changes.

The winners are the deduplicated quotes with their lineage, one row for each coin and
event time. New rows are ranked against the winners of their keys: a new row that wins
is added, the one it displaces is retracted. Counts and sums of a day follow by addition
and subtraction, in decimals, so that no order of corrections changes a digit. A least,
greatest or last price that is retracted and not equalled by an added one cannot be told
from the old value; only such coin-days are read again, from the winners.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from quotelake.operators.latest import ranking_order
from quotelake.schemas import DAILY_KEYS, GOLD_DAILY_SCHEMA, SILVER_SCHEMA

QUOTE_KEYS = ("event_time_ts", "coin_id", "dt")
# Sums hold prices to 18 places; one that is too large, infinite or no number is odd.
SUM_TYPE = "decimal(38,18)"
PRICE_TYPE = "decimal(28,18)"

# What is known of a coin-day: enough to add and to retract quotes.
STATE_SCHEMA = (
    "dt date, coin_id string, symbol string, name string, vs_currency string, quotes long, "
    f"odd_prices long, odd_average double, price_sum {SUM_TYPE}, min_price_usd double, max_price_usd double, "
    "max_market_cap_usd double, max_total_volume_usd double, last_time timestamp, last_price_usd double"
)
_STATE = [column.split()[0] for column in STATE_SCHEMA.split(", ")]


def coin_bucket(buckets: int) -> Column:
    """The folder of a coin below its day: a new quote rewrites only that folder."""
    return F.pmod(F.xxhash64("coin_id"), F.lit(buckets)).cast("int")


def rank_changes(winners: DataFrame, quotes: DataFrame) -> DataFrame:
    """Winners and the best new quote of each key, with ``is_new`` and ``place``.

    ``winners`` has one row a key; the result has two at most, ranked as
    ``dedup_quotes`` ranks. A row that is there already, or an equal one, changes nothing.
    """
    names = SILVER_SCHEMA.fieldNames()
    order = ranking_order(names, QUOTE_KEYS, ("last_updated_ts",))
    best = W.partitionBy(*QUOTE_KEYS).orderBy(*order)
    new = quotes.select(*names).withColumn("place", F.row_number().over(best)).where("place = 1").drop("place")
    rows = winners.select(*names, F.lit(False).alias("is_new")).unionByName(new.withColumn("is_new", F.lit(True)))
    # Of equal rows the old one wins.
    last = W.partitionBy(*QUOTE_KEYS).orderBy(*order, F.asc("is_new"))
    return rows.withColumn("place", F.row_number().over(last))


def added(ranked: DataFrame) -> DataFrame:
    return ranked.where("is_new AND place = 1")


def retracted(ranked: DataFrame) -> DataFrame:
    return ranked.where("NOT is_new AND place = 2")


def _decimal(price: str) -> Column:
    return F.col(price).try_cast(PRICE_TYPE)


def daily_state(quotes: DataFrame) -> DataFrame:
    """``STATE_SCHEMA`` of deduplicated quotes."""
    average = F.when(F.count_if(_odd()) > 0, F.avg("price_usd")).alias("odd_average")
    return quotes.groupBy(*DAILY_KEYS).agg(*_sums(), average, *_extremes()).select(*_STATE)


def _odd() -> Column:
    return F.col("price_usd").isNotNull() & _decimal("price_usd").isNull()


def _sums(when: Column | None = None, prefix: str = "") -> list[Column]:
    when = F.lit(True) if when is None else when
    sums = F.sum(F.when(when, F.coalesce(_decimal("price_usd"), F.lit(0)))).cast(SUM_TYPE)
    return [
        F.count_if(when).alias(f"{prefix}quotes"),
        F.count_if(when & _odd()).alias(f"{prefix}odd_prices"),
        F.coalesce(sums, F.lit(0).cast(SUM_TYPE)).alias(f"{prefix}price_sum"),
    ]


def _extremes(when: Column | None = None, prefix: str = "") -> list[Column]:
    def of(name: str) -> Column:
        return F.col(name) if when is None else F.when(when, F.col(name))

    return [
        F.min(of("price_usd")).alias(f"{prefix}min_price_usd"),
        F.max(of("price_usd")).alias(f"{prefix}max_price_usd"),
        F.max(of("market_cap_usd")).alias(f"{prefix}max_market_cap_usd"),
        F.max(of("total_volume_usd")).alias(f"{prefix}max_total_volume_usd"),
        F.max(of("event_time_ts")).alias(f"{prefix}last_time"),
        F.max_by("price_usd", of("event_time_ts")).alias(f"{prefix}last_price_usd"),
    ]


def daily_changes(ranked: DataFrame) -> DataFrame:
    """For each coin-day that changes, what is added (``add_``) and retracted (``del_``)."""
    gone = ~F.col("is_new")
    changed = ranked.where("(is_new AND place = 1) OR (NOT is_new AND place = 2)")
    sides = [(F.col("is_new"), "add_"), (gone, "del_")]
    return changed.groupBy(*DAILY_KEYS).agg(*[c for side in sides for c in (*_sums(*side), *_extremes(*side))])


def _left(name: str, least: bool = False) -> Column:
    """The old extreme is retracted, and nothing added is as far out."""
    old, new, out = F.col(name), F.col(f"add_{name}"), F.col(f"del_{name}")
    reached = out <= old if least else out >= old
    held = new <= old if least else new >= old
    return F.coalesce(reached, F.lit(False)) & ~F.coalesce(held, F.lit(False))


def merge_state(state: DataFrame, changes: DataFrame, winners: DataFrame) -> DataFrame:
    """The state after the changes, of all coin-days in ``state`` or ``changes``.

    ``winners`` are the new winners of all keys that share a coin-day with a change;
    only coin-days that lost an extreme are read from them.
    """
    keys = list(DAILY_KEYS)
    both = state.join(changes.withColumn("changed", F.lit(True)), keys, "full")
    number = {name: F.coalesce(name, F.lit(0)) for name in ("quotes", "odd_prices", "price_sum")}
    number |= {f"{side}{name}": F.coalesce(f"{side}{name}", F.lit(0)) for name in list(number) for side in ("add_", "del_")}
    both = both.withColumns(number)
    least, most = ("min_price_usd",), ("max_price_usd", "max_market_cap_usd", "max_total_volume_usd", "last_time")
    again = F.lit(False)
    for name in (*least, *most):
        again = again | _left(name, least=name in least)
    # Odd prices are in no sum.
    again = again | (F.col("odd_prices") + F.col("add_odd_prices") + F.col("del_odd_prices") > 0)
    again = again & F.coalesce("changed", F.lit(False))
    merged = {
        **{name: (F.col(name) + F.col(f"add_{name}") - F.col(f"del_{name}")) for name in ("quotes", "odd_prices")},
        "price_sum": (F.col("price_sum") + F.col("add_price_sum") - F.col("del_price_sum")).cast(SUM_TYPE),
        **{name: F.least(name, f"add_{name}") for name in least},
        **{name: F.greatest(name, f"add_{name}") for name in most},
        "last_price_usd": F.when(F.col("last_time") > F.col("add_last_time"), F.col("last_price_usd")).otherwise(
            F.coalesce("add_last_price_usd", "last_price_usd")
        ),
    }
    both = both.withColumn("again", again).withColumns(merged).where("quotes > 0")
    kept = both.where("NOT again").select(*_STATE)
    lost = both.where("again").select(*keys)
    return kept.unionByName(daily_state(winners.join(lost, keys, "left_semi")))


def state_metrics(state: DataFrame) -> DataFrame:
    """The published daily metrics of a state."""
    average = F.coalesce("odd_average", F.col("price_sum").cast("double") / F.col("quotes"))
    return state.withColumn("avg_price_usd", average).select(*GOLD_DAILY_SCHEMA.fieldNames())
