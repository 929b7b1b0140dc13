"""The layered result set by name, over stored or in-memory warehouse tables."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame

from tidemark.operators import asof, clean, daily
from tidemark.plans import features
from tidemark.specs import Params


def layers(tables: Mapping[str, DataFrame], params: Params = Params(),
           tiebreak: Sequence[str] = ("known_at",)) -> dict[str, DataFrame]:
    """Every layer from the four raw tables; nothing runs until a result is used.

    ``tiebreak`` settles rows of one interval and feed.
    """
    offset = params.day_offset_minutes
    price = clean.price_final(tables["dispatchprice"], tiebreak, day_offset_minutes=offset)
    state = clean.regionsum_final(tables["dispatchregionsum"], tiebreak, day_offset_minutes=offset)
    forecast = clean.forecast(tables["predispatchprice"], tables["predispatchregionsum"],
                              params.day_offset_minutes)
    outcome = daily.daily_outcome(price, params.threshold, params.expected_intervals, params.exact_intervals)
    out = {
        "v_price_final": price,
        "v_regionsum_final": state,
        "v_forecast": forecast,
        "v_daily_outcome": outcome,
        "v_daily_state": daily.daily_state(state),
        "v_persistence": daily.persistence(outcome, params.rolling_rows),
        "features": features.build_features(price, state, forecast, params),
    }
    for prefix, hours in params.cutoff_hours.items():
        out[f"v_forecast_{hours:02d}00"] = asof.snapshot(
            forecast, prefix, hours, params.min_periods, params.threshold)
    return out


def register(tables: Mapping[str, DataFrame], params: Params = Params(),
             tiebreak: Sequence[str] = ("known_at",)) -> list[str]:
    """The layers as temporary views for SQL users."""
    named = layers(tables, params, tiebreak)
    for name, df in named.items():
        df.createOrReplaceTempView(name)
    return sorted(named)


def materialise(features_df: DataFrame, path: str) -> None:
    """Store the feature table, sorted by region and day within files."""
    (features_df.hint("rebalance", "regionid").sortWithinPartitions("regionid", "trading_day")
     .write.mode("overwrite").parquet(path))
