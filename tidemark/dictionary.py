"""Data dictionary rows: (table, column, timing, unit, description).

Fixed values: table, column, timing and unit.  Timing says when a value exists:
``key`` identifies the row, ``input`` precedes the price solve, ``output`` comes from it (use
lagged only), ``forecast`` is published ahead, ``meta`` is provenance; in the feature table
``target``, ``outcome`` (never a feature) and ``feature``.  Table ``*`` means every raw table.
"""

ROWS = (
    # columns shared by the raw tables
    ("*", "regionid", "key", "", "Market region code."),
    ("*", "intervention", "key", "", "0 pricing run, 1 physical run of an intervened interval."),
    ("*", "source", "meta", "", "Feed the row arrived through."),
    ("*", "known_at", "meta", "timestamp", "Moment the value became available."),
    ("*", "known_at_kind", "meta", "", "Whether known_at was estimated or read from a file name."),
    ("*", "ingested_at", "meta", "timestamp", "Moment the row was stored."),
    ("*", "source_file", "meta", "", "File the row was read from."),
    ("*", "vintage", "key", "", "Forecast run identifier common to all feeds."),
    # dispatchprice
    ("dispatchprice", "settlementdate", "key", "timestamp", "End of the five-minute interval, market time."),
    ("dispatchprice", "rrp", "output", "$/MWh", "Regional price of the interval; the target derives from it."),
    ("dispatchprice", "price_status", "output", "", "Whether the price can still be revised."),
    ("dispatchprice", "apcflag", "output", "", "An administered cap set the price."),
    ("dispatchprice", "marketsuspendedflag", "output", "", "The market was suspended."),
    ("dispatchprice", "raise6secrrp", "output", "$/MWh", "Reserve price, raise within 6 seconds."),
    ("dispatchprice", "raise60secrrp", "output", "$/MWh", "Reserve price, raise held to 60 seconds."),
    ("dispatchprice", "raise5minrrp", "output", "$/MWh", "Reserve price, raise held to 5 minutes."),
    ("dispatchprice", "raiseregrrp", "output", "$/MWh", "Regulation price, upward."),
    ("dispatchprice", "raise1secrrp", "output", "$/MWh", "Reserve price, raise within 1 second."),
    ("dispatchprice", "lower6secrrp", "output", "$/MWh", "Reserve price, lower within 6 seconds."),
    ("dispatchprice", "lower60secrrp", "output", "$/MWh", "Reserve price, lower held to 60 seconds."),
    ("dispatchprice", "lower5minrrp", "output", "$/MWh", "Reserve price, lower held to 5 minutes."),
    ("dispatchprice", "lowerregrrp", "output", "$/MWh", "Regulation price, downward."),
    ("dispatchprice", "lower1secrrp", "output", "$/MWh", "Reserve price, lower within 1 second."),
    # dispatchregionsum
    ("dispatchregionsum", "settlementdate", "key", "timestamp", "End of the interval."),
    ("dispatchregionsum", "totaldemand", "output", "MW", "Demand served by the grid."),
    ("dispatchregionsum", "availablegeneration", "input", "MW", "Generation offered at any price."),
    ("dispatchregionsum", "availableload", "input", "MW", "Flexible load offered."),
    ("dispatchregionsum", "demandforecast", "output", "MW", "Expected change of demand, not a level."),
    ("dispatchregionsum", "dispatchablegeneration", "output", "MW", "Generation instructed."),
    ("dispatchregionsum", "dispatchableload", "output", "MW", "Flexible load instructed."),
    ("dispatchregionsum", "netinterchange", "output", "MW", "Net flow to neighbours; negative imports."),
    ("dispatchregionsum", "excessgeneration", "output", "MW", "Surplus that could not leave the region."),
    ("dispatchregionsum", "initialsupply", "input", "MW", "Generation as the interval opens."),
    ("dispatchregionsum", "clearedsupply", "output", "MW", "Generation as the interval closes."),
    ("dispatchregionsum", "uigf", "input", "MW", "Wind and solar possible without curtailment."),
    ("dispatchregionsum", "semischedule_clearedmw", "output", "MW", "Wind and solar instructed."),
    ("dispatchregionsum", "semischedule_compliancemw", "output", "MW", "How closely those units complied."),
    ("dispatchregionsum", "totalintermittentgeneration", "output", "MW", "Small unscheduled generation."),
    # predispatchprice
    ("predispatchprice", "datetime", "key", "timestamp", "End of the half hour being forecast."),
    ("predispatchprice", "run_datetime", "key", "timestamp", "First interval the run covers."),
    ("predispatchprice", "predispatchseqno", "key", "", "Run number of report rows."),
    ("predispatchprice", "lastchanged", "meta", "timestamp", "Moment the record was written."),
    ("predispatchprice", "rrp", "forecast", "$/MWh", "Forecast price; also the benchmark."),
    ("predispatchprice", "eep", "forecast", "$/MWh", "Forecast excess energy price."),
    ("predispatchprice", "rrp1", "forecast", "$/MWh", "Forecast price, demand scenario 1."),
    ("predispatchprice", "rrp2", "forecast", "$/MWh", "Forecast price, demand scenario 2."),
    ("predispatchprice", "rrp3", "forecast", "$/MWh", "Forecast price, demand scenario 3."),
    ("predispatchprice", "rrp4", "forecast", "$/MWh", "Forecast price, demand scenario 4."),
    ("predispatchprice", "rrp5", "forecast", "$/MWh", "Forecast price, demand scenario 5."),
    ("predispatchprice", "rrp6", "forecast", "$/MWh", "Forecast price, demand scenario 6."),
    ("predispatchprice", "rrp7", "forecast", "$/MWh", "Forecast price, demand scenario 7."),
    ("predispatchprice", "rrp8", "forecast", "$/MWh", "Forecast price, demand scenario 8."),
    # predispatchregionsum
    ("predispatchregionsum", "datetime", "key", "timestamp", "End of the half hour being forecast."),
    ("predispatchregionsum", "run_datetime", "key", "timestamp", "First interval the run covers."),
    ("predispatchregionsum", "predispatchseqno", "key", "", "Run number of report rows."),
    ("predispatchregionsum", "lastchanged", "meta", "timestamp", "Moment the record was written."),
    ("predispatchregionsum", "totaldemand", "forecast", "MW", "Forecast demand as a level."),
    ("predispatchregionsum", "availablegeneration", "forecast", "MW", "Forecast generation on offer."),
    ("predispatchregionsum", "availableload", "forecast", "MW", "Forecast flexible load on offer."),
    ("predispatchregionsum", "demandforecast", "forecast", "MW", "Expected change of demand."),
    ("predispatchregionsum", "netinterchange", "forecast", "MW", "Forecast net flow; negative imports."),
    ("predispatchregionsum", "excessgeneration", "forecast", "MW", "Forecast surplus."),
    ("predispatchregionsum", "initialsupply", "forecast", "MW", "Forecast generation at the open."),
    ("predispatchregionsum", "clearedsupply", "forecast", "MW", "Forecast generation at the close."),
    ("predispatchregionsum", "uigf", "forecast", "MW", "Wind and solar forecast together."),
    ("predispatchregionsum", "ss_solar_uigf", "forecast", "MW", "Solar forecast."),
    ("predispatchregionsum", "ss_wind_uigf", "forecast", "MW", "Wind forecast."),
    ("predispatchregionsum", "semischedule_clearedmw", "forecast", "MW", "Forecast wind and solar instructed."),
    # features
    ("features", "regionid", "key", "", "Region; usable as a category."),
    ("features", "trading_day", "key", "date", "Day being predicted; split on it, never train on it."),
    ("features", "spike", "target", "", "Some interval of the day exceeded the threshold."),
    ("features", "actual_max_rrp", "outcome", "$/MWh", "Highest price of the day."),
    ("features", "actual_mean_rrp", "outcome", "$/MWh", "Mean price of the day."),
    ("features", "actual_n_over_300", "outcome", "count", "Intervals above the threshold."),
    ("features", "ev_max_rrp", "feature", "$/MWh", "Highest forecast price at the decision point."),
    ("features", "ev_mean_rrp", "feature", "$/MWh", "Mean forecast price at the decision point."),
    ("features", "ev_p90_rrp", "feature", "$/MWh", "Ninetieth percentile of the forecast price."),
    ("features", "ev_n_over_300", "feature", "count", "Half hours forecast above the threshold."),
    ("features", "ev_n_negative", "feature", "count", "Half hours forecast below zero."),
    ("features", "ev_max_demand", "feature", "MW", "Forecast peak demand."),
    ("features", "ev_mean_demand", "feature", "MW", "Demand the forecasts expect, averaged over the day."),
    ("features", "ev_min_margin", "feature", "MW", "Tightest forecast margin."),
    ("features", "ev_mean_margin", "feature", "MW", "Spare generation the forecasts expect, averaged over the day."),
    ("features", "ev_min_wind", "feature", "MW", "Lowest forecast wind."),
    ("features", "ev_mean_wind", "feature", "MW", "Wind output the forecasts expect, averaged over the day."),
    ("features", "ev_max_solar", "feature", "MW", "Highest forecast solar."),
    ("features", "ev_mean_load_bid", "feature", "MW", "Mean flexible load on offer."),
    ("features", "fc_max_rrp", "feature", "$/MWh", "Highest forecast price, early snapshot."),
    ("features", "fc_mean_rrp", "feature", "$/MWh", "Mean forecast price, early snapshot."),
    ("features", "fc_min_margin", "feature", "MW", "Tightest margin, early snapshot."),
    ("features", "fc_min_wind", "feature", "MW", "Lowest wind, early snapshot."),
    ("features", "fc_max_demand", "feature", "MW", "Peak demand, early snapshot."),
    ("features", "rev_max_rrp", "feature", "$/MWh", "Movement of the highest price between snapshots."),
    ("features", "rev_min_wind", "feature", "MW", "Movement of the lowest wind."),
    ("features", "rev_max_demand", "feature", "MW", "Movement of peak demand."),
    ("features", "rev_min_margin", "feature", "MW", "Movement of the tightest margin."),
    ("features", "ev_margin_ratio", "feature", "ratio", "Tightest margin over peak demand."),
    ("features", "ev_wind_ratio", "feature", "ratio", "Mean wind over mean demand."),
    ("features", "ev_load_bid_ratio", "feature", "ratio", "Flexible load over mean demand."),
    ("features", "spike_yesterday", "feature", "", "The previous trading day spiked."),
    ("features", "max_rrp_yesterday", "feature", "$/MWh", "Highest price of the previous day."),
    ("features", "demand_yesterday", "feature", "MW", "Peak demand of the previous day."),
    ("features", "margin_yesterday", "feature", "MW", "Tightest margin of the previous day."),
    ("features", "spike_count_7d", "feature", "count", "Spike days among the previous seven rows."),
    ("features", "max_rrp_7d", "feature", "$/MWh", "Highest price among the previous seven rows."),
    ("features", "dow", "feature", "", "Day of week, Monday is 1."),
    ("features", "month", "feature", "", "Month number."),
    ("features", "is_weekend", "feature", "", "Saturday or Sunday."),
    ("features", "season", "feature", "", "Summer, winter or shoulder."),
)
