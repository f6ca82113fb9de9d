"""Revenue jobs over raw trips of both services."""

from __future__ import annotations

from pyspark.sql import DataFrame

from tripmill.operators.aggregates import hourly_revenue, monthly_revenue
from tripmill.operators.joins import full_outer, lookup_join
from tripmill.operators.projections import common_names, tagged_union


def monthly(green: DataFrame, yellow: DataFrame) -> DataFrame:
    """Monthly revenue of both services by pickup zone."""
    trips = tagged_union({"green": common_names(green), "yellow": common_names(yellow)})
    return monthly_revenue(trips)


def hourly_by_service(green: DataFrame, yellow: DataFrame, since: str,
                      date_col: str | None = None) -> DataFrame:
    """Hourly revenue of the two services side by side.

    Each service is aggregated before the join, which then moves one row per hour and zone. The
    join keys are the grouping keys, so the join reuses the shuffle of the aggregates.
    """
    sides = []
    for name, df in {"green": green, "yellow": yellow}.items():
        revenue = hourly_revenue(common_names(df), since, date_col=date_col)
        sides.append(revenue.withColumnsRenamed(
            {"amount": f"{name}_amount", "number_records": f"{name}_number_records"}))
    return full_outer(sides[0], sides[1], ["hour", "zone"])


def hourly_with_zones(green: DataFrame, yellow: DataFrame, zones: DataFrame, since: str,
                      date_col: str | None = None) -> DataFrame:
    """Hourly revenue with zone names; hours of unknown zones are left out."""
    revenue = hourly_by_service(green, yellow, since, date_col)
    joined = lookup_join(revenue, zones, revenue["zone"] == zones["LocationID"], "inner")
    return joined.drop(zones["LocationID"], revenue["zone"])
