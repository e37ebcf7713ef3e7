"""Structural metrics of project graphs, as expressions over the nested columns (no shuffle, no Python)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def total(values: Column) -> Column:
    return F.aggregate(values, F.lit(0).cast("double"), lambda a, x: a + F.coalesce(x, F.lit(0)).cast("double"))


def renewable(resources: Column) -> Column:
    return F.filter(resources, lambda r: F.coalesce(r["type"], F.lit("renewable")) == "renewable")


def demand_of(demands: Column, resource: Column) -> Column:
    return F.coalesce(F.element_at(demands, resource), F.lit(0))


def lightest_mode(activity: Column) -> Column:
    """The first mode with the least total renewable demand."""
    load = F.transform(activity["modes"], lambda m: total(F.map_values(m["renewable_demands"])))
    return F.element_at(activity["modes"], F.array_position(load, F.array_min(load)).cast("int"))


def demands(activity: Column) -> Column:
    return F.coalesce(activity["demands"], lightest_mode(activity)["renewable_demands"])


def least_demand(activity: Column, resource: Column) -> Column:
    """Demand for a resource in the mode that needs least of it."""
    return F.coalesce(demand_of(activity["demands"], resource), F.array_min(F.transform(activity["modes"], lambda m: demand_of(m["renewable_demands"], resource))))


def duration(activity: Column) -> Column:
    return F.coalesce(activity["duration"], F.array_min(F.transform(activity["modes"], lambda m: m["duration"])))


def resource_factor(activities: Column, resources: Column) -> Column:
    """Share of (activity, renewable resource) pairs with a demand; 0 for none."""
    kinds = renewable(resources)
    used = F.transform(activities, lambda a: F.size(F.filter(kinds, lambda r: demand_of(demands(a), r["id"]) > 0)))
    pairs = F.size(activities) * F.size(kinds)
    return F.when(pairs > 0, total(used) / pairs).otherwise(F.lit(0.0))


def resource_strength(activities: Column, resources: Column) -> Column:
    """Least over renewable resources of capacity over mean demand, at most 1."""

    def ratio(r):
        load = total(F.transform(activities, lambda a: F.when(a["demands"].isNotNull(), demand_of(a["demands"], r["id"])).otherwise(least_demand(a, r["id"]))))
        return F.when(load > 0, F.least(F.lit(1.0), r["capacity"] / (load / F.size(activities)))).otherwise(F.lit(1.0))

    return F.coalesce(F.array_min(F.transform(renewable(resources), ratio)), F.lit(1.0))


def network_density(activities: Column, precedences: Column) -> Column:
    n = F.size(activities).cast("double")
    return F.when(n < 2, F.lit(0.0)).otherwise(F.size(precedences) / (n * (n - 1) / 2))


def structural_hash(precedences: Column) -> Column:
    """First 16 hex digits of the SHA-256 of the sorted [i, j] pairs as JSON."""
    pairs = F.array_sort(F.transform(precedences, lambda p: F.struct(p["i"].alias("i"), p["j"].alias("j"))))
    text = F.array_join(F.transform(pairs, lambda p: F.format_string("[%d, %d]", p["i"], p["j"])), ", ")
    return F.substring(F.sha2(F.concat(F.lit("["), text, F.lit("]")), 256), 1, 16)


def difficulty(rf: Column, rs: Column, rf_cuts=(0.4, 0.65), rs_cuts=(0.35, 0.6)) -> Column:
    easy, hard = (rf <= rf_cuts[0]) & (rs >= rs_cuts[1]), (rf >= rf_cuts[1]) & (rs <= rs_cuts[0])
    return F.when(easy, "easy").when(hard, "hard").otherwise("medium")


def horizon(activities: Column, resources: Column, precedences: Column) -> Column:
    """Longest durations, positive lags and downtimes, summed."""
    longest = F.transform(activities, lambda a: F.coalesce(a["duration"], F.array_max(F.transform(a["modes"], lambda m: m["duration"]))))
    lags = F.transform(precedences, lambda p: F.greatest(p["lag_min"], F.lit(0)))
    windows = F.flatten(F.transform(resources, lambda r: F.coalesce(r["downtime"], F.array())))
    return (total(longest) + total(lags) + total(F.transform(windows, lambda w: w["end"] - w["start"]))).cast("int")


def loss_weight(gap: Column, approx: Column) -> Column:
    return F.when(approx, F.lit(0.3)).otherwise(F.greatest(F.lit(0.5), F.least(F.lit(1.0), 1 - gap / 0.15 * 0.5)))


def gap_of(status: Column, objective: Column, bound: Column) -> Column:
    """Relative gap; a missing or absurd bound counts as reached."""
    usable = F.when(bound.isNull() | (F.abs(bound) > 1e15), objective).otherwise(bound)
    return F.when((status == "optimal") | (objective == 0), F.lit(0.0)).otherwise(F.abs(objective - usable) / F.greatest(F.abs(objective), F.lit(1e-9)))
