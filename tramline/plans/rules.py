"""Operating rules of the fleet, re-aimed as table operators.

They run over whole tables: routes are rows ``(route, seq, station)``,
histories are arrays or rows, and every rule is a join, an aggregate or a
chunked sequence operator -- never a per-entity loop.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tramline.functions import next_in_cycle
from tramline.operators.asof import latest_at_probes
from tramline.operators.sequence import neighbors, running_total
from tramline.operators.state import latest_by_key
from tramline.schemas import PLATFORM_STATES


def next_stop(entities: DataFrame, routes: DataFrame, entity: str) -> DataFrame:
    """O-R1 for entities located at a stop: the stop after the current one on
    the route the station belongs to (null at the route's end).

    ``entities(entity, station)``, ``routes(route, seq, station)``; a station
    on several routes yields one row per route.
    """
    here = entities.join(routes, "station", "inner")
    nxt = routes.select("route", (F.col("seq") - F.lit(1)).alias("seq"), F.col("station").alias("next_station"))
    return here.join(nxt, ["route", "seq"], "left").select(entity, "route", "seq", "station", "next_station")


def next_stop_from_history(entities: DataFrame, routes: DataFrame, entity: str, route_col: str,
                           history: str) -> DataFrame:
    """O-R1 with an array history: next = route stop at index ``size(history)``;
    null when the history covers the whole route. ``complete`` flags a
    history equal to the full route (the caller resets it to the first stop).
    """
    e = entities.select(entity, route_col, history, F.size(history).alias("_n"))
    stops = routes.select(F.col("route").alias(route_col), F.col("seq").alias("_n"),
                          F.col("station").alias("next_station"))
    lengths = routes.groupBy(F.col("route").alias(route_col)).agg(F.count(F.lit(1)).alias("_len"))
    out = e.join(stops, [route_col, "_n"], "left").join(lengths, route_col, "left")
    return out.select(entity, route_col, history, "next_station",
                      (F.col("_n") == F.col("_len")).alias("complete"))


def history_violations(entities: DataFrame, routes: DataFrame, entity: str, route_col: str,
                       history: str) -> DataFrame:
    """O-Q9 / O-Q13: histories longer than, or not a prefix of, their route.

    The history is exploded with positions (bounded by route length) and
    joined to the route's rows, so no route array is ever built.
    """
    steps = entities.select(entity, route_col, F.posexplode(history).alias("seq", "station"))
    r = routes.select(F.col("route").alias(route_col), "seq", F.col("station").alias("_expected"))
    j = steps.join(r, [route_col, "seq"], "left")
    bad = j.where(F.col("_expected").isNull() | (F.col("_expected") != F.col("station")))
    return bad.groupBy(entity, route_col).agg(F.min("seq").alias("first_bad_index"),
                                              F.count(F.lit(1)).alias("n_bad"))


def trips_due(plans: DataFrame, clock: DataFrame, time_keys: Sequence[str], who: str, plan_order: str) -> DataFrame:
    """O-R2: plans whose weekday/hour/minute match a clock row; per passenger
    and clock row, the first plan by ``plan_order``. The clock side is small
    (a window of ticks) and broadcast by the caller."""
    due = plans.join(clock, list(time_keys), "inner")
    return latest_by_key(due, [who, *time_keys], [plan_order], [plan_order], pick="min")


def as_of_latest(rows: DataFrame, probes: DataFrame, key: str, time: str, probe: str,
                 tiebreak: Sequence[str]) -> DataFrame:
    """O-R3: per key and probe time, the latest row with ``time <= probe`` (see ``operators.asof``)."""
    return latest_at_probes(rows, probes, key, time, probe, tiebreak)


def allocate(requests: DataFrame, capacity: DataFrame, key: str, order: Sequence[str], cap: str,
             slot: str = "slot") -> DataFrame:
    """O-R4: first come, first served up to a per-key capacity.

    The arrival rank is a chunked running count, so a key with a huge queue
    is ranked in pieces across tasks.
    """
    ranked = running_total(requests.withColumn("_one", F.lit(1).cast("long")), [key], list(order), "_one", slot)
    with_cap = ranked.join(capacity, key, "inner")
    return with_cap.where(F.col(slot) <= F.col(cap)).drop("_one")


def alighting(riders: DataFrame, vehicles: DataFrame, vehicle: str, rider_next: str, vehicle_next: str) -> DataFrame:
    """O-R7: riders on a vehicle leave when their route is done (no next stop)
    or their next stop differs from the vehicle's."""
    j = riders.join(vehicles, vehicle, "inner")
    return j.where(F.col(rider_next).isNull() | (F.col(rider_next) != F.col(vehicle_next)))


def platform_transition_audit(states: DataFrame, keys: Sequence[str], tick: str = "clock_tick",
                              state: str = "platform_state", cycle: Sequence[str] = PLATFORM_STATES,
                              tiebreak: Sequence[str] = ()) -> DataFrame:
    """O-R8: consecutive platform states must be equal or the successor.

    Pairs whose ticks are not adjacent are reported as ``gap`` (missing log
    rows), not judged. ``tiebreak`` orders rows that share a tick.
    """
    seq = neighbors(states, keys, [tick, *tiebreak], [tick, state], "prev")
    prev_state, prev_tick = F.col(f"prev_{state}"), F.col(f"prev_{tick}")
    ok = (prev_state == F.col(state)) | (next_in_cycle(prev_state, cycle) == F.col(state))
    verdict = (F.when(prev_tick.isNull(), F.lit(None))
               .when(F.col(tick) - prev_tick > 1, F.lit("gap"))
               .when(ok, F.lit(None))
               .otherwise(F.lit("invalid")))
    out = seq.withColumn("verdict", verdict)
    return out.where(F.col("verdict").isNotNull()).select(*keys, *tiebreak, tick, prev_state.alias("prev_state"),
                                                          state, "verdict")


def station_counts(passengers: DataFrame, key: str = "passenger_id", tick: str = "clock_tick",
                   station: str = "station_id", vehicle: str = "train_id", tiebreak: Sequence[str] = (),
                   period=None) -> DataFrame:
    """O-R6: per (period, station) boardings and entries rebuilt from rider events.

    boarded: station -> vehicle transition, counted at the station left;
    entered: vehicle -> station transition, counted at the station reached.
    ``period`` maps the tick column to the reporting grain (default: the tick).
    """
    tiebreak = list(tiebreak)
    seq = neighbors(passengers.select(key, tick, *tiebreak, station, vehicle), [key], [tick, *tiebreak],
                    [station, vehicle], "prev")
    when = (period(F.col(tick)) if period else F.col(tick)).alias(tick)
    boarded = seq.where(F.col(vehicle).isNotNull() & F.col(f"prev_{station}").isNotNull()) \
        .select(when, F.col(f"prev_{station}").alias("station_id"), F.lit(1).alias("b"), F.lit(0).alias("e"))
    entered = seq.where(F.col(station).isNotNull() & F.col(f"prev_{vehicle}").isNotNull()) \
        .select(when, F.col(station).alias("station_id"), F.lit(0).alias("b"), F.lit(1).alias("e"))
    both = boarded.unionByName(entered)
    return both.groupBy(tick, "station_id").agg(F.sum("b").cast("long").alias("passengers_boarded_trains"),
                                               F.sum("e").cast("long").alias("passengers_entered_station"))


def travel_ticks(segments: DataFrame, distance: str = "distance_km", speed: str = "speed") -> DataFrame:
    """O-R9: ticks to cross each segment, ``ceil(distance / speed)``."""
    return segments.withColumn("travel_ticks", F.ceil(F.col(distance) / F.nullif(F.col(speed), F.lit(0))))


def route_travel_ticks(routes: DataFrame, segments: DataFrame) -> DataFrame:
    """O-R9 per route leg: cumulative ticks from the route's first stop."""
    legs = neighbors(routes, ["route_id"], ["stop_sequence"], ["station_id"], "prev", prefix="from_", bounded=True)
    seg = travel_ticks(segments).select(F.col("from_station_id").alias("from_station_id"),
                                        F.col("to_station_id").alias("station_id"), "travel_ticks")
    j = legs.join(seg, ["from_station_id", "station_id"], "left") \
        .withColumn("travel_ticks", F.coalesce(F.col("travel_ticks"), F.lit(0)).cast("long"))
    return running_total(j, ["route_id"], ["stop_sequence"], "travel_ticks", "ticks_from_start", bounded=True)

