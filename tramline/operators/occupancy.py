"""Counts of who is where, as sweeps over +1 / -1 events.

A stay is an interval of ticks; what is asked is how many stays cover a tick.
Both ends of a stay become events, events of one place and tick are summed
before anything is ordered, and a running total over a place's ticks gives the
count. Totals run in chunks (``operators.sequence``), so a place with a third
of all events is spread over tasks, and no interval is ever joined to ticks.
Sequences build on sequences here, so what one yields is written to the shared
scratch folder before the next is built on it.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tramline.operators.sequence import carry_forward, neighbors, running_total, with_chunks
from tramline.session import settle


def located(rows: DataFrame, who: str, tick: str, order: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """Each row of ``who`` with ``until``, the tick of its next row (null: none), and ``prev_<column>`` of its row before."""
    cut = with_chunks(rows.select(who, tick, *order, *columns), [who], [tick])
    seq = neighbors(cut, [who], [tick, *order], [tick], "next", prefix="_next_").withColumnRenamed(f"_next_{tick}", "until")
    return settle(neighbors(seq, [who], [tick, *order], columns, "prev"), "located")


def changes(intervals: DataFrame, place: str = "place", start: str = "tick", end: str = "until",
            weight: Column | None = None) -> DataFrame:
    """(place, tick, change): the sum of all starts and ends of a place at a tick; ticks without change are left out."""
    w = F.lit(1).cast("long") if weight is None else weight.cast("long")
    ends = F.array(F.struct(F.col(start).alias("tick"), w.alias("change")), F.struct(F.col(end).alias("tick"), (-w).alias("change")))
    each = intervals.select(F.col(place).alias("place"), F.explode(ends).alias("_e")).select("place", "_e.tick", "_e.change")
    return each.where("place is not null and tick is not null").groupBy("place", "tick").agg(
        F.sum("change").alias("change")).where("change <> 0")


def riders_at_stops(riding: DataFrame, docking: DataFrame, vehicle: str = "vehicle") -> DataFrame:
    """(place, tick, change) of riders that sit in a vehicle while it stands at a place.

    ``riding(vehicle, tick, change)``: boardings and alightings, summed per
    vehicle and tick. ``docking(vehicle, tick, place)``: the place from the
    tick on, null while under way; one row per vehicle and tick. Per vehicle
    both are one sequence: the load is a running total, the place is carried
    forward, and each row moves the load from the place before to the place now.
    """
    events = (riding.select(vehicle, "tick", "change", F.lit(None).cast(_place_struct(docking)).alias("_dock"))
              .unionByName(docking.select(vehicle, "tick", F.lit(0).cast("long").alias("change"), F.struct("place").alias("_dock"))))
    merged = events.groupBy(vehicle, "tick").agg(F.sum("change").alias("change"), F.max("_dock").alias("_dock"))
    merged = with_chunks(settle(merged, "vehicle-events"), [vehicle], ["tick"])
    loaded = running_total(merged, [vehicle], ["tick"], "change", "load")
    here = settle(carry_forward(loaded, [vehicle], ["tick"], ["_dock"], "_at").select(
        vehicle, "tick", "load", F.col("_at_dock.place").alias("place")), "vehicle-loads")
    seq = neighbors(here, [vehicle], ["tick"], ["load", "place"], "prev")
    moved = F.array(F.struct(F.col("place"), F.col("load").alias("change")),
                    F.struct(F.col("prev_place").alias("place"), (-F.col("prev_load")).alias("change")))
    each = seq.select("tick", F.explode(moved).alias("_e")).select("_e.place", "tick", "_e.change")
    return each.where("place is not null and change <> 0").groupBy("place", "tick").agg(F.sum("change").alias("change")).where("change <> 0")


def _place_struct(docking: DataFrame) -> str:
    return f"struct<place:{docking.schema['place'].dataType.simpleString()}>"


def station_counters(riders: DataFrame, docks: DataFrame, order: Sequence[str] = ("seq",)) -> DataFrame:
    """O-R6 / O-A14: (station, tick, waiting, on_premises, boarded, entered), one row per station and tick.

    ``riders(rider, tick, seq, station, vehicle)``: where a rider is from the
    row on, at a station or in a vehicle. ``docks(vehicle, tick, station)``: where a vehicle stands from the
    tick on, one row per vehicle and tick, null while under way. Counts hold at
    the end of a tick: ``waiting`` riders whose last row is at the station,
    ``on_premises`` these and the riders of vehicles that stand there.
    ``boarded`` and ``entered`` count the moves from the station into a vehicle
    and back during the tick. A station has a row for every tick from its first
    event to the last tick of the riders' log.
    """
    order = list(order)
    seq = located(riders, "rider", "tick", order, ["station", "vehicle"])
    waiting = changes(seq, "station")
    riding = changes(seq, "vehicle").withColumnRenamed("place", "vehicle")
    aboard = riders_at_stops(riding, docks.withColumnRenamed("station", "place"))
    boards = F.col("vehicle").isNotNull() & F.col("prev_station").isNotNull()
    enters = F.col("station").isNotNull() & F.col("prev_vehicle").isNotNull()
    one, none = F.lit(1).cast("long"), F.lit(0).cast("long")
    moves = seq.where(boards | enters).select(
        F.when(boards, F.col("prev_station")).otherwise(F.col("station")).alias("place"), "tick",
        none.alias("w"), none.alias("p"), F.when(boards, one).otherwise(0).alias("b"), F.when(boards, none).otherwise(1).alias("e"))
    every = (waiting.select("place", "tick", F.col("change").alias("w"), F.col("change").alias("p"), none.alias("b"), none.alias("e"))
             .union(aboard.select("place", "tick", none, "change", none, none)).union(moves))
    per_tick = every.groupBy("place", "tick").agg(*[F.sum(c).alias(c) for c in "wpbe"])
    per_tick = with_chunks(settle(per_tick, "station-ticks"), ["place"], ["tick"])
    level = running_total(running_total(per_tick, ["place"], ["tick"], "w", "waiting"), ["place"], ["tick"], "p", "on_premises")
    until = neighbors(level, ["place"], ["tick"], ["tick"], "next", prefix="_next_")
    last = riders.agg(F.max("tick")).scalar()
    ticks = F.sequence(F.col("tick"), F.greatest(F.col("tick"), F.coalesce(F.col("_next_tick") - 1, last)))
    each = until.select("place", "tick", "waiting", "on_premises", "b", "e", F.explode(ticks).alias("t"))
    at_start = F.col("t") == F.col("tick")
    return each.select(F.col("place").alias("station"), F.col("t").alias("tick"), "waiting", "on_premises",
                       F.when(at_start, F.col("b")).otherwise(0).alias("boarded"), F.when(at_start, F.col("e")).otherwise(0).alias("entered"))


def board(waiting: DataFrame, vehicles: DataFrame, arrival: Sequence[str], turn: Sequence[str]) -> DataFrame:
    """O-R4: who boards which vehicle, first come first served: (rider, station, next_stop, vehicle, place_in_queue).

    ``waiting(rider, station, next_stop, *arrival)`` queue per station and next
    stop, in arrival order. ``vehicles(vehicle, station, next_stop, capacity,
    riders, *turn)`` take from the queue of their next stop in their turn, each as many as
    it has seats free (``capacity - riders``, none if that is negative). Riders without a next
    stop, and vehicles without one, take no part.

    Ranks in a queue and seats offered are running totals; a vehicle owns the
    ranks after the seats offered before it. Both meet in one sequence ordered
    by rank, along which the vehicle is carried forward: a queue of any length
    is cut into chunks, and no queue is joined to its vehicles.
    """
    arrival, turn = list(arrival), list(turn)
    queue = ["station", "next_stop"]
    one = F.lit(1).cast("long")
    ranked = running_total(waiting.where("station is not null and next_stop is not null").withColumn("_one", one),
                           queue, arrival, "_one", "_rank")
    free = F.greatest(F.col("capacity") - F.coalesce("riders", F.lit(0)), F.lit(0)).cast("long")
    offered = running_total(vehicles.where("station is not null and next_stop is not null").withColumn("_free", F.coalesce(free, F.lit(0))).where(
        "_free > 0"), queue, turn, "_free", "_seats")
    blocks = settle(offered, "seats").select(*queue, (F.col("_seats") - F.col("_free") + 1).alias("_rank"), F.lit(0).alias("_side"),
                            F.struct("vehicle", "_seats").alias("_vehicle"))
    riders = settle(ranked, "queue").select(*queue, "_rank", F.lit(1).alias("_side"), "rider")
    carried = carry_forward(blocks.unionByName(riders, allowMissingColumns=True), queue, ["_rank", "_side"], ["_vehicle"], "_last")
    return carried.where("_side = 1 and _last_vehicle is not null").where(F.col("_rank") <= F.col("_last_vehicle._seats")).select(
        "rider", *queue, F.col("_last_vehicle.vehicle").alias("vehicle"), F.col("_rank").alias("place_in_queue"))
