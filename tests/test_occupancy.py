"""Station counters and boarding against a plain walk, with keys cut into tiny chunks (the session's default in tests)."""

import collections
import random

from tramline.operators.occupancy import board, station_counters


def walk(riders, docks, order=lambda r: (r[1], r[2])):
    """Counters by walking the ticks: riders [(rider, tick, seq, station, vehicle)], docks [(vehicle, tick, station)]."""
    where, at, out = {}, {}, {}
    moves = collections.Counter()
    last, before, seen = max(r[1] for r in riders), {}, {}
    for r in sorted(riders, key=lambda r: (r[0], *order(r))):
        prev = before.get(r[0])
        if prev and r[4] is not None and prev[3] is not None:
            moves[prev[3], r[1], "b"] += 1
        elif prev and r[3] is not None and prev[4] is not None:
            moves[r[3], r[1], "e"] += 1
        before[r[0]] = r
    for t in range(min(min(r[1] for r in riders), min(d[1] for d in docks)), last + 1):
        for r in sorted((r for r in riders if r[1] == t), key=order):
            where[r[0]] = (r[3], r[4])
        at.update({v: s for v, tt, s in docks if tt == t})
        wait = collections.Counter(s for s, _ in where.values() if s is not None)
        aboard = collections.Counter(at[v] for _, v in where.values() if v is not None and at.get(v) is not None)
        for s in set(wait) | set(aboard) | {p for p, tt, _ in moves if tt == t}:
            seen.setdefault(s, t)
        for s in seen:
            out[s, t] = (wait[s], wait[s] + aboard[s], moves[s, t, "b"], moves[s, t, "e"])
    return out


def test_station_counters(spark):
    rng = random.Random(5)
    riders, docks = [], {}
    for seq in range(500):
        station = rng.choice([0, 0, 0, 1, 2, 3])  # station 0 holds half of the rows
        place = rng.choice([(station, None), (None, rng.randrange(4)), (None, None)] if seq % 9 == 0 else [(station, None), (None, rng.randrange(4))])
        riders.append((rng.randrange(25), rng.randrange(40), seq, *place))
    for _ in range(60):
        docks[rng.randrange(4), rng.randrange(45)] = rng.choice([None, 0, 0, 1, 2, 7])
    docks = [(v, t, s) for (v, t), s in docks.items()]
    got = station_counters(spark.createDataFrame(riders, "rider int, tick int, seq int, station int, vehicle int"),
                           spark.createDataFrame(docks, "vehicle int, tick int, station int"))
    got = {(r.station, r.tick): (r.waiting, r.on_premises, r.boarded, r.entered) for r in got.collect() if r.tick <= max(x[1] for x in riders)}
    want = walk(riders, docks)
    assert {k: v for k, v in got.items() if any(v)} == {k: v for k, v in want.items() if any(v)}
    assert set(got) <= set(want) | {k for k, v in got.items() if not any(v)} and sum(v[0] for v in got.values()) > 400


def first_come(waiting, vehicles):
    out, free = {}, {v[0]: max(v[3] - (v[4] or 0), 0) for v in vehicles}
    for v in sorted(vehicles, key=lambda v: v[5]):
        for w in sorted(waiting, key=lambda w: (w[3], w[0])):
            if free[v[0]] and w[0] not in out and None not in w[1:3] and w[1:3] == v[1:3]:
                out[w[0]] = v[0]
                free[v[0]] -= 1
    return out


def test_boarding_takes_turns(spark):
    """Several vehicles at one queue, a queue with a third of all riders, no seats, no riders, no next stop, ties of arrival."""
    rng = random.Random(6)
    waiting = [(i, 0 if i % 3 == 0 else rng.randrange(4), rng.choice([1, 1, 1, 2, None]), rng.randrange(30)) for i in range(300)]
    vehicles = [(100 + k, rng.randrange(5), rng.choice([1, 1, 2, None]), rng.randrange(40), rng.choice([None, 0, 3, 50]), rng.random()) for k in range(25)]
    got = board(spark.createDataFrame(waiting, "rider int, station int, next_stop int, since int"),
                spark.createDataFrame(vehicles, "vehicle int, station int, next_stop int, capacity int, riders int, turn double"),
                ["since", "rider"], ["turn"]).collect()
    want = first_come(waiting, vehicles)
    assert len(want) > 60 and {r.rider: r.vehicle for r in got} == want and len(got) == len(want)
    none = spark.createDataFrame([], "rider int, station int, next_stop int, since int")
    assert board(none, spark.createDataFrame(vehicles, "vehicle int, station int, next_stop int, capacity int, riders int, turn double"),
                 ["since", "rider"], ["turn"]).collect() == []
