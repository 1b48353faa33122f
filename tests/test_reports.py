import random

import pytest
from conftest import at, rows
from pyspark.sql import functions as F

from shardbrook.operators import activity, owners


def test_owners_leave_out_closed_shards(make):
    progress = make.progress(
        [("a", "", "x", False, None), ("b", "", "x", None, None), ("c", "", "x", True, None), ("d", "", "y", False, None)]
    )
    assert rows(owners.active_owners(progress), "owner", "shard_id", "n_shards") == [
        ("x", "a", 2),
        ("x", "b", 2),
        ("y", "d", 1),
    ]


def test_rows_without_owner_are_counted_or_refused(make):
    progress = make.progress(
        [("a", "", "x", False, None), ("b", "", None, False, None), (None, "", "x", False, None), ("c", "", None, True, None)]
    )
    assert rows(owners.invalid_progress(progress)) == [(2, 3)]
    assert rows(owners.active_owners(progress), "shard_id") == [("a",)]
    with pytest.raises(Exception, match="without owner or shard id"):
        owners.active_owners(progress, strict=True).collect()
    good = progress.filter("owner IS NOT NULL AND shard_id IS NOT NULL")
    assert rows(owners.active_owners(good, strict=True), "shard_id") == [("a",)]


def test_shard_lists_are_whole_and_bounded(make):
    progress = make.progress([(str(i), "", "x", False, None) for i in range(2000)])
    lists = owners.owner_shard_lists(progress, page_size=3).collect()
    assert max(len(r.shards) for r in lists) <= 3
    assert all(r.shards == sorted(r.shards) and r.n_shards == len(r.shards) for r in lists)
    assert sorted(s for r in lists for s in r.shards) == sorted(str(i) for i in range(2000))


def test_two_workers_with_one_shard_each(make):
    progress = make.progress([("a", "", "x", False, None), ("b", "", "y", False, None)])
    assert rows(owners.owner_skew(progress), "owner", "load", "optimal", "over") == [
        ("x", 1, 1, False),
        ("y", 1, 1, False),
    ]


def test_skew_and_heaviest(spark, make):
    progress = make.progress(
        [(s, "", o, False, None) for s, o in [("a", "x"), ("b", "x"), ("c", "x"), ("d", "y"), ("e", "z")]]
    )
    assert rows(owners.owner_skew(progress), "owner", "load", "optimal", "over") == [
        ("x", 3, 1, True),
        ("y", 1, 1, False),
        ("z", 1, 1, False),
    ]
    assert rows(owners.heaviest_owner(progress), "owner") == [("x",)]
    weights = spark.createDataFrame(
        [("s", "d", 9), ("s", "e", 9)], "stream string, shard_id string, weight bigint"
    )
    assert rows(owners.heaviest_owner(progress, weights), "owner", "load") == [("y", 9)]
    assert rows(owners.owner_skew(progress, weights), "owner", "optimal", "over") == [
        ("x", 6, False),
        ("y", 6, True),
        ("z", 6, True),
    ]


def test_stalled(make):
    recs = make.records([("a", "1", 0, b""), ("b", "1", 1, b""), ("c", "1", 31, b"")])
    # 31 s and 30 s of silence: only more than the lease counts.
    assert rows(activity.stalled_shards(recs), "shard_id", "silent_us") == [("a", 31_000_000)]
    later = F.lit(at(61)).cast("timestamp")
    assert rows(activity.stalled_shards(recs, later), "shard_id") == [("a",), ("b",)]


def brute(events, gap):
    gaps, sessions = [], []
    for shard in sorted({s for s, _ in events}):
        times = sorted(t for s, t in events if s == shard)
        start = times[0]
        count = 1
        for before, t in zip(times, times[1:]):
            if t - before > gap:
                gaps.append((shard, at(before), at(t)))
                sessions.append((shard, at(start), at(before + gap), count))
                start, count = t, 0
            count += 1
        sessions.append((shard, at(start), at(times[-1] + gap), count))
    return sorted(gaps, key=str), sorted(sessions, key=str)


@pytest.mark.parametrize("seed", range(4))
def test_gaps_and_sessions_against_brute_force(make, seed):
    rng = random.Random(seed)
    # Whole seconds, so gaps of exactly the limit occur.
    events = [(rng.choice("aab"), rng.randint(0, 3000)) for _ in range(200)]
    recs = make.records([(s, str(i), t, b"") for i, (s, t) in enumerate(events)])
    gaps, sessions = brute(events, 30)
    assert rows(activity.silence_gaps(recs), "shard_id", "silent_from", "silent_until") == gaps
    found = activity.activity_sessions(recs)
    assert rows(found, "shard_id", "session_start", "session_end", "n_records") == sessions


def test_sessions_equal_session_windows(make):
    rng = random.Random(7)
    recs = make.records([(rng.choice("ab"), str(i), rng.randint(0, 2000), b"") for i in range(150)])
    window = F.session_window("arrival_ts", "30 seconds")
    built_in = recs.groupBy("shard_id", window.alias("w")).count().select("shard_id", "w.start", "w.end", "count")
    ours = activity.activity_sessions(recs)
    assert rows(ours, "shard_id", "session_start", "session_end", "n_records") == rows(built_in)


def _moved(make, progress, owners_too=None):
    """Loads after the plan, the number of moves, and the plan's rows."""
    plan = owners.rebalance_plan(progress, owners_too).collect()
    held = {r.shard_id: r.owner for r in owners.valid_rows(progress).collect()}
    assert len({r.shard_id for r in plan}) == len(plan)
    for r in plan:
        assert held[r.shard_id] == r.owner != r.new_owner
        held[r.shard_id] = r.new_owner
    loads = {}
    for owner in held.values():
        loads[owner] = loads.get(owner, 0) + 1
    return loads, len(plan), plan


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_a_plan_evens_the_load_with_fewest_moves(spark, make, seed):
    rng = random.Random(seed)
    names = [f"w{i}" for i in range(7)]
    held = {n: rng.choice([0, 1, 3, 9, 25]) for n in names}
    held["w0"] = 200  # one owner with most of the shards
    progress = make.progress(
        [(f"{n}-{i}", "", n, False, None) for n, count in held.items() for i in range(count)]
        + [("closed", "", "w1", True, None), ("none", "", None, False, None)]
    )
    others = spark.createDataFrame([(n,) for n in names] + [(None,)], "owner string")
    loads, moves, _ = _moved(make, progress, others)
    total = sum(held.values())
    share, left_over = divmod(total, len(names))
    assert sorted(loads.values()) == sorted([share] * (7 - left_over) + [share + 1] * left_over)
    # No plan is shorter: the largest loads get the larger shares.
    wanted = sorted(held.values(), reverse=True)
    least = sum(max(0, n - share - (i < left_over)) for i, n in enumerate(wanted))
    assert moves == least


def test_even_loads_stay_and_ties_go_by_name(make):
    even = make.progress([(f"{o}{i}", "", o, False, None) for o in "abc" for i in range(2)])
    assert owners.rebalance_plan(even).count() == 0
    tied = make.progress(
        [(f"{o}{i}", "", o, False, None) for o in "ab" for i in range(3)] + [("c0", "", "c", False, None)]
    )
    loads, moves, plan = _moved(make, tied)
    assert loads == {"a": 3, "b": 2, "c": 2} and moves == 1 and plan[0].owner == "b"
    assert owners.rebalance_plan(even.limit(0)).count() == 0
