"""Queries against their SQL on values that the smallest tables do not hold."""

import duckdb

from fathom.plans.queries import QUERIES, SQL


def both(spark, tmp_path, name, rows):
    """(the query's rows, its SQL's rows) over ``rows`` (event_id, user_id, value) of events."""
    frame = spark.createDataFrame([(*r, "view") for r in rows], "event_id long, user_id long, value double, event_type string")
    frame.coalesce(1).write.parquet(f"{tmp_path}/events.parquet")
    out = QUERIES[name](spark, str(tmp_path))
    con = duckdb.connect()
    con.execute(f"create view events as select * from '{tmp_path}/events.parquet/*.parquet'")
    listed = ", ".join(out.columns)
    return sorted(map(tuple, out.collect())), sorted(con.execute(f"select {listed} from ({SQL[name]})").fetchall())


def with_zeros():
    """Three users of twenty events with zeros and a spike each, and users of one to six events."""
    rows = [(20 * u + i, u, 0.0 if i % 9 == u else 90.0 if i == 13 else 0.25 * (i % 4)) for u in range(3) for i in range(20)]
    return rows + [(100 + 10 * u + i, u, (7.0, 0.0, 80.0, 7.5, 0.0, 6.0)[i]) for u in range(3, 9) for i in range(u - 2)]


def test_despike_counts_zeros_and_small_groups(spark, tmp_path):
    got, want = both(spark, tmp_path, "despike_once", with_zeros())
    assert got == want and any(v for _, u, v in want if u < 3) and not all(v for _, u, v in want if u > 4)


def test_a_rise_of_just_the_tolerance_is_none(spark, tmp_path):
    steps = [v / 100 for v in range(0, 3000, 7)]
    values = [x for v in steps for x in (v, round(v + 50, 2))]
    assert any(b - a > 50 for a, b in zip(values[::2], values[1::2]))
    got, want = both(spark, tmp_path, "monotonic_check", [(i, 1, v) for i, v in enumerate([*values, 10.0, 60.01])])
    assert got == want == [(len(values), 1, 50.01)]


def test_a_depth_of_zero_weighs_nothing(spark, tmp_path):
    got, want = both(spark, tmp_path, "unit_discharge_weights", [r for r in with_zeros() if r[1] < 6])
    assert got == want and sum(w == 0 for *_, w in want) >= 5
