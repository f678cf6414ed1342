"""Operators against plain-Python brute force on small random logs."""

import random
from collections import Counter, defaultdict

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from encore.operators import popularity, prep

SCHEMA = "user_id long, timestamp double, recording_id string"


def _brute_prune(rows, bound):
    users_per_song = defaultdict(set)
    for u, _, s in rows:
        users_per_song[s].add(u)
    a = [r for r in rows if len(users_per_song[r[2]]) > bound]
    songs_per_user = defaultdict(set)
    for u, _, s in a:
        songs_per_user[u].add(s)
    return [r for r in a if len(songs_per_user[r[0]]) > bound]


logs = st.lists(
    st.tuples(st.integers(0, 7), st.integers(0, 5).map(float), st.sampled_from([f"s{i}" for i in range(6)])),
    min_size=0,
    max_size=60,
)


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(rows=logs, bound=st.integers(0, 3))
def test_prune_equals_brute_force(spark, rows, bound):
    df = spark.createDataFrame(rows, SCHEMA)
    got = Counter(tuple(r) for r in prep.prune_rare(df, bound, bound).collect())
    assert got == Counter(_brute_prune(rows, bound))


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(rows=logs)
def test_ratings_equal_brute_force(spark, rows):
    df = spark.createDataFrame([(u, float(s[1:])) for u, _, s in rows], "user_id long, recording_id_index double")
    got = {(r["user_id"], r["recording_id_index"]): r["avg_rating"] for r in prep.user_item_ratings(df).collect()}
    plays = Counter((u, float(s[1:])) for u, _, s in rows)
    totals = Counter(u for u, _, _ in rows)
    want = {k: v / totals[k[0]] for k, v in plays.items()}
    assert got.keys() == want.keys()
    assert all(got[k] == pytest.approx(want[k]) for k in want)


def test_empty_test_log(spark):
    rnd = random.Random(5)
    train = spark.createDataFrame(
        [(rnd.randrange(20), float(i), f"s{rnd.randrange(10)}") for i in range(300)], SCHEMA
    )
    top = popularity.recommend(train, 5)
    empty = spark.createDataFrame([], SCHEMA)
    for order in ("standard", "reference"):
        row = popularity.evaluate(empty, top, 5, order).first()
        assert row["n_users"] == 0 and row["precision_at_k"] is None


def test_popularity_scores_brute_force(spark):
    rnd = random.Random(9)
    rows = [(rnd.randrange(30), float(i), f"s{rnd.randrange(12)}") for i in range(400)]
    df = spark.createDataFrame(rows, SCHEMA)
    got = {r["recording_id"]: r["combined_score"] for r in popularity.popularity_scores(df, beta=7, global_beta=11).collect()}
    plays = Counter(s for _, _, s in rows)
    users = {s: len({u for u, _, t in rows if t == s}) for s in plays}
    gb = len(rows) / (len(plays) + 11)
    naive = {s: (plays[s] - gb) / (users[s] + 7) for s in plays}
    lu, hu, ln, hn = min(users.values()), max(users.values()), min(naive.values()), max(naive.values())
    want = {s: 0.5 * (users[s] - lu) / (hu - lu) + 0.5 * (naive[s] - ln) / (hn - ln) for s in plays}
    assert got.keys() == want.keys()
    assert all(got[s] == pytest.approx(want[s], abs=1e-12) for s in want)
