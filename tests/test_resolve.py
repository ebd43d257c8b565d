from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from tests import brute
from uidloom.functions.fixed import UUID_COLUMNS
from uidloom.operators import match, resolve, valid_uuid
from uidloom.plans.resolution import resolve_valid

T = "A__IDENTIFIES"


def values(df):
    rows = df.select("id", "metadata_table", "user_id", *UUID_COLUMNS).collect()
    return [tuple(r)[1:] for r in sorted(rows, key=lambda r: int(r.id))]


def test_one_row_resolves_all_rows_of_its_user_in_its_table_only(inputs):
    rows = [(T, "1", "ann", None), (T, "1", None, None), ("B", "1", None, None)]
    found = values(resolve.resolve(*inputs(rows, masters=[("9", "ann")])))
    assert [r[3] for r in found] == ["9", "9", None]


def test_rows_without_a_user_are_never_resolved(inputs):
    rows = [(T, None, "ann", "r"), (T, "5", "ann", "r")]
    found = values(resolve.resolve(*inputs(rows, [("5", "ann")], ["5"], [("r", "5")])))
    assert found == [(T, None, None, None, None, None), (T, "5", "5", "5", "5", "5")]


def test_smallest_candidate_wins_and_misses_do_not_count(inputs):
    rows = [(T, "1", "bob", "r1"), (T, "1", "ann", "r2"), (T, "1", "zoe", None)]
    masters = [("30", "bob"), ("4", "ann"), ("30", "ann"), ("5", None)]
    found = values(resolve.resolve(*inputs(rows, masters, [], [("r1", "5"), ("r2", "30"), ("r2", "nobody")])))
    assert {(r[3], r[5]) for r in found} == {("30", "30")}


def test_email_match_is_exact_case(inputs):
    found = values(resolve.resolve(*inputs([(T, "1", "Ann", None)], [("1", "ann")])))
    assert found[0][3] is None


def test_duplicate_masters_and_watch_rows_keep_the_row_count(inputs):
    rows = [(T, "1", "ann", "r")] * 5
    found = values(resolve.resolve(*inputs(rows, [("1", "ann"), ("1", "ann"), ("2", "ann")], ["1", "1"], [("r", "1"), ("r", "1"), ("r", "2")])))
    assert found == [(T, "1", "1", "1", "1", "1")] * 5


def test_rerun_clears_left_join_paths_and_keeps_inner_join_paths(inputs):
    rows, masters, personas, watched = inputs(
        [(T, "1", None, None), (T, "2", None, "r"), (T, None, None, None)], [], ["2"], [("r", "x")]
    )
    old = rows.select("*", *[F.concat(F.lit("old"), F.col("id")).alias(c) for c in UUID_COLUMNS])
    found = values(resolve.resolve(old, masters, personas, watched))
    assert found[0][2:] == (None, None, "old0", "old0")
    assert found[1][2:] == (None, None, None, None)
    assert found[2][2:] == ("old2",) * 4


def test_second_run_gives_the_same_rows(inputs):
    rows, masters, personas, watched = inputs(*brute.random_inputs(random.Random(3), 60))
    first = resolve.resolve(rows, masters, personas, watched)
    assert values(resolve.resolve(first, masters, personas, watched)) == values(first)


def test_columns_of_any_name_survive(inputs):
    rows, masters, personas, watched = inputs([(T, "1", None, None)], [("1", None)])
    rows = rows.select("*", *[F.lit(c).alias(c) for c in ("new", "old", "combo", "fallback", "n_rows", "uuid", "valid_uuid")])
    row = resolve_valid(rows, masters, personas, watched).first()
    assert (row.new, row.old, row.combo, row.fallback, row.n_rows, row.uuid) == ("new", "old", "combo", "fallback", "n_rows", "uuid")
    assert (row.user_id_uuid, row.valid_uuid) == ("1", "1")


def test_empty_input(inputs):
    assert values(resolve.resolve(*inputs())) == []
    assert match.three_phase(*inputs()).count() == 0


@pytest.mark.parametrize(("seed", "hot"), [(0, 0.0), (1, 0.0), (2, 0.4)])
def test_against_brute_force(inputs, seed, hot):
    given = brute.random_inputs(random.Random(seed), 150, hot=hot)
    frames = inputs(*given)
    expected = brute.resolve(*given)
    resolved = resolve.resolve(*frames)
    assert values(resolved) == expected

    paths = {
        "user_id_uuid": resolve.user_id_path(frames[0], frames[1]),
        "username_uuid": resolve.username_path(frames[0], frames[1], resolve.measure_hot_keys(frames[0], frames[3])),
        "persona_uuid": resolve.persona_path(frames[0], frames[2], frames[1]),
        "rid_uuid": resolve.rid_path(frames[0], frames[3], frames[1], resolve.measure_hot_keys(frames[0], frames[3])),
    }
    for position, (name, path) in enumerate(paths.items(), start=2):
        found = {(r.metadata_table, r.user_id): r[name] for r in path.where(f"{name} IS NOT NULL").collect()}
        assert found == {(r[0], r[1]): r[position] for r in expected if r[position] is not None}

    valid, choice = brute.valid(expected)
    rows = resolve_valid(*frames).collect()
    assert [r.valid_uuid for r in sorted(rows, key=lambda r: int(r.id))] == valid
    chosen = {r.metadata_table: (r.combo.split("-") if r.combo else None, r.fallback) for r in valid_uuid.choices(resolved).collect()}
    assert chosen == choice

    by_user = valid_uuid.choices(resolve.user_map(*frames), "n_rows")
    assert sorted(by_user.collect()) == sorted(valid_uuid.choices(resolved).collect())

    phases = match.three_phase(*frames).collect()
    assert [(r.uuid, r.phase) for r in sorted(phases, key=lambda r: int(r.id))] == brute.three_phase(*given)


def test_persona_adds_no_new_value(inputs):
    given = brute.random_inputs(random.Random(5), 100)
    for row in values(resolve.resolve(*inputs(*given))):
        assert row[4] is None or row[4] == row[2] == row[1]


def test_match_rate(inputs):
    rows, masters, _, _ = inputs([(T, "1", None, None)] * 3 + [(T, "2", None, None), (T, None, None, None)], [("1", None), ("1", None)])
    assert match.match_rate(rows, "user_id", masters, "uuid").first().asDict() == {
        "n_values": 4, "n_matched": 3, "match_percent": 75.0,
    }
    assert match.match_rate(rows, "email", masters, "username").first().match_percent == 0.0
