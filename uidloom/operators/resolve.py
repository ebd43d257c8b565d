"""Resolve every user of an identifies table to a master user, through four join paths.

Frames, all columns strings:
  rows      identifies calls: metadata_table, user_id, email, rid, and any others
  masters   master users: uuid, username
  personas  persona users: id
  watched   watch log: rid, user_id

Resolution is per (metadata_table, user_id): what one row of a user finds holds for all rows of that user
in that table. Rows without a user id are never resolved. Of several candidates the smallest one is taken.
So the work is done on one row per user, and the wide rows move once, in ``write_back``.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Collection, Mapping

from pyspark.sql import Column, DataFrame, Observation, functions as F

from uidloom.functions.fixed import UUID_COLUMNS
from uidloom.functions.frames import has_column, present
from uidloom.operators.screen import key_filter, may_hold
from uidloom.operators.skew import HotKeys, hot_keys, split_join, spread_join
from uidloom.sources.session import materialize

USER = ["metadata_table", "user_id"]
KEYS = ["user_id", "email", "rid"]
HITS = {"persona_uuid": "persona_hit", "rid_uuid": "rid_hit"}
NEW, OLD = "_new", "_old"
Screens = dict[str, Column]
"""Per key column a filter of the lookup's keys."""
ROW = "-"
"""Among the candidates of a user, the one that counts its rows; emails start with e, and rids with r."""


def measure_hot_keys(rows: DataFrame, watched: DataFrame) -> HotKeys:
    """The hot values of every join key of the paths, under the names the path functions expect."""
    keys = rows.select(*present(rows, KEYS)).unionByName(
        watched.select(F.col("user_id").alias("watched")), allowMissingColumns=True
    )
    return {name: {} for name in KEYS} | hot_keys(keys, keys.columns)


def master_ids(masters: DataFrame) -> DataFrame:
    """Each master id once."""
    return masters.where("uuid IS NOT NULL").select("uuid").distinct()


def master_names(masters: DataFrame) -> DataFrame:
    """The smallest master id of each username."""
    named = masters.where("uuid IS NOT NULL AND username IS NOT NULL")
    return named.groupBy("username").agg(F.min("uuid").alias("uuid"))


def watched_masters(watched: DataFrame, masters: DataFrame, hot_users: Mapping[str, int]) -> DataFrame:
    """Per watched rid its smallest master id; null for a rid without one."""
    pairs = watched.where("rid IS NOT NULL").select("rid", "user_id").distinct()
    ids = master_ids(masters).select(F.col("uuid").alias("user_id"), F.col("uuid").alias("rid_uuid"))
    return spread_join(pairs, ids, "user_id", hot_users).groupBy("rid").agg(F.min("rid_uuid").alias("rid_uuid"))


def user_keys(rows: DataFrame) -> DataFrame:
    """One row per user and table with its row count; rows without a user id count under a null one."""
    return rows.groupBy(*USER).agg(F.count(F.lit(1)).alias("n_rows"))


def _name_candidates(rows: DataFrame, masters: DataFrame, hot: HotKeys) -> DataFrame:
    emails = rows.where("user_id IS NOT NULL AND email IS NOT NULL").select(*USER, "email").distinct()
    names = master_names(masters).select(F.col("username").alias("email"), F.col("uuid").alias("username_uuid"))
    return spread_join(emails, names, "email", hot["email"], "inner").select(*USER, "username_uuid")


def _rid_candidates(rows: DataFrame, watched: DataFrame, masters: DataFrame, hot: HotKeys) -> DataFrame:
    rids = rows.where("user_id IS NOT NULL AND rid IS NOT NULL").select(*USER, "rid").distinct()
    seen = spread_join(rids, watched_masters(watched, masters, hot["watched"]), "rid", hot["rid"], "inner")
    return seen.select(*USER, "rid_uuid", F.lit(True).alias("rid_hit"))


def _with_user_id_uuid(users: DataFrame, masters: DataFrame) -> DataFrame:
    ids = master_ids(masters).select(F.col("uuid").alias("user_id"), F.col("uuid").alias("user_id_uuid"))
    return users.join(ids, "user_id", "left")


def _with_persona(users: DataFrame, personas: DataFrame) -> DataFrame:
    """Needs ``user_id_uuid``: a persona user's master id can only be the user id itself."""
    ids = personas.where("id IS NOT NULL").select(F.col("id").alias("user_id")).distinct()
    joined = users.join(ids.withColumn("persona_hit", F.lit(True)), "user_id", "left")
    return joined.withColumn("persona_uuid", F.when(F.col("persona_hit"), F.col("user_id_uuid")))


def user_id_path(rows: DataFrame, masters: DataFrame) -> DataFrame:
    """Per user and table: ``user_id_uuid``, the master whose id is the user id."""
    return _with_user_id_uuid(rows.select(*USER).distinct(), masters).select(*USER, "user_id_uuid")


def username_path(rows: DataFrame, masters: DataFrame, hot: HotKeys) -> DataFrame:
    """Per user and table with a match: ``username_uuid``, the master whose username is an email of the user."""
    found = _name_candidates(rows, masters, hot)
    return found.groupBy(*USER).agg(F.min("username_uuid").alias("username_uuid"))


def persona_path(rows: DataFrame, personas: DataFrame, masters: DataFrame) -> DataFrame:
    """Per user and table: ``persona_uuid`` and whether the user is a persona user at all."""
    users = _with_user_id_uuid(rows.select(*USER).distinct(), masters)
    return _with_persona(users, personas).select(*USER, "persona_uuid", "persona_hit")


def rid_path(rows: DataFrame, watched: DataFrame, masters: DataFrame, hot: HotKeys) -> DataFrame:
    """Per user and table with a watched rid: ``rid_uuid``, the smallest master id in the watch log."""
    found = _rid_candidates(rows, watched, masters, hot)
    return found.groupBy(*USER).agg(F.min("rid_uuid").alias("rid_uuid"), F.max("rid_hit").alias("rid_hit"))


def _kinds(rows: DataFrame) -> dict[str, str]:
    return {"e": "email", "r": "rid"} if has_column(rows, "rid") else {"e": "email"}


def key_screens(masters: DataFrame, watched: DataFrame) -> Screens:
    """Filters of the usernames of masters and of the watched rids, as scalar subqueries."""
    named = masters.where("uuid IS NOT NULL")
    return {"email": key_filter(named, "username").scalar(), "rid": key_filter(watched, "rid").scalar()}


def user_entries(rows: DataFrame, screens: Screens | None = None) -> DataFrame:
    """(metadata_table, user_id, candidate, n_rows): of each user its rows, emails and rids, equal ones together.

    This is all that the map of users needs of the rows, and it takes one scan of their key columns. With ``screens``
    emails and rids that no lookup holds are left out at the scan.
    """

    def candidate(kind: str, column: str) -> Column:
        key = F.concat(F.lit(kind), F.col(column))
        return F.when(may_hold(screens[column], F.col(column)), key) if screens else key

    keys = F.array(F.lit(ROW), *[candidate(kind, column) for kind, column in _kinds(rows).items()])
    listed = rows.select(*USER, F.explode(F.array_compact(keys)).alias("candidate"))
    entries = listed.groupBy(*USER, "candidate").agg(F.count(F.lit(1)).alias("n_rows"))
    return entries.where((F.col("candidate") == ROW) | F.col("user_id").isNotNull())


def measured_entries(rows: DataFrame, watched: DataFrame, screens: Screens | None = None) -> tuple[DataFrame, HotKeys]:
    """The entries of the rows, written, and from them the hot keys as ``measure_hot_keys`` gives them.

    Users count by their exact rows in a table, and emails and rids by the entries that meet the lookup. The rows are
    read once, and all of them are counted while the entries are written.
    """
    is_row = F.col("candidate") == ROW
    written = Observation(f"entries_{uuid.uuid4().hex}")
    n_rows = F.coalesce(F.sum(F.when(is_row, F.col("n_rows"))), F.lit(0)).alias("n_rows")
    entries = materialize(user_entries(rows, screens).observe(written, n_rows), "entries")
    value, kind = F.expr("substring(candidate, 2)"), F.left("candidate", F.lit(1))
    keys = entries.where(~is_row).select(
        F.when(kind == "e", value).alias("email"), F.when(kind == "r", value).alias("rid")
    ).unionByName(watched.select(F.col("user_id").alias("watched")), allowMissingColumns=True)
    users = ("user_id", entries.where(is_row), written.get["n_rows"])
    return entries, hot_keys(keys, keys.columns, users)


def mapped_users(
    rows: DataFrame,
    masters: DataFrame,
    personas: DataFrame,
    watched: DataFrame,
    hot: HotKeys | None = None,
    screened: bool = False,
) -> tuple[DataFrame, HotKeys]:
    """The user map, and the hot keys: those given, or else measured on the entries, which are written for that."""
    screens = key_screens(masters, watched) if screened else None
    entries, hot = (user_entries(rows, screens), hot) if hot is not None else measured_entries(rows, watched, screens)
    return _users_of(entries, masters, personas, watched, hot, _kinds(rows)), hot


def user_map(
    rows: DataFrame,
    masters: DataFrame,
    personas: DataFrame,
    watched: DataFrame,
    hot: HotKeys | None = None,
    screened: bool = False,
) -> DataFrame:
    """All four paths at once: one row per (metadata_table, user_id) with its row count.

    The rows are read once: each gives its user, and its email and rid as candidates of the user, and equal
    ones fall together before the shuffle. Emails and rids meet their two lookups in one join. Where the
    rows have no rid, that path does not run and its column is null.
    """
    return mapped_users(rows, masters, personas, watched, hot)[0]


def _users_of(
    entries: DataFrame,
    masters: DataFrame,
    personas: DataFrame,
    watched: DataFrame,
    hot: HotKeys,
    kinds: Mapping[str, str],
) -> DataFrame:
    def lookup(kind: str, frame: DataFrame, key: str, value: str) -> DataFrame:
        return frame.select(F.concat(F.lit(kind), key).alias("candidate"), F.col(value).alias("uuid"), F.lit(True).alias("hit"))

    known = lookup("e", master_names(masters), "username", "uuid")
    if "r" in kinds:
        known = known.unionByName(lookup("r", watched_masters(watched, masters, hot["watched"]), "rid", "rid_uuid"))
    shares = {kind + value: n for kind, column in kinds.items() for value, n in hot[column].items()}
    entries = entries.withColumn("candidate", F.when(F.col("candidate") != ROW, F.col("candidate")))
    matched = spread_join(entries, known, "candidate", shares)  # the rows' own entries have no key, and are spread
    by_rid = F.startswith("candidate", F.lit("r"))
    users = matched.groupBy(*USER).agg(
        F.sum(F.when(F.col("candidate").isNull(), F.col("n_rows"))).alias("n_rows"),
        F.min(F.when(~by_rid, F.col("uuid"))).alias("username_uuid"),
        F.min(F.when(by_rid, F.col("uuid"))).alias("rid_uuid"),
        F.max(F.when(by_rid & F.col("hit"), F.lit(True))).alias("rid_hit"),
    )
    users = _with_persona(_with_user_id_uuid(users, masters), personas)
    return users.select(*USER, "n_rows", *UUID_COLUMNS, *HITS.values())


def _updated(rows: DataFrame, name: str) -> Column:
    """The value of a column after a run.

    A left-join path reaches every row with a user id and clears a value that has no match any more; an
    inner-join path reaches only users with a hit and keeps the value of all others.
    """
    new = F.col(f"{NEW}.{name}")
    if not has_column(rows, name):
        return new
    reached = F.col(f"{NEW}.{HITS[name]}") if name in HITS else F.col("user_id").isNotNull()
    return F.when(reached, new).otherwise(F.col(f"{OLD}.{name}"))


def write_back(rows: DataFrame, users: DataFrame, hot_users: Collection[str]) -> DataFrame:
    """Give every row the values of its user; the number of rows stays the same.

    Without hot users the rows are read once, and those without a user are spread by a hash of the row. With
    hot users the rows are read twice: those of hot users stay where they are. Either way gives the same rows.
    See ``write_back_by`` for the values.
    """

    def join(wide: DataFrame, narrow: DataFrame) -> DataFrame:
        if hot_users:
            return split_join(wide, narrow, USER, "user_id", hot_users)
        return spread_join(wide, narrow, "user_id", {}, on=USER)

    return write_back_by(rows, users, join)


def write_back_by(rows: DataFrame, users: DataFrame, join: Callable[[DataFrame, DataFrame], DataFrame]) -> DataFrame:
    """Give every row the values of its user by a left join of rows and users on table and user id.

    ``users`` holds one row per (metadata_table, user_id) with any of the UUID columns. UUID columns that
    the rows have from an earlier run are cleared or kept as ``_updated`` says.
    """
    names = [c for c in users.columns if c in UUID_COLUMNS]
    extra = [c for c in users.columns if c.endswith("_uuid") and c not in UUID_COLUMNS]
    hits = [HITS[c] for c in names if c in HITS and has_column(rows, c)]
    new = F.struct(*names, *extra, *hits).alias(NEW)
    kept = [c for c in rows.columns if c.lower() not in {*names, *extra}]
    previous = present(rows, names)
    old = [F.struct(*previous).alias(OLD)] if previous else []
    return join(rows.select(*kept, *old), users.select(*USER, new)).select(
        *kept,
        *[_updated(rows, name).alias(name) for name in names],
        *[F.col(f"{NEW}.{name}").alias(name) for name in extra],
    )


def resolve(
    rows: DataFrame,
    masters: DataFrame,
    personas: DataFrame,
    watched: DataFrame,
    hot: HotKeys | None = None,
) -> DataFrame:
    """The rows of all tables with their four UUID columns."""
    users, hot = mapped_users(rows, masters, personas, watched, hot)
    if hot["user_id"]:
        users = materialize(users, "user_map")  # read for the hot and for all other users
    return write_back(rows, users, hot["user_id"])


def users_after(rows: DataFrame, users: DataFrame, hot_users: Collection[str]) -> DataFrame:
    """One row for each user and set of earlier UUIDs in the rows, as it is after a run, with its row count.

    It stands for the wide rows wherever only their users and UUIDs count.
    """
    earlier = present(rows, UUID_COLUMNS)
    seen = rows.groupBy(*USER, *earlier).agg(F.count(F.lit(1)).alias("n_rows"))
    return write_back(seen, users.drop("n_rows"), hot_users)
