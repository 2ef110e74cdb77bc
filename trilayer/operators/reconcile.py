"""Desired against current state, for all workspaces at once.

Each function answers what would have to change, or what there is once it has; none changes anything.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from trilayer.operators.dedupe import dedupe
from trilayer.operators.joins import keyed_left_join

# The role each group of a workspace gets.
ROLES = {
    "platform_admins": "Admin",
    "data_product_owners": "Member",
    "data_engineers": "Contributor",
    "data_viewers": "Viewer",
}

# What counts as an id. Directories of groups use the loose form.
STRICT_ID = "^[0-9a-fA-F]{8}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{12}$"
LOOSE_ID = "^[0-9a-fA-F-]{36}$"

# Limits of a workspace specification.
NAME_LENGTH, DESCRIPTION_LENGTH = (3, 128), 1024


def _first_by_name(directory: DataFrame, id_: str, name: str, ordinal: str) -> DataFrame:
    wanted = directory.select(F.col(name).alias("_name"), F.col(ordinal).alias("_ordinal"), F.col(id_).alias("_id"))
    return dedupe(wanted.where(F.col("_name").isNotNull()), ["_name"], ["_ordinal"]).select("_name", "_id")


def resolve_ids(
    specs: DataFrame, directory: DataFrame, column: str, out: str, ordinal: str, loose: bool = False
) -> DataFrame:
    """Turn the id or display name in ``column`` into an id in ``out``.

    ``directory`` has ``id``, ``display_name`` and ``ordinal``; names match exactly and
    the lowest ordinal wins. An empty value stays NULL; an unknown name leaves NULL
    and a reason in ``{out}_error``.
    """
    value = F.col(column)
    given, is_id = F.coalesce(value != "", F.lit(False)), value.rlike(LOOSE_ID if loose else STRICT_ID)
    names = _first_by_name(directory, "id", "display_name", ordinal)
    found = keyed_left_join(specs, names, [(column, "_name")])
    # An id that also happens to be a name stays an id.
    resolved = F.when(given, F.when(is_id, value).otherwise(F.col("_id")))
    missing = given & resolved.isNull()
    return found.withColumns({
        out: resolved,
        f"{out}_error": F.when(missing, F.concat(F.lit("not found by display name: '"), value, F.lit("'"))),
    }).drop("_name", "_id")


def explode_roles(specs: DataFrame, key: str) -> DataFrame:
    """One row per workspace and role; the groups are in columns named ``group_{role key}``."""
    group = lambda k: F.col(f"group_{k}")
    rows = F.array(*[
        F.struct(F.lit(k).alias("role_key"), F.lit(role).alias("desired_role"), group(k).alias("group_name"))
        for k, role in ROLES.items()
    ])
    missing = F.col("group_name").isNull() | (F.col("group_name") == "")
    reason = F.concat(F.lit("Missing group mapping for key '"), F.col("role_key"), F.lit("'"))
    return specs.select(key, F.inline(rows)).withColumn("reason", F.when(missing, reason))


def reconcile_roles(desired: DataFrame, current: DataFrame, ordinal: str) -> DataFrame:
    """``add``, ``update`` or ``unchanged`` per desired (workspace_id, principal_id).

    Assignments nobody asked for are left alone. Of several current assignments
    of one principal the one with the highest ``ordinal`` counts.
    """
    held = current.where(F.col("principal_id").isNotNull()).groupBy("workspace_id", "principal_id").agg(
        F.max_by("role", ordinal).alias("current_role")
    )
    held = held.select(
        F.col("workspace_id").alias("_ws"), F.col("principal_id").alias("_principal"),
        "current_role", F.lit(True).alias("_held"),
    )
    joined = keyed_left_join(desired, held, [("workspace_id", "_ws"), ("principal_id", "_principal")])
    action = (
        F.when(F.col("_held").isNull(), "add")
        .when(F.col("current_role").eqNullSafe(F.col("desired_role")), "unchanged")
        .otherwise("update")
    )
    return joined.withColumn("action", action).drop("_ws", "_principal", "_held")


def reconcile_workspaces(desired: DataFrame, current: DataFrame, ordinal: str) -> DataFrame:
    """What each desired workspace needs, matched by display name.

    ``desired``: name, description, capacity_id, domain_id. ``current``: id,
    display_name, description, capacity_id, domain_id. A new workspace is created on
    its capacity, so that needs no assignment; its domain still does.
    """
    facts = ["id", "description", "capacity_id", "domain_id"]
    known = current.where(F.col("display_name").isNotNull()).select(
        F.col("display_name").alias("_name"), F.col(ordinal).alias("_ordinal"),
        *[F.col(c).alias(f"_{c}") for c in facts],
    )
    joined = keyed_left_join(desired, dedupe(known, ["_name"], ["_ordinal"]), [("name", "_name")])
    is_new = F.col("_name").isNull()
    described = F.coalesce(F.col("description") != "", F.lit(False))
    return joined.select(
        *desired.columns,
        F.col("_id").alias("workspace_id"),
        F.when(is_new, "create")
        .when(described & ~F.col("description").eqNullSafe(F.col("_description")), "update")
        .otherwise("unchanged").alias("workspace_action"),
        _assignment("capacity_id", is_new, new="set_at_creation").alias("capacity_action"),
        _assignment("domain_id", is_new, new="assign").alias("domain_action"),
    )


def _assignment(c: str, is_new: Column, new: str) -> Column:
    change = F.when(is_new, new).when(F.col(c) == F.col(f"_{c}"), "unchanged").otherwise("assign")
    return F.when(F.coalesce(F.col(c) != "", F.lit(False)), change)


def role_transition(desired: DataFrame, current: DataFrame, ordinal: str) -> DataFrame:
    """What each assignment was, what is asked for and what it is next, one row per (workspace_id, principal_id) of either side.

    ``add``, ``update`` and ``unchanged`` as in ``reconcile_roles``; ``kept`` where nobody asked for the principal. Two desired rows
    that give one principal different roles are a ``conflict``: no order among them would make a second run agree with
    the first, so what the principal holds stays, and ``desired_roles`` names all of them. Rows without a workspace, a principal or a
    desired role ask for nothing. ``next_role`` is NULL where nothing is held next.
    """
    # At most the fixed roles are collected per principal.
    asked = desired.where(F.col("workspace_id").isNotNull() & F.col("principal_id").isNotNull() & F.col("desired_role").isNotNull())
    asked = asked.groupBy("workspace_id", "principal_id").agg(F.array_sort(F.collect_set("desired_role")).alias("desired_roles"))
    held = current.where(F.col("workspace_id").isNotNull() & F.col("principal_id").isNotNull())
    held = held.groupBy("workspace_id", "principal_id").agg(F.max_by("role", ordinal).alias("current_role"), F.lit(True).alias("_held"))
    both = asked.join(held, ["workspace_id", "principal_id"], "full")
    only = F.element_at("desired_roles", 1)
    action = (
        F.when(F.col("desired_roles").isNull(), "kept")
        .when(F.size("desired_roles") > 1, "conflict")
        .when(F.col("_held").isNull(), "add")
        .when(F.col("current_role").eqNullSafe(only), "unchanged")
        .otherwise("update")
    )
    after = F.when(action.isin("add", "update"), only).otherwise(F.col("current_role"))
    return both.select("workspace_id", "principal_id", "current_role", "desired_roles", action.alias("action"), after.alias("next_role"))


def next_roles(transition: DataFrame) -> DataFrame:
    """The assignments once a transition is applied: ``workspace_id, principal_id, role``.

    As ``current`` of the same desired rows it gives ``unchanged``, ``kept`` and ``conflict`` only.
    """
    return transition.where(F.col("next_role").isNotNull()).select("workspace_id", "principal_id", F.col("next_role").alias("role"))


def name_conflicts(desired: DataFrame) -> DataFrame:
    """``name, specs``: desired workspaces of one name that differ, and in how many ways."""
    facts = F.struct("description", "capacity_id", "domain_id")
    per_name = desired.where(F.col("name").isNotNull()).groupBy("name").agg(F.count_distinct(F.to_json(facts)).alias("specs"))
    return per_name.where("specs > 1")


def next_workspaces(desired: DataFrame, current: DataFrame, ordinal: str, new_id: Column | None = None) -> DataFrame:
    """The workspaces once the actions of ``reconcile_workspaces`` are applied: ``id, display_name, description, capacity_id, domain_id, action``.

    Desired rows of one name that agree count once, those that differ are applied by none (``name_conflicts``). ``action`` is ``created``,
    ``changed`` or ``kept``. New workspaces get ``new_id`` (over ``name``; by default an id made of its MD5), so a run that is
    repeated creates the same. What the desired row leaves empty stays as it is.
    """
    facts = ["description", "capacity_id", "domain_id"]
    if new_id is None:
        h = F.md5("name")
        new_id = F.concat_ws("-", *[h.substr(a, n) for a, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))])
    per_name = desired.where(F.col("name").isNotNull()).groupBy("name").agg(
        F.min(F.struct(*facts)).alias("least"), F.max(F.struct(*facts)).alias("most")
    )
    wanted = per_name.where(F.col("least").eqNullSafe(F.col("most"))).select("name", *[F.col(f"least.{c}").alias(f"_{c}") for c in facts])
    first = current.where(F.col("display_name").isNotNull()).groupBy("display_name").agg(F.min_by("id", F.struct(F.col(ordinal).alias("ordinal"), F.col("id").alias("tie"))).alias("_id"))
    first = first.select(F.col("display_name").alias("_name"), "_id")
    matched = keyed_left_join(wanted, first, [("name", "_name")])
    given = {c: F.when(F.col(f"_{c}") != "", F.col(f"_{c}")) for c in facts}
    existing = keyed_left_join(current, matched.where("_name is not null").drop("_name"), [("id", "_id")])
    after = {c: F.coalesce(given[c], F.col(c)) for c in facts}
    changed = F.lit(False)
    for c in facts:
        changed = changed | ~after[c].eqNullSafe(F.col(c))
    existing = existing.select("id", "display_name", *[after[c].alias(c) for c in facts], F.when(changed, "changed").otherwise("kept").alias("action"))
    id_type = dict(current.dtypes)["id"]
    new = matched.where("_name is null").select(
        new_id.cast(id_type).alias("id"), F.col("name").alias("display_name"), *[given[c].alias(c) for c in facts], F.lit("created").alias("action")
    )
    return existing.unionByName(new)


def validate_specs(specs: DataFrame) -> DataFrame:
    """Add ``violations``, the list of rules a specification breaks; empty when valid."""
    low, high = NAME_LENGTH
    rules = {
        "name is required": F.col("name").isNull(),
        f"name shorter than {low}": F.length("name") < low,
        f"name longer than {high}": F.length("name") > high,
        f"description longer than {DESCRIPTION_LENGTH}": F.length("description") > DESCRIPTION_LENGTH,
        **{f"group_{k} is required": F.col(f"group_{k}").isNull() for k in ROLES},
    }
    broken = F.array(*[F.when(condition, F.lit(rule)) for rule, condition in rules.items()])
    return specs.withColumn("violations", F.array_compact(broken))


def provision(specs: DataFrame, groups: DataFrame, current: DataFrame, key: str, ordinal: str) -> DataFrame:
    """One row per workspace and role: the group's id, what has to be done, or the reason why it cannot be.

    ``specs`` as for ``explode_roles``, ``groups`` as the directory of ``resolve_ids`` and ``current`` as for
    ``reconcile_roles``, all with ``ordinal``. A group that is missing or unknown has a reason and no action.
    """
    wanted = resolve_ids(explode_roles(specs, key), groups, "group_name", "principal_id", ordinal, loose=True)
    wanted = wanted.withColumn("reason", F.coalesce("reason", "principal_id_error")).drop("principal_id_error")
    rows = reconcile_roles(wanted.withColumnRenamed(key, "workspace_id"), current, ordinal)
    rows = rows.withColumn("action", F.when(F.col("reason").isNull(), F.col("action")))
    return rows.withColumnRenamed("workspace_id", key)


def provision_summary(outcomes: DataFrame, key: str) -> DataFrame:
    """Per workspace: map of role key to principal, and map of role key to reason of failure.

    The role keys are fixed, so each is an aggregate of its own and nothing is
    collected, however many rows a workspace has.
    """
    assigned, failed = {}, {}
    for k in ROLES:
        mine = F.col("role_key") == k
        assigned[k] = F.max(F.when(mine & F.col("reason").isNull(), F.col("principal_id")))
        failed[k] = F.max(F.when(mine, F.col("reason")))
    wide = outcomes.groupBy(key).agg(
        *[c.alias(f"_ok_{k}") for k, c in assigned.items()],
        *[c.alias(f"_bad_{k}") for k, c in failed.items()],
    )
    return wide.select(
        key,
        _map_of({k: F.col(f"_ok_{k}") for k in ROLES}).alias("roles_assigned"),
        _map_of({k: F.col(f"_bad_{k}") for k in ROLES}).alias("roles_failed"),
    )


def _map_of(values: dict[str, Column]) -> Column:
    entries = [F.when(v.isNotNull(), F.struct(F.lit(k).alias("key"), v.alias("value"))) for k, v in values.items()]
    return F.map_from_entries(F.array_compact(F.array(*entries)))
