from pyspark.sql import functions as F

from trilayer.operators.reconcile import (
    explode_roles,
    name_conflicts,
    next_roles,
    next_workspaces,
    provision_summary,
    reconcile_roles,
    reconcile_workspaces,
    resolve_ids,
    role_transition,
    validate_specs,
)

STRICT = "12345678-1234-1234-1234-123456789abc"
LOOSE = "1234567812341234123412345678-9abcdef"  # 36 hex digits and dashes, not in the strict form


def test_resolve_ids(spark):
    assert len(LOOSE) == 36
    directory = spark.createDataFrame(
        [("id-2", "Sales", 2), ("id-1", "Sales", 1), ("id-3", None, 0)], "id string, display_name string, ordinal int"
    )
    specs = spark.createDataFrame([(i, v) for i, v in enumerate([STRICT, LOOSE, "Sales", "sales", "", None])], "k int, cap string")
    for loose, second in ((False, (None, f"not found by display name: '{LOOSE}'")), (True, (LOOSE, None))):
        got = resolve_ids(specs, directory, "cap", "cap_id", "ordinal", loose=loose)
        assert [(r.cap_id, r.cap_id_error) for r in got.orderBy("k").collect()] == [
            (STRICT, None), second, ("id-1", None), (None, "not found by display name: 'sales'"), (None, None), (None, None),
        ]


def test_explode_roles_and_summary(spark):
    specs = spark.createDataFrame(
        [("ws", "admins", "", None, "view")],
        "name string, group_platform_admins string, group_data_product_owners string, group_data_engineers string, group_data_viewers string",
    )
    roles = explode_roles(specs, "name")
    got = {r.role_key: (r.desired_role, r.reason) for r in roles.collect()}
    assert got == {
        "platform_admins": ("Admin", None),
        "data_product_owners": ("Member", "Missing group mapping for key 'data_product_owners'"),
        "data_engineers": ("Contributor", "Missing group mapping for key 'data_engineers'"),
        "data_viewers": ("Viewer", None),
    }
    summary = provision_summary(roles.withColumn("principal_id", F.concat(F.lit("gid-"), "group_name")), "name").first()
    assert summary.roles_assigned == {"platform_admins": "gid-admins", "data_viewers": "gid-view"}
    assert set(summary.roles_failed) == {"data_product_owners", "data_engineers"}


def test_reconcile_roles(spark):
    desired = spark.createDataFrame(
        [("w", "new", "Admin"), ("w", "same", "Admin"), ("w", "other", "Admin"), ("w2", "same", "Viewer"), ("w", "twice", "Viewer")],
        "workspace_id string, principal_id string, desired_role string",
    )
    current = spark.createDataFrame(
        [("w", "same", "Admin", 1), ("w", "other", "Viewer", 2), ("w", "extra", "Admin", 3), ("w", None, "Admin", 4),
         ("w", "twice", "Admin", 5), ("w", "twice", "Viewer", 6)],
        "workspace_id string, principal_id string, role string, ordinal int",
    )
    got = {(r.workspace_id, r.principal_id): r.action for r in reconcile_roles(desired, current, "ordinal").collect()}
    assert got == {
        ("w", "new"): "add", ("w", "same"): "unchanged", ("w", "other"): "update", ("w2", "same"): "add", ("w", "twice"): "unchanged",
    }


def test_reconcile_workspaces(spark):
    fields = "description string, capacity_id string, domain_id string"
    desired = spark.createDataFrame([
        ("new", "d", "cap-1", "dom-1"), ("same", "d", "cap-1", "dom-1"), ("moved", "", "cap-2", "dom-2"), ("text", "e", None, ""),
    ], "name string, " + fields)
    current = spark.createDataFrame([
        ("1", "same", "d", "cap-1", "dom-1", 1), ("2", "moved", "d", "cap-1", None, 2), ("3", "text", None, "cap-1", "dom-1", 3),
        ("4", "same", "x", "cap-9", "dom-9", 4),
    ], "id string, display_name string, " + fields + ", ordinal int")
    got = {r.name: (r.workspace_id, r.workspace_action, r.capacity_action, r.domain_action) for r in reconcile_workspaces(desired, current, "ordinal").collect()}
    assert got == {
        "new": (None, "create", "set_at_creation", "assign"),
        "same": ("1", "unchanged", "unchanged", "unchanged"),
        "moved": ("2", "unchanged", "assign", "assign"),
        "text": ("3", "update", None, None),
    }


def test_validate_specs(spark):
    groups = {f"group_{k}": "g" for k in ("platform_admins", "data_product_owners", "data_engineers", "data_viewers")}
    cases = [
        ({"name": "abc", "description": None}, []),
        ({"name": "ab", "description": "x" * 1024}, ["name shorter than 3"]),
        ({"name": "x" * 129, "description": "x" * 1025}, ["name longer than 128", "description longer than 1024"]),
        ({"name": None, "description": "", "group_data_viewers": None}, ["name is required", "group_data_viewers is required"]),
    ]
    columns = ["name", "description", *groups]
    data = [tuple({**groups, **case}[c] for c in columns) for case, _ in cases]
    got = validate_specs(spark.createDataFrame(data, ", ".join(f"{c} string" for c in columns))).collect()
    assert [r.violations for r in got] == [wanted for _, wanted in cases]


def states(rows_):
    return sorted(((r.workspace_id, r.principal_id, r.action, r.next_role) for r in rows_.collect()), key=repr)


def test_a_second_transition_changes_nothing(spark):
    desired = spark.createDataFrame(
        [(1, "a", "Admin"), (1, "b", "Viewer"), (1, "c", "Admin"), (1, "c", "Viewer"), (2, "c", "Admin"), (2, "c", "Viewer"), (1, "d", "Member"), (1, "d", "Member"), (None, "x", "Admin"), (1, None, "Admin"), (1, "e", None)],
        "workspace_id int, principal_id string, desired_role string",
    )
    current = spark.createDataFrame(
        [(1, "b", "Admin", 1), (1, "b", "Viewer", 2), (1, "c", "Member", 1), (1, "z", "Viewer", 1), (1, "d", "Admin", 1), (3, "q", None, 1), (None, "n", "Admin", 1)],
        "workspace_id int, principal_id string, role string, ordinal int",
    )
    moved = role_transition(desired, current, "ordinal")
    assert states(moved) == [
        (1, "a", "add", "Admin"), (1, "b", "unchanged", "Viewer"), (1, "c", "conflict", "Member"), (1, "d", "update", "Member"),
        (1, "z", "kept", "Viewer"), (2, "c", "conflict", None), (3, "q", "kept", None),
    ]
    after = next_roles(moved)
    again = role_transition(desired, after.selectExpr("*", "0 AS ordinal"), "ordinal")
    assert {r.action for r in again.collect()} == {"unchanged", "kept", "conflict"}
    assert sorted(map(tuple, next_roles(again).collect())) == sorted(map(tuple, after.collect()))


def test_workspaces_settle_after_one_run(spark):
    desired = spark.createDataFrame(
        [("n", "text", "cap", None), ("m", "", None, "dom"), ("m", "", None, "dom"), ("twice", "a", None, None), ("twice", "b", None, None), ("same", "d", "c", "o"), (None, "x", None, None)],
        "name string, description string, capacity_id string, domain_id string",
    )
    current = spark.createDataFrame(
        [("1", "m", "kept", "cap0", None), ("2", "m", "other", None, None), ("3", "twice", "t", None, None), ("4", "same", "d", "c", "o"), ("5", None, None, None, None)],
        "id string, display_name string, description string, capacity_id string, domain_id string",
    )
    after = next_workspaces(desired, current, "id")
    got = {r.id: tuple(r)[1:] for r in after.collect()}
    new = next(i for i in got if len(i) == 36)
    assert got.pop(new) == ("n", "text", "cap", None, "created")
    assert got == {
        "1": ("m", "kept", "cap0", "dom", "changed"), "2": ("m", "other", None, None, "kept"), "3": ("twice", "t", None, None, "kept"),
        "4": ("same", "d", "c", "o", "kept"), "5": (None, None, None, None, "kept"),
    }
    assert [tuple(r) for r in name_conflicts(desired).collect()] == [("twice", 2)]
    again = next_workspaces(desired, after.drop("action"), "id")
    assert {r.action for r in again.collect()} == {"kept"}
    assert sorted(tuple(r)[:5] for r in again.fillna("").collect()) == sorted(tuple(r)[:5] for r in after.fillna("").collect())
