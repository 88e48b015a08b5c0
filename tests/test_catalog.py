from __future__ import annotations

from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from quartermet.functions.ranking import numbered
from quartermet.operators import catalog
from tests.util import one

START = datetime(2024, 1, 1)


def requests(spark, rows):
    """Rows: (schema, fields, mode); fields name -> (default, required, type)."""
    data = [
        (i, name, fields, f"r{i}", mode, START + timedelta(hours=i), "me")
        for i, (name, fields, mode) in enumerate(rows)
    ]
    return spark.createDataFrame(
        data,
        f"request_id long, schema_name string, fields {catalog.FIELDS_TYPE}, description string, "
        "compatibility_mode string, created_at timestamp, created_by string",
    )


REQUIRED = (None, True, "double")
OPTIONAL = (None, False, "double")
DEFAULTED = ("0", True, "double")


def test_identical_schema_keeps_its_version(spark):
    r = requests(spark, [
        ("s", {"a": REQUIRED, "b": OPTIONAL}, "NONE"),
        ("s", {"b": OPTIONAL, "a": REQUIRED}, "NONE"),  # order of fields does not matter
        ("s", {"a": REQUIRED}, "NONE"),
        ("t", {"a": REQUIRED}, "NONE"),
    ])
    registry = catalog.register_schemas(None, r)
    got = sorted((x.schema_name, x.version, x.description) for x in registry.collect())
    assert got == [("s", 1, "r0"), ("s", 2, "r2"), ("t", 1, "r3")]
    given = {x.request_id: x.version for x in catalog.assigned_versions(registry, r).collect()}
    assert given == {0: 1, 1: 1, 2: 2, 3: 1}
    again = catalog.register_schemas(registry, r)
    assert again.count() == 0
    more = requests(spark, [("s", {"c": OPTIONAL}, "NONE"), ("u", {"c": OPTIONAL}, "NONE")])
    got = sorted((x.schema_name, x.version) for x in catalog.register_schemas(registry, more).collect())
    assert got == [("s", 3), ("u", 1)]


def test_registry_is_never_broadcast(spark, tmp_path):
    """A registry of repeated definitions is a small file and a large table."""
    r = requests(spark, [("s", {"a": REQUIRED}, "NONE"), ("t", {"b": OPTIONAL}, "NONE")])
    catalog.register_schemas(None, r).write.parquet(str(tmp_path / "registry"))
    registry = spark.read.parquet(str(tmp_path / "registry"))
    more = requests(spark, [("s", {"c": OPTIONAL}, "NONE"), ("t", {"b": OPTIONAL}, "NONE")])
    added = catalog.register_schemas(registry, more)
    off = registry.select("schema_name", "version")
    for made in (
        added, catalog._new_definitions(registry, more), catalog.consecutive_versions(registry),
        catalog.assigned_versions(registry, more), catalog.change_log(registry, off),
        catalog.deactivate_schemas(registry, off), catalog.screen_requests(registry, more)[1],
    ):
        assert "Broadcast" not in made._jdf.queryExecution().executedPlan().toString()
    assert [(x.schema_name, x.version) for x in added.collect()] == [("s", 2)]


def test_changes(spark):
    r = requests(spark, [
        ("s", {"a": REQUIRED, "b": OPTIONAL, "d": OPTIONAL}, "NONE"),
        ("s", {"a": DEFAULTED, "c": OPTIONAL, "d": OPTIONAL}, "NONE"),
    ])
    pairs = catalog.consecutive_versions(catalog.register_schemas(None, r))
    rows = {x.to_version: x for x in catalog.schema_changes(pairs).collect()}
    assert (rows[1].added_fields, rows[1].removed_fields) == (["a", "b", "d"], [])
    assert (rows[2].added_fields, rows[2].removed_fields, rows[2].modified_fields) == (["c"], ["b"], ["a"])


@pytest.mark.parametrize(
    ("old", "new", "mode", "rules"),
    [
        ({"a": REQUIRED, "b": OPTIONAL}, {"b": OPTIONAL}, "BACKWARD", ["removed_required"]),
        ({"a": REQUIRED, "b": OPTIONAL}, {"a": REQUIRED}, "BACKWARD", []),
        ({"a": REQUIRED}, {"b": REQUIRED}, "BACKWARD", ["removed_required"]),
        ({"a": OPTIONAL}, {"a": OPTIONAL, "b": REQUIRED}, "FORWARD", ["added_required"]),
        ({"a": OPTIONAL}, {"a": OPTIONAL, "b": DEFAULTED}, "FORWARD", []),
        ({"a": REQUIRED}, {"b": REQUIRED}, "FORWARD", ["added_required"]),
        ({"a": REQUIRED}, {"b": REQUIRED}, "FULL", ["added_required", "removed_required"]),
        ({"a": REQUIRED}, {"b": REQUIRED}, "NONE", []),
    ],
)
def test_compatibility(spark, old, new, mode, rules):
    registry = catalog.register_schemas(None, requests(spark, [("s", old, mode), ("s", new, mode)]))
    found = catalog.compatibility_violations(catalog.consecutive_versions(registry))
    assert sorted(x.rule for x in found.collect()) == rules
    # The same comparison decides on a request before it is registered.
    first = registry.where("version = 1")
    asked = requests(spark, [("s", new, mode), ("brand_new", new, mode)])
    admitted, rejected = catalog.screen_requests(first, asked)
    names = sorted(x.schema_name for x in admitted.collect())
    assert names == (["brand_new"] if rules else ["brand_new", "s"])
    assert sorted(x.rule for x in rejected.collect()) == rules


def decided(spark, rows, existing=None):
    asked = requests(spark, rows)
    outcomes = catalog.register_checked(existing, asked).collect()
    return {r.request_id: (r.outcome, r.version, r.against, r.broken) for r in outcomes}


def test_breaking_definitions_are_refused(spark):
    rows = [
        ("s", {"a": REQUIRED}, "BACKWARD"),
        ("s", {"b": OPTIONAL}, "BACKWARD"),  # loses a
        ("s", {"a": OPTIONAL, "b": OPTIONAL}, "BACKWARD"),
        ("s", {"b": OPTIONAL}, "BACKWARD"),  # the same again: a is optional by now
        ("s", {"a": REQUIRED}, "FULL"),  # known since the first
        ("s", {"b": OPTIONAL, "c": REQUIRED}, "FORWARD"),  # c is new and has no default
        ("s", {"b": OPTIONAL, "c": REQUIRED}, "NONE"),
        ("s", {"d": REQUIRED}, "FULL"),  # two conflicts at once
        ("t", {"d": REQUIRED}, "FULL"),
        (None, {"d": REQUIRED}, "FULL"),
    ]
    got = decided(spark, rows)
    assert got == {
        0: ("registered", 1, None, []), 1: ("refused", None, 1, ["removed_required:a"]), 2: ("registered", 2, 1, []),
        3: ("registered", 3, 2, []), 4: ("known", 1, 3, []), 5: ("refused", None, 3, ["added_required:c"]),
        6: ("registered", 4, 3, []), 7: ("refused", None, 4, ["added_required:d", "removed_required:c"]),
        8: ("registered", 1, None, []), 9: ("registered", 1, None, []),
    }
    asked = requests(spark, rows)
    registry = catalog.accepted(asked, catalog.register_checked(None, asked))
    assert sorted((r.schema_name or "", r.version) for r in registry.collect()) == [("", 1), ("s", 1), ("s", 2), ("s", 3), ("s", 4), ("t", 1)]
    more = [("s", {"x": OPTIONAL}, "BACKWARD"), ("s", {"x": OPTIONAL}, "FORWARD"), ("t", {"d": REQUIRED}, "FULL"), ("u", {}, "FULL")]
    assert decided(spark, more, registry) == {
        0: ("refused", None, 4, ["removed_required:c"]), 1: ("registered", 5, 4, []), 2: ("known", 1, 1, []),
        3: ("registered", 1, None, []),
    }
    assert decided(spark, [], registry) == {}


def test_no_aggregate_of_the_folds_sorts(spark):
    ddl = "version_id long, dataset_name string, version string, at timestamp, step long, status string, record_count long"
    e = spark.createDataFrame([(1, "d", "v", START, 0, "pending", None), (1, None, None, START, 1, "failed", 3)], ddl)
    state = catalog.fold_versions(e)
    assert one(state)["status"] == "failed"
    for df in (state, catalog.latest_versions(state)):
        assert "SortAggregate" not in df._jdf.queryExecution().executedPlan().toString()


def test_texts_that_tie_make_one_row(spark):
    rows = [(1, START, 1, "a"), (1, START, 1, "b"), (1, START, 1, "b"), (2, START, 0, "running")]
    e = spark.createDataFrame(rows, "run_id long, at timestamp, step int, status string")
    state = catalog.fold_versions(e, ["run_id"], states=())
    assert sorted((r.run_id, r.status) for r in state.collect()) == [(1, "b"), (2, "running")]


def test_many_requests_of_one_day_are_numbered_by_several_tasks(spark):
    df = spark.range(0, 20_000, 1, 4).selectExpr("'one' AS k", "timestamp'2024-01-01' AS t", "id AS i")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        made = numbered(df, ["k"], ["t", "i"], "n")
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert made.where("n <> i + 1").count() == 0
    assert len(made.inputFiles()) == 8  # written by as many tasks


def test_latest_active_and_history(spark):
    r = requests(spark, [("s", {c: OPTIONAL}, "NONE") for c in "abc"])
    registry = catalog.register_schemas(None, r)
    off = spark.createDataFrame([("s", 3), ("s", 3)], "schema_name string, version int")
    state = catalog.deactivate_schemas(registry, off)
    assert one(catalog.latest_schemas(state))["version"] == 2
    assert [x.version for x in catalog.schema_history(state, "s").collect()] == [1, 2, 3]
    assert one(catalog.schema_version(state, "s", 3))["is_active"] is False
    log = catalog.change_log(registry, off)
    assert sorted(x.change_type for x in log.collect()) == ["DEACTIVATE"] * 2 + ["REGISTER"] * 3
    assert one(catalog.schema_json(registry).where("version = 1").select("definition"))["definition"] == (
        '{"a":{"required":false,"type":"double"}}'
    )


def test_numbering_matches_a_window(spark):
    rows = [(k, START + timedelta(hours=7 * i % 97), i) for i in range(60) for k in ("x", "y")]
    df = spark.createDataFrame(rows, "k string, t timestamp, i int")
    made = numbered(df, ["k"], ["t", "i"], "n", "all")
    got = sorted((r.k, r.n, r.i) for r in made.collect())
    assert {r.all for r in made.collect()} == {60}
    want = []
    for k in ("x", "y"):
        for n, (_, _, i) in enumerate(sorted((r[1], r[2], r[2]) for r in rows if r[0] == k), 1):
            want.append((k, n, i))
    assert got == want


# ----------------------------------------------------------------- versions

EVENT = (
    "version_id string, dataset_name string, version string, at timestamp, step long, status string, "
    "record_count long, quality_metrics string"
)


def test_versions_fold_from_events(spark):
    e = spark.createDataFrame(
        [
            ("1", "d", "v1", START, 0, "pending", None, None),
            ("1", None, None, START + timedelta(1), 0, "processing", None, None),
            ("1", None, None, START + timedelta(2), 0, "available", 7, '{"a":1}'),
            ("1", None, None, START + timedelta(3), 0, "deprecated", None, None),
            ("2", "d", "v2", START + timedelta(1), 0, "pending", None, None),
            ("2", None, None, START + timedelta(1), 1, "failed", None, None),
        ],
        EVENT,
    )
    state = catalog.fold_versions(e, ["version_id"])
    rows = {r.version_id: r for r in state.collect()}
    assert (rows["1"].status, rows["1"].record_count, rows["1"].version) == ("deprecated", 7, "v1")
    assert (rows["1"].created_at, rows["1"].updated_at) == (START, START + timedelta(3))
    assert rows["2"].status == "failed" and rows["2"].record_count is None
    assert one(catalog.latest_versions(state))["version"] == "v2"
    assert [r.version for r in catalog.list_versions(state, "d").collect()] == ["v2", "v1"]
    assert catalog.list_versions(state, status="failed").count() == 1
    assert catalog.version(state, "d", "v1").count() == 1
    as_of = F.lit(START + timedelta(days=7, hours=12))
    assert [r.version for r in catalog.recent_versions(state, as_of, 7, unavailable_only=True).collect()] == ["v2"]
    assert catalog.invalid_states(e.withColumn("status", F.lit("AVAILABLE"))).count() == 6
    with pytest.raises(ValueError):
        catalog.list_versions(state, status="AVAILABLE")


def test_creation_is_unique_per_name_and_version(spark):
    ddl = "version_id string, dataset_name string, version string, at timestamp"
    asked = spark.createDataFrame(
        [("1", "d", "v1", START), ("2", "d", "v1", START + timedelta(1)), ("3", "d", "v2", START)], ddl
    )
    made = catalog.create_versions(None, asked)
    assert sorted((r.version_id, r.status) for r in made.collect()) == [("1", "pending"), ("3", "pending")]
    assert catalog.create_versions(made, asked).count() == 0


def test_lineage(spark):
    versions = spark.createDataFrame(
        [(i, "d", f"v{i}", "available") for i in (1, 2, 3)],
        "version_id long, dataset_name string, version string, status string",
    )
    edge = "child_id long, parent_id long, transformation_type string"
    edges = catalog.add_lineage(None, spark.createDataFrame([(2, 1, "a"), (2, 1, "b"), (3, 2, "a")], edge))
    assert edges.count() == 2
    assert catalog.add_lineage(edges, spark.createDataFrame([(2, 1, "z"), (3, 1, "z")], edge)).count() == 1
    of_two = catalog.lineage(edges, versions).where("version_id = 2")
    assert sorted((r.relation, r.related_id) for r in of_two.collect()) == [("child", 3), ("parent", 1)]
    assert catalog.lineage(edges, versions, "upstream").count() == 2
    with pytest.raises(ValueError):
        catalog.lineage(edges, versions, "sideways")
