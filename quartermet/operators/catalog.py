"""Schemas, dataset versions and lineage as tables.

Nothing is updated in place: rows are appended as events and the current state
is folded from them by aggregates that combine before the shuffle.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.columns import canonical_json, content_hash
from ..functions.packing import packed
from ..functions.ranking import numbered
from ..model import VERSION_STATES

SCHEMA = ("schema_name", "version")

#: type of the column ``fields``: field name -> definition
FIELDS_TYPE = "map<string,struct<default:string,required:boolean,type:string>>"


# ---------------------------------------------------------------- schemas

def _new_definitions(existing: DataFrame | None, requests: DataFrame, tasks: int | None = None) -> DataFrame:
    """First request of every definition the registry does not hold.

    With ``tasks`` each shuffle takes that many.  A definition asked for often is
    then cut down in parts, dealt by request, before its first request is found.
    """
    hashed = requests.withColumn("schema_hash", content_hash("fields"))
    kept = [c for c in hashed.columns if c not in ("schema_name", "schema_hash")]
    # Definitions are maps and cannot be compared: order by time and request only.
    key = ["schema_name", "schema_hash"]
    first = F.min_by(F.struct(*kept), F.struct("created_at", "request_id")).alias("_first")
    if tasks:
        hashed = hashed.withColumn("_part", F.pmod(F.xxhash64("request_id"), F.lit(tasks)))
        parts = hashed.repartition(tasks, *key, "_part").groupBy(*key, "_part").agg(first)
        hashed = parts.select(*key, "_first.*").repartition(tasks, *key)
    fresh = hashed.groupBy(*key).agg(first).select(*key, "_first.*")
    if existing is None:
        return fresh
    # A registry of many repeated definitions is a small file and a large table: never broadcast.
    return fresh.join(existing.select(*key).hint("merge"), key, "left_anti")


def register_schemas(existing: DataFrame | None, requests: DataFrame, tasks: int | None = None) -> DataFrame:
    """Registry rows to append for a batch of registrations.

    A definition already registered under its name keeps its version; others
    are numbered on from the highest one, in the order they were asked for.
    Nothing is refused; see ``register_checked``.  ``tasks`` that grow with the
    requests keep the memory of each the same.
    """
    fresh = _new_definitions(existing, requests, tasks)
    fresh = numbered(fresh, ["schema_name"], ["created_at", "request_id"], "_number", many_groups=True, tasks=tasks)
    number = F.col("_number")
    if existing is not None:
        top = existing.groupBy("schema_name").agg(F.max("version").alias("_top"))
        fresh = fresh.join(top.hint("merge"), "schema_name", "left")
        number = number + F.coalesce("_top", F.lit(0))
    return fresh.select(
        "schema_name",
        number.cast("int").alias("version"),
        "fields",
        "schema_hash",
        "description",
        "compatibility_mode",
        F.lit(True).alias("is_active"),
        "created_at",
        "created_by",
    )


def _summary(fields: str = "fields") -> list[Column]:
    """What a comparison of definitions needs: names, required names, required names without default."""
    names = _names(fields)
    required = F.filter(names, lambda n: F.col(fields)[n]["required"])
    bare = F.filter(required, lambda n: F.col(fields)[n]["default"].isNull())
    return [names.alias("names"), required.alias("required"), bare.alias("bare")]


def broken_rules(old: dict, new: dict, mode: str) -> list[str]:
    """Rules that ``new`` breaks against ``old`` in a compatibility mode, as rule:field in order."""
    rules = []
    if mode in ("FORWARD", "FULL"):
        rules += [f"added_required:{n}" for n in new["bare"] if n not in old["names"]]
    if mode in ("BACKWARD", "FULL"):
        rules += [f"removed_required:{n}" for n in old["required"] if n not in new["names"]]
    return sorted(rules)


def _fold_requests(schema: pa.Schema):
    """Decide requests one after the other; they come by name, registered definitions first, then by time."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        name, latest, top = object(), None, 0
        known: dict[str, int] = {}
        for batch in batches:
            out: list[tuple] = []
            for row in batch.to_pylist():
                if row["schema_name"] != name:
                    name, latest, top, known = row["schema_name"], None, 0, {}
                if row["registered"] is not None:
                    latest, top = row, row["registered"]
                    known[row["schema_hash"]] = top
                    continue
                version, against, broken = known.get(row["schema_hash"]), top or None, []
                outcome = "known"
                if version is None:
                    broken = broken_rules(latest, row, row["compatibility_mode"]) if latest else []
                    outcome = "refused" if broken else "registered"
                    if not broken:
                        latest, top = row, top + 1
                        version = known[row["schema_hash"]] = top
                out.append((row["request_id"], name, outcome, version, against, broken))
            columns = list(zip(*out, strict=True)) if out else [[]] * len(schema)
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)

    return work


def register_checked(existing: DataFrame | None, requests: DataFrame) -> DataFrame:
    """The outcome of every request: request_id, schema_name, outcome, version, against, broken.

    Requests of a name are decided in the order of time and request.  A definition
    registered before, in this batch too, keeps its version (``known``).  Another
    one is compared with the last accepted one (``against``) in its own mode, and
    either gets the next version (``registered``) or, with the rules it broke, none
    (``refused``); it can be accepted later, against another definition.

    One decision hangs on the one before, so a name is decided by one task.  It
    gets a few words for each request, sorted by Spark (which spills), and reads
    them as a stream; it remembers the accepted definitions' hashes only.
    """
    asked = requests.select(
        "schema_name", F.lit(None).cast("int").alias("registered"), F.col("created_at").cast("timestamp").alias("created_at"),
        "request_id", content_hash("fields").alias("schema_hash"), "compatibility_mode", *_summary(),
    )
    if existing is not None:
        asked = asked.unionByName(
            existing.select("schema_name", F.col("version").alias("registered"), "schema_hash", *_summary()), True
        )
    kind = requests.schema["request_id"].dataType
    made = (
        T.StructType().add("request_id", kind).add("schema_name", "string").add("outcome", "string")
        .add("version", "integer").add("against", "integer").add("broken", T.ArrayType(T.StringType()))
    )
    from pyspark.sql.pandas.types import to_arrow_schema

    order = [F.col("registered").asc_nulls_last(), "created_at", "request_id"]
    ordered = asked.repartition("schema_name").sortWithinPartitions("schema_name", *order)
    return ordered.mapInArrow(_fold_requests(to_arrow_schema(made)), made)


def accepted(requests: DataFrame, outcomes: DataFrame) -> DataFrame:
    """Registry rows to append for the requests that ``register_checked`` registered."""
    new = outcomes.where(F.col("outcome") == "registered").select("request_id", "version")
    return requests.join(new, "request_id").select(
        "schema_name", "version", "fields", content_hash("fields").alias("schema_hash"), "description",
        "compatibility_mode", F.lit(True).alias("is_active"), "created_at", "created_by",
    )


def assigned_versions(registry: DataFrame, requests: DataFrame) -> DataFrame:
    """The version every request got, repeated definitions included."""
    asked = requests.select("request_id", "schema_name", content_hash("fields").alias("schema_hash"))
    known = registry.select("schema_name", "schema_hash", "version").hint("merge")
    return asked.join(known, ["schema_name", "schema_hash"]).select(
        "request_id", "schema_name", "version"
    )


def consecutive_versions(registry: DataFrame) -> DataFrame:
    """Each version beside the one before it.

    Versions are numbered without holes, so the one before is found by number:
    a join that spreads over versions, not a window over a whole schema.
    """
    before = registry.select(
        "schema_name",
        (F.col("version") + 1).alias("to_version"),
        F.col("version").alias("from_version"),
        F.col("fields").alias("old_fields"),
    )
    later = registry.select(
        "schema_name",
        F.col("version").alias("to_version"),
        F.col("fields").alias("new_fields"),
        "compatibility_mode",
        "created_at",
        "created_by",
    )
    return later.join(before.hint("merge"), ["schema_name", "to_version"], "left")


def _names(fields: str) -> Column:
    return F.coalesce(F.map_keys(fields), F.array().cast("array<string>"))


def schema_changes(pairs: DataFrame) -> DataFrame:
    """Added, removed and modified fields of version pairs, names sorted."""
    both = F.array_intersect(_names("old_fields"), _names("new_fields"))
    # A default missing on both sides is no change.
    changed = F.filter(
        both, lambda n: ~F.col("old_fields")[n].eqNullSafe(F.col("new_fields")[n])
    )
    return pairs.select(
        "schema_name",
        "from_version",
        "to_version",
        F.lit("REGISTER").alias("change_type"),
        F.array_sort(F.array_except(_names("new_fields"), _names("old_fields"))).alias("added_fields"),
        F.array_sort(F.array_except(_names("old_fields"), _names("new_fields"))).alias("removed_fields"),
        F.array_sort(changed).alias("modified_fields"),
    )


def compatibility_violations(pairs: DataFrame) -> DataFrame:
    """Fields that break the compatibility mode of the newer version.

    BACKWARD and FULL forbid removing a required field, FORWARD and FULL adding
    a required one without default; NONE allows all.
    """
    backward = F.col("compatibility_mode").isin("BACKWARD", "FULL")
    forward = F.col("compatibility_mode").isin("FORWARD", "FULL")
    gone = F.filter(
        F.array_except(_names("old_fields"), _names("new_fields")),
        lambda n: backward & F.col("old_fields")[n]["required"],
    )
    come = F.filter(
        F.array_except(_names("new_fields"), _names("old_fields")),
        lambda n: forward
        & F.col("new_fields")[n]["required"]
        & F.col("new_fields")[n]["default"].isNull(),
    )

    def found(names: Column, rule: str) -> Column:
        return F.transform(names, lambda n: F.struct(F.lit(rule).alias("rule"), n.alias("field")))

    rows = F.concat(found(gone, "removed_required"), found(come, "added_required"))
    return pairs.where(F.col("from_version").isNotNull()).select(
        "schema_name", "from_version", "to_version", "compatibility_mode", F.inline(rows)
    )


def screen_requests(registry: DataFrame, requests: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Split a batch with one request per name into admissible and rejected.

    Each request is compared with the highest version of its schema; rejected
    rows are the violations found.
    """
    latest = registry.groupBy("schema_name").agg(
        F.max("version").alias("from_version"), F.max_by("fields", "version").alias("old_fields")
    )
    pairs = requests.join(latest.hint("merge"), "schema_name", "left").select(
        "request_id", "schema_name", "from_version",
        (F.coalesce("from_version", F.lit(0)) + 1).alias("to_version"),
        "old_fields", F.col("fields").alias("new_fields"), "compatibility_mode",
    )
    rejected = compatibility_violations(pairs)
    names = rejected.select("schema_name").distinct()
    return requests.join(names, "schema_name", "left_anti"), rejected


def schema_version(registry: DataFrame, name: str, version: int) -> DataFrame:
    return registry.where((F.col("schema_name") == name) & (F.col("version") == version))


def latest_schemas(registry: DataFrame) -> DataFrame:
    """Highest active version of every schema."""
    rest = [c for c in registry.columns if c != "schema_name"]
    active = registry.where("is_active")
    best = active.groupBy("schema_name").agg(F.max_by(F.struct(*rest), "version").alias("_row"))
    return best.select("schema_name", "_row.*")


def schema_history(registry: DataFrame, name: str) -> DataFrame:
    return registry.where(F.col("schema_name") == name).orderBy("version")


def deactivate_schemas(registry: DataFrame, events: DataFrame) -> DataFrame:
    """The registry with the versions named in deactivation events inactive."""
    off = events.select(*SCHEMA).distinct().withColumn("_off", F.lit(True))
    kept = [c for c in registry.columns if c != "is_active"]
    return registry.join(off.hint("merge"), list(SCHEMA), "left").select(
        *kept, (F.col("is_active") & F.col("_off").isNull()).alias("is_active")
    )


def change_log(registry: DataFrame, deactivations: DataFrame) -> DataFrame:
    """Registrations with their details, and deactivations."""
    pairs = consecutive_versions(registry)
    changes = schema_changes(pairs)
    details = F.to_json(F.struct("added_fields", "removed_fields", "modified_fields"))
    registered = changes.select(
        "schema_name", "from_version", "to_version", "change_type", details.alias("change_details")
    )
    switched = deactivations.select(
        "schema_name",
        F.lit(None).cast("int").alias("from_version"),
        F.col("version").alias("to_version"),
        F.lit("DEACTIVATE").alias("change_type"),
        F.lit(None).cast("string").alias("change_details"),
    )
    return registered.unionByName(switched)


def schema_json(registry: DataFrame) -> DataFrame:
    return registry.withColumn("definition", canonical_json("fields"))


# --------------------------------------------------------------- versions

def create_versions(existing: DataFrame | None, requests: DataFrame) -> DataFrame:
    """Creation events, state pending, for (dataset_name, version) not yet there."""
    key = ["dataset_name", "version"]
    rest = [c for c in requests.columns if c not in key]
    first = F.min_by(F.struct(*rest), F.struct("at", "version_id")).alias("_row")
    fresh = requests.groupBy(*key).agg(first).select(*key, "_row.*")
    if existing is not None:
        fresh = fresh.join(existing.select(*key).distinct(), key, "left_anti")
    return fresh.withColumn("status", F.lit("pending"))


def invalid_states(events: DataFrame) -> DataFrame:
    return events.where(~F.col("status").isin(*VERSION_STATES))


def fold_versions(
    events: DataFrame,
    key: Sequence[str] = ("version_id",),
    order: tuple[str, str] = ("at", "step"),
    states: Sequence[str] = VERSION_STATES,
) -> DataFrame:
    """Current state: of every attribute the last value that was given; ``status`` is one of ``states``.

    An event changes only the attributes it carries; time and step are packed into
    one number, which should tell the events of a key apart (of texts that tie the
    greatest counts).  States, if they are named, and attributes of fixed width are folded by that number in one hash aggregate, with map-side
    combine.  Of others (names, texts) it folds the number itself, and their values
    are fetched from the events that carry them by key and number.
    """
    at = order[0]
    attributes = [c for c in events.columns if c not in (*key, *order)]
    coded = ["status"] if states and "status" in attributes else []
    text = [c for c in attributes if events.schema[c].dataType == T.StringType() and c not in coded]
    codes = F.array(*map(F.lit, states))
    rows = events.withColumn("_n", packed(*order))

    def when(c: str) -> Column:
        return F.when(F.col(c).isNotNull(), F.col("_n"))

    def last(c: str) -> Column:
        if c in text:
            return F.max(when(c)).alias(c)
        if c in coded:
            return F.max_by(F.array_position(codes, F.col(c)).cast("int"), when(c)).alias(c)
        return F.max_by(F.col(c), when(c)).alias(c)

    folded = rows.groupBy(*key).agg(*map(last, attributes), F.min(at).alias("created_at"), F.max(at).alias("updated_at"))
    for c in text:
        values = rows.where(F.col(c).isNotNull()).groupBy(*key, F.col("_n").alias("_of")).agg(
            F.array_max(F.collect_set(c)).alias("_value")
        )
        values = values.withColumnsRenamed({k: f"_{k}" for k in key})
        same = [folded[k].eqNullSafe(values[f"_{k}"]) for k in key]
        joined = folded.join(values, [*same, folded[c] == values["_of"]], "left")
        folded = joined.select(*(F.col("_value").alias(c) if k == c else F.col(k) for k in folded.columns))
    if coded:
        folded = folded.withColumn("status", F.get(codes, F.col("status") - 1))
    return folded


def version(versions: DataFrame, name: str, version_: str) -> DataFrame:
    return versions.where((F.col("dataset_name") == name) & (F.col("version") == version_))


def latest_versions(versions: DataFrame) -> DataFrame:
    """The version created last, of every dataset; of several, the greatest version_id.

    Two hash aggregates over dataset and number find which; its row is fetched by both.
    """
    newest = versions.groupBy("dataset_name").agg(F.max(F.unix_micros(F.col("created_at").cast("timestamp"))).alias("_at"))
    rows = versions.withColumn("_at", F.unix_micros(F.col("created_at").cast("timestamp")))
    rows = rows.join(newest, ["dataset_name", "_at"], "left_semi")
    rivals = rows.groupBy("dataset_name").agg(F.max("version_id").alias("version_id"))
    return rows.join(rivals, ["dataset_name", "version_id"], "left_semi").select(*versions.columns)


def list_versions(
    versions: DataFrame, dataset_name: str | None = None, status: str | None = None
) -> DataFrame:
    """Versions by name and state, newest first."""
    if status is not None and status not in VERSION_STATES:
        raise ValueError(f"unknown status {status!r}, expected one of {VERSION_STATES}")
    if dataset_name is not None:
        versions = versions.where(F.col("dataset_name") == dataset_name)
    if status is not None:
        versions = versions.where(F.col("status") == status)
    return versions.orderBy(F.desc("created_at"), F.desc("version_id"))


def recent_versions(
    versions: DataFrame, as_of: Column, days: int = 30, unavailable_only: bool = False, k: int | None = None
) -> DataFrame:
    """Versions created within some days, newest first; optionally the unavailable ones."""
    rows = versions.where(F.col("created_at") > as_of - F.make_dt_interval(days=F.lit(days)))
    if unavailable_only:
        rows = rows.where(F.col("status") != "available")
    rows = rows.orderBy(F.desc("created_at"), F.desc("version_id"))
    return rows.limit(k) if k else rows


# ---------------------------------------------------------------- lineage

def add_lineage(existing: DataFrame | None, edges: DataFrame) -> DataFrame:
    """Edges to append; pairs already there, or given twice, are ignored.

    Among repeats in a batch the smallest transformation type stays.
    """
    pair = ["child_id", "parent_id"]
    fresh = edges.groupBy(*pair).agg(F.min("transformation_type").alias("transformation_type"))
    if existing is None:
        return fresh
    return fresh.join(existing.select(*pair), pair, "left_anti")


def _neighbours(edges: DataFrame, versions: DataFrame, of: str, other: str) -> DataFrame:
    known = versions.select(
        F.col("version_id").alias(other),
        "dataset_name",
        F.col("version").alias("version_name"),
        "status",
    )
    return edges.join(known, other).select(
        F.col(of).alias("version_id"),
        F.col(other).alias("related_id"),
        "dataset_name",
        "version_name",
        "status",
        "transformation_type",
    )


def lineage(edges: DataFrame, versions: DataFrame, direction: str = "both") -> DataFrame:
    """Parents and children of all versions; filter on version_id for one of them."""
    if direction not in ("upstream", "downstream", "both"):
        raise ValueError(f"unknown direction {direction!r}")
    up = _neighbours(edges, versions, "child_id", "parent_id").withColumn("relation", F.lit("parent"))
    down = _neighbours(edges, versions, "parent_id", "child_id").withColumn("relation", F.lit("child"))
    if direction == "upstream":
        return up
    return down if direction == "downstream" else up.unionByName(down)
