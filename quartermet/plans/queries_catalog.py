"""Registered queries: catalogue, listings, raw sources, run records."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.columns import (
    object_path,
    path_columns,
    period_year,
    rounded,
    station_code,
    version_name,
)
from ..layout import Layout
from ..model import PRODUCT_PREFIXES, STATION
from ..operators import catalog, cleaning, enrich, quality, runs
from ..session import shared_folder
from ..sinks import tables
from ..sources import archives, listing, observations, staged, stations
from . import jobs, views
from .queries_features import contract_sql
from .registry import query
from .sql import view, with_views
from .views import curated_table

# ------------------------------------------------------------- catalogue

view(
    "schema_fields",
    (),
    """SELECT l_orderkey, 'f' || (l_partkey % 3) AS field,
              max(CASE WHEN l_returnflag = 'N' THEN '0' END) AS dflt,
              bool_or(l_linestatus = 'O') AS required,
              CASE WHEN max(l_linenumber) > 4 THEN 'double' ELSE 'string' END AS type
       FROM lineitem GROUP BY ALL""",
)
view(
    "schema_requests",
    ("schema_fields",),
    """SELECT o_orderkey AS request_id, 'schema_' || (o_custkey // 10) AS schema_name,
              sha256('{' || definition || '}') AS schema_hash, definition,
              o_orderpriority AS description,
              (['BACKWARD', 'FORWARD', 'FULL', 'NONE'])[o_orderkey % 4 + 1] AS compatibility_mode,
              o_orderdate AS created_at, o_orderstatus AS created_by
       FROM orders JOIN (
         SELECT l_orderkey, string_agg('"' || field || '":{'
             || CASE WHEN dflt IS NOT NULL THEN '"default":"' || dflt || '",' ELSE '' END
             || '"required":' || required::VARCHAR || ',"type":"' || type || '"}',
             ',' ORDER BY field) AS definition
         FROM schema_fields GROUP BY l_orderkey) ON o_orderkey = l_orderkey""",
)
view(
    "registry",
    ("schema_requests",),
    """SELECT *, row_number() OVER (PARTITION BY schema_name ORDER BY created_at, request_id)::INTEGER
                AS version
       FROM (SELECT *, row_number() OVER (PARTITION BY schema_name, schema_hash
                                          ORDER BY created_at, request_id) AS place
             FROM schema_requests) WHERE place = 1""",
)
view(
    "deactivations",
    (),
    """SELECT 'schema_' || (o_custkey // 10) AS schema_name,
              (1 + o_orderkey % 5)::INTEGER AS version
       FROM orders WHERE o_orderpriority = '1-URGENT'""",
)
view(
    "pair_fields",
    ("registry", "schema_fields"),
    """SELECT schema_name, from_version, version AS to_version, compatibility_mode,
              coalesce(o.field, n.field) AS field, o.field AS old_field, n.field AS new_field,
              o.required AS old_required, n.required AS new_required, n.dflt AS new_default,
              (o.dflt, o.required, o.type) IS DISTINCT FROM (n.dflt, n.required, n.type) AS differs
       FROM (SELECT *, lag(version) OVER w AS from_version, lag(request_id) OVER w AS from_request
             FROM registry WINDOW w AS (PARTITION BY schema_name ORDER BY version)) p,
       LATERAL (
         SELECT unnest(['f0', 'f1', 'f2']) AS name) names
       LEFT JOIN schema_fields o ON o.l_orderkey = p.from_request AND o.field = names.name
       LEFT JOIN schema_fields n ON n.l_orderkey = p.request_id AND n.field = names.name
       WHERE o.field IS NOT NULL OR n.field IS NOT NULL""",
)


def registry(spark, sf_dir):
    """The registry of all requests, as the stored table it is in use."""
    path = Layout(shared_folder(spark, "registry")).log("schemas")
    made = catalog.register_schemas(None, views.schema_requests(spark, sf_dir), views.tasks_for(spark, sf_dir, "lineitem"))
    made.write.parquet(path)
    return spark.read.parquet(path)


def deactivations(spark, sf_dir):
    return (
        views.table(spark, sf_dir, "orders")
        .where(F.col("o_orderpriority") == "1-URGENT")
        .select(
            F.concat(F.lit("schema_"), F.floor(F.col("o_custkey") / 10).cast("string")).alias("schema_name"),
            (1 + F.col("o_orderkey") % 5).cast("int").alias("version"),
        )
    )


@query(
    "schema_register",
    with_views("registry")
    + """SELECT schema_name, version, schema_hash, description, compatibility_mode, created_at,
           created_by FROM registry""",
)
def schema_register(spark, sf_dir):
    made = catalog.register_schemas(None, views.schema_requests(spark, sf_dir), views.tasks_for(spark, sf_dir, "lineitem"))
    return made.drop("fields", "is_active")


@query(
    "schema_register_more",
    with_views("registry")
    + "SELECT schema_name, version, schema_hash FROM registry WHERE created_at >= TIMESTAMP '1999-01-01'",
)
def schema_register_more(spark, sf_dir):
    """Registering later requests on top of the registry of the earlier ones."""
    requests = views.schema_requests(spark, sf_dir)
    later = F.col("created_at") >= F.lit("1999-01-01").cast("timestamp_ntz")
    tasks = views.tasks_for(spark, sf_dir, "lineitem")
    path = Layout(shared_folder(spark, "registry")).log("schemas")
    tables.append_log(catalog.register_schemas(None, requests.where(~later), tasks), path)
    known = spark.read.parquet(path)
    added = catalog.register_schemas(known, requests.where(later), tasks)
    return added.select("schema_name", "version", "schema_hash")


@query(
    "schema_assigned_versions",
    with_views("registry")
    + """SELECT q.request_id, q.schema_name, r.version FROM schema_requests q
         JOIN registry r ON q.schema_name = r.schema_name AND q.schema_hash = r.schema_hash""",
)
def schema_assigned_versions(spark, sf_dir):
    return catalog.assigned_versions(registry(spark, sf_dir), views.schema_requests(spark, sf_dir))


@query(
    "schema_latest",
    with_views("registry", "deactivations")
    + """SELECT schema_name, max(version) AS version, arg_max(schema_hash, version) AS schema_hash,
           arg_max(compatibility_mode, version) AS compatibility_mode
         FROM registry r
         WHERE NOT EXISTS (SELECT 1 FROM deactivations d
                           WHERE d.schema_name = r.schema_name AND d.version = r.version)
         GROUP BY schema_name""",
)
def schema_latest(spark, sf_dir):
    state = catalog.deactivate_schemas(registry(spark, sf_dir), deactivations(spark, sf_dir))
    return catalog.latest_schemas(state).select(
        "schema_name", "version", "schema_hash", "compatibility_mode"
    )


@query(
    "schema_history",
    with_views("registry")
    + """SELECT version, description, created_at, created_by, compatibility_mode FROM registry
         WHERE schema_name = 'schema_3'""",
)
def schema_history(spark, sf_dir):
    return catalog.schema_history(registry(spark, sf_dir), "schema_3").select(
        "version", "description", "created_at", "created_by", "compatibility_mode"
    )


@query(
    "schema_diff",
    with_views("pair_fields")
    + """SELECT schema_name, from_version, to_version,
           coalesce(string_agg(field, ',' ORDER BY field) FILTER (WHERE old_field IS NULL), '') AS added,
           coalesce(string_agg(field, ',' ORDER BY field) FILTER (WHERE new_field IS NULL), '') AS removed,
           coalesce(string_agg(field, ',' ORDER BY field) FILTER (
             WHERE old_field IS NOT NULL AND new_field IS NOT NULL AND differs), '') AS modified
         FROM pair_fields GROUP BY schema_name, from_version, to_version""",
)
def schema_diff(spark, sf_dir):
    out = catalog.schema_changes(catalog.consecutive_versions(registry(spark, sf_dir)))
    names = ("added", "removed", "modified")
    return out.select(
        "schema_name", "from_version", "to_version",
        *[F.concat_ws(",", f"{n}_fields").alias(n) for n in names],
    )


@query(
    "schema_compat",
    with_views("pair_fields")
    + """SELECT schema_name, from_version, to_version, compatibility_mode,
           'removed_required' AS rule, field FROM pair_fields
         WHERE from_version IS NOT NULL AND new_field IS NULL AND old_required
           AND compatibility_mode IN ('BACKWARD', 'FULL')
         UNION ALL
         SELECT schema_name, from_version, to_version, compatibility_mode,
           'added_required', field FROM pair_fields
         WHERE from_version IS NOT NULL AND old_field IS NULL AND new_required
           AND new_default IS NULL AND compatibility_mode IN ('FORWARD', 'FULL')""",
)
def schema_compat(spark, sf_dir):
    return catalog.compatibility_violations(catalog.consecutive_versions(registry(spark, sf_dir)))


@query(
    "schema_screen_requests",
    with_views("registry", "schema_fields")
    + """, latest AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY schema_name
                    ORDER BY version DESC) AS newest FROM registry
                    WHERE created_at < TIMESTAMP '1999-01-01') WHERE newest = 1),
         asked AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY schema_name
                    ORDER BY created_at, request_id) AS first FROM schema_requests
                    WHERE created_at >= TIMESTAMP '1999-01-01') WHERE first = 1),
         pairs AS (SELECT a.schema_name, a.compatibility_mode AS mode, a.request_id AS new_id,
                     l.request_id AS old_id FROM asked a JOIN latest l USING (schema_name))
         SELECT schema_name, 'removed_required' AS rule, o.field FROM pairs
         JOIN schema_fields o ON o.l_orderkey = old_id
         WHERE mode IN ('BACKWARD', 'FULL') AND o.required AND NOT EXISTS (
           SELECT 1 FROM schema_fields n WHERE n.l_orderkey = new_id AND n.field = o.field)
         UNION ALL
         SELECT schema_name, 'added_required', n.field FROM pairs
         JOIN schema_fields n ON n.l_orderkey = new_id
         WHERE mode IN ('FORWARD', 'FULL') AND n.required AND n.dflt IS NULL AND NOT EXISTS (
           SELECT 1 FROM schema_fields o WHERE o.l_orderkey = old_id AND o.field = n.field)""",
)
def schema_screen_requests(spark, sf_dir):
    """The first later request of each schema against its latest earlier version."""
    requests = views.schema_requests(spark, sf_dir)
    later = F.col("created_at") >= F.lit("1999-01-01").cast("timestamp_ntz")
    tasks = views.tasks_for(spark, sf_dir, "lineitem")
    path = Layout(shared_folder(spark, "registry")).log("schemas")
    tables.append_log(catalog.register_schemas(None, requests.where(~later), tasks), path)
    rest = [c for c in requests.columns if c != "schema_name"]
    first = F.min_by(F.struct(*rest), F.struct("created_at", "request_id")).alias("r")
    asked = requests.where(later).groupBy("schema_name").agg(first).select("schema_name", "r.*")
    _, rejected = catalog.screen_requests(spark.read.parquet(path), asked)
    return rejected.select("schema_name", "rule", "field")


view(
    "asked",
    ("schema_requests", "schema_fields"),
    """SELECT request_id, schema_name, schema_hash, compatibility_mode AS mode, created_at,
              list(f.field) AS names, coalesce(list(f.field) FILTER (WHERE f.required), []) AS needs,
              coalesce(list(f.field) FILTER (WHERE f.required AND f.dflt IS NULL), []) AS bare
       FROM schema_requests JOIN schema_fields f ON f.l_orderkey = request_id GROUP BY ALL""",
)

_BROKEN = """list_sort(list_concat(
    CASE WHEN q.mode IN ('FORWARD', 'FULL') AND s.top > 0 THEN list_transform(
      list_filter(q.bare, lambda n: NOT list_contains(s.names, n)), lambda n: 'added_required:' || n) ELSE [] END,
    CASE WHEN q.mode IN ('BACKWARD', 'FULL') AND s.top > 0 THEN list_transform(
      list_filter(s.needs, lambda n: NOT list_contains(q.names, n)), lambda n: 'removed_required:' || n) ELSE [] END))"""


def _decided_sql(where: str, start: str) -> str:
    """Requests of each name decided one after the other, from a state: name, version, names, needs, hashes."""
    return f"""WITH RECURSIVE {with_views("registry", "asked")[5:]},
      started AS ({start}),
      queue AS MATERIALIZED (SELECT *, row_number() OVER (PARTITION BY schema_name ORDER BY created_at, request_id) AS place
                FROM asked WHERE {where}),
      folded(schema_name, place, top, names, needs, hashes, request_id, outcome, version, against, broken) AS (
        SELECT n.schema_name, 0::BIGINT, coalesce(s.top, 0)::INTEGER, s.names, s.needs, coalesce(s.hashes, []),
               NULL::BIGINT, NULL::VARCHAR, NULL::INTEGER, NULL::INTEGER, []::VARCHAR[]
        FROM (SELECT DISTINCT schema_name FROM queue) n LEFT JOIN started s ON s.schema_name = n.schema_name
        UNION ALL
        SELECT schema_name, place, CASE outcome WHEN 'registered' THEN top + 1 ELSE top END,
               CASE outcome WHEN 'registered' THEN new_names ELSE names END,
               CASE outcome WHEN 'registered' THEN new_needs ELSE needs END,
               CASE outcome WHEN 'registered' THEN list_append(hashes, schema_hash) ELSE hashes END, request_id, outcome,
               CASE outcome WHEN 'registered' THEN top + 1 WHEN 'known' THEN list_position(hashes, schema_hash) END::INTEGER,
               nullif(top, 0), CASE outcome WHEN 'refused' THEN broken ELSE [] END
        FROM (SELECT s.*, q.names AS new_names, q.needs AS new_needs, q.schema_hash, broken, q.request_id, q.place,
                CASE WHEN list_contains(s.hashes, q.schema_hash) THEN 'known'
                     WHEN len(broken) > 0 THEN 'refused' ELSE 'registered' END AS outcome
              FROM (SELECT s.schema_name, s.place AS before, s.top, s.names, s.needs, s.hashes FROM folded s) s
              JOIN (SELECT q.*, q.place - 1 AS before FROM queue q) q USING (schema_name, before),
              LATERAL (SELECT {_BROKEN} AS broken)))
      SELECT request_id, schema_name, outcome, version, against, array_to_string(broken, ',') AS broken
      FROM folded WHERE place > 0"""


def _written(outcomes):
    return outcomes.withColumn("broken", F.concat_ws(",", "broken"))


@query("schema_register_checked", _decided_sql("true", "SELECT NULL::VARCHAR AS schema_name, 0 AS top, []::VARCHAR[] AS names, []::VARCHAR[] AS needs, []::VARCHAR[] AS hashes WHERE false"))
def schema_register_checked(spark, sf_dir):
    """Every request, judged against the last accepted definition of its name."""
    return _written(catalog.register_checked(None, views.schema_requests(spark, sf_dir)))


@query(
    "schema_register_checked_more",
    _decided_sql(
        "created_at >= TIMESTAMP '1999-01-01'",
        """SELECT r.schema_name, max(r.version) AS top, arg_max(a.names, r.version) AS names,
             arg_max(a.needs, r.version) AS needs, list(r.schema_hash ORDER BY r.version) AS hashes
           FROM registry r JOIN asked a ON a.request_id = r.request_id
           WHERE r.created_at < TIMESTAMP '1999-01-01' GROUP BY r.schema_name""",
    ),
)
def schema_register_checked_more(spark, sf_dir):
    """All later requests, judged on top of the registry of the earlier ones."""
    requests = views.schema_requests(spark, sf_dir)
    later = F.col("created_at") >= F.lit("1999-01-01").cast("timestamp_ntz")
    tasks = views.tasks_for(spark, sf_dir, "lineitem")
    path = Layout(shared_folder(spark, "registry")).log("schemas")
    tables.append_log(catalog.register_schemas(None, requests.where(~later), tasks), path)
    return _written(catalog.register_checked(spark.read.parquet(path), requests.where(later)))


@query(
    "schema_change_log",
    with_views("registry", "deactivations")
    + """SELECT schema_name, change_type, count(*) AS entries FROM (
           SELECT schema_name, 'REGISTER' AS change_type FROM registry
           UNION ALL SELECT schema_name, 'DEACTIVATE' FROM deactivations)
         GROUP BY schema_name, change_type""",
)
def schema_change_log(spark, sf_dir):
    log = catalog.change_log(registry(spark, sf_dir), deactivations(spark, sf_dir))
    return log.groupBy("schema_name", "change_type").agg(F.count(F.lit(1)).alias("entries"))


view(
    "version_state",
    ("version_events",),
    """SELECT version_id, arg_max(dataset_name, (moment, step)) FILTER (WHERE dataset_name IS NOT NULL) AS dataset_name,
              arg_max(version, (moment, step)) FILTER (WHERE version IS NOT NULL) AS version,
              arg_max(status, (moment, step)) FILTER (WHERE status IS NOT NULL) AS status,
              arg_max(record_count, (moment, step)) FILTER (WHERE record_count IS NOT NULL) AS record_count,
              arg_max(total_size_bytes, (moment, step)) FILTER (WHERE total_size_bytes IS NOT NULL) AS total_size_bytes,
              min(moment) AS created_at, max(moment) AS updated_at
       FROM version_events GROUP BY version_id""",
)


def version_state(spark, sf_dir):
    return catalog.fold_versions(views.version_events(spark, sf_dir))


@query("version_state", with_views("version_state") + "SELECT * FROM version_state")
def version_states(spark, sf_dir):
    return version_state(spark, sf_dir)


@query(
    "version_state_values",
    with_views("version_events")
    + """, ranked AS (SELECT *, row_number() OVER (PARTITION BY version_id ORDER BY moment DESC, step DESC,
                    status DESC, record_count DESC NULLS LAST) AS place FROM version_events)
         SELECT version_id, status FROM ranked WHERE place = 1""",
)
def version_state_values(spark, sf_dir):
    """Latest status; day and step order the events of a version totally."""
    return version_state(spark, sf_dir).select("version_id", "status")


view(
    "created_state",
    ("version_state",),
    """SELECT s.* EXCLUDE (created_at), made AS created_at FROM version_state s
       JOIN (SELECT version_id, max(moment) AS made FROM version_events WHERE step = 0 GROUP BY version_id) c
         ON c.version_id = s.version_id""",
)
_CREATED = "version_id, dataset_name, version, status, record_count, total_size_bytes, created_at, updated_at"


def _created(spark, sf_dir):
    """Current state of the versions that were created, at the time of their creation event."""
    events = views.version_events(spark, sf_dir).withColumn("made", F.when(F.col("step") == 0, F.col("at")))
    state = catalog.fold_versions(events).where("made IS NOT NULL")
    return state.drop("created_at").withColumnRenamed("made", "created_at")


@query(
    "version_latest",
    with_views("created_state")
    + f"""SELECT {_CREATED} FROM (SELECT *, row_number() OVER (PARTITION BY dataset_name
             ORDER BY created_at DESC, version_id DESC) AS place FROM created_state) WHERE place = 1""",
)
def version_latest(spark, sf_dir):
    return catalog.latest_versions(_created(spark, sf_dir)).select(*_CREATED.split(", "))


@query(
    "version_recent",
    with_views("created_state")
    + f"""SELECT {_CREATED} FROM created_state WHERE created_at > TIMESTAMP '1998-06-01' - INTERVAL 30 DAY
       ORDER BY created_at DESC, version_id DESC LIMIT 10""",
)
def version_recent(spark, sf_dir):
    as_of = F.lit("1998-06-01").cast("timestamp_ntz")
    return catalog.recent_versions(_created(spark, sf_dir), as_of, 30, k=10).select(*_CREATED.split(", "))


@query(
    "version_unavailable",
    with_views("created_state")
    + """SELECT version_id, status, created_at FROM created_state
       WHERE created_at > TIMESTAMP '1998-06-01' - INTERVAL 700 DAY AND status <> 'available'
       ORDER BY created_at DESC, version_id DESC""",
)
def version_unavailable(spark, sf_dir):
    """Versions of some two years whose folded state is not available; many are."""
    as_of = F.lit("1998-06-01").cast("timestamp_ntz")
    found = catalog.recent_versions(_created(spark, sf_dir), as_of, 700, unavailable_only=True)
    return found.select("version_id", "status", "created_at")


@query(
    "version_list",
    with_views("created_state")
    + f"SELECT {_CREATED} FROM created_state WHERE status = 'processing' ORDER BY created_at DESC, version_id DESC",
)
def version_list(spark, sf_dir):
    """Versions in one state, of all datasets, newest first."""
    return catalog.list_versions(_created(spark, sf_dir), status="processing").select(*_CREATED.split(", "))


view(
    "edges",
    (),
    """SELECT l_orderkey AS child_id, l_partkey AS parent_id,
              min(CASE WHEN l_returnflag = 'A' THEN 'aggregation' ELSE 'filter' END) AS kind
       FROM lineitem GROUP BY ALL""",
)


@query(
    "version_create",
    """SELECT dataset_name, version, version_id, 'pending' AS status FROM (
         SELECT 'dataset_' || o_custkey AS dataset_name, o_orderpriority AS version,
           o_orderkey AS version_id, row_number() OVER (PARTITION BY o_custkey, o_orderpriority
             ORDER BY o_orderdate, o_orderkey) AS place FROM orders WHERE o_orderstatus <> 'F')
       WHERE place = 1 AND (dataset_name, version) NOT IN (
         SELECT ('dataset_' || o_custkey, o_orderpriority) FROM orders WHERE o_orderstatus = 'F')""",
)
def version_create(spark, sf_dir):
    """Versions asked for (by customer and priority); finished orders are there already."""
    asked = views.table(spark, sf_dir, "orders").select(
        F.concat(F.lit("dataset_"), F.col("o_custkey").cast("string")).alias("dataset_name"),
        F.col("o_orderpriority").alias("version"),
        F.col("o_orderkey").alias("version_id"),
        F.col("o_orderdate").alias("at"),
        "o_orderstatus",
    )
    there = asked.where("o_orderstatus = 'F'")
    made = catalog.create_versions(there, asked.where("o_orderstatus <> 'F'").drop("o_orderstatus"))
    return made.select("dataset_name", "version", "version_id", "status")


@query(
    "lineage",
    with_views("edges")
    + """, versions AS (SELECT o_orderkey AS id, 'dataset_' || o_custkey AS dataset_name,
              'v' || o_orderkey AS version_name, o_orderstatus AS status FROM orders)
         SELECT child_id AS version_id, parent_id AS related_id, dataset_name, version_name, status,
           kind AS transformation_type, 'parent' AS relation
         FROM edges JOIN versions ON id = parent_id
         UNION ALL
         SELECT parent_id, child_id, dataset_name, version_name, status, kind, 'child'
         FROM edges JOIN versions ON id = child_id""",
)
def lineage(spark, sf_dir):
    edges = catalog.add_lineage(None, views.lineage_edges(spark, sf_dir))
    versions = views.table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("version_id"),
        F.concat(F.lit("dataset_"), F.col("o_custkey").cast("string")).alias("dataset_name"),
        F.concat(F.lit("v"), F.col("o_orderkey").cast("string")).alias("version"),
        F.col("o_orderstatus").alias("status"),
    )
    return catalog.lineage(edges, versions)


@query(
    "lineage_new_edges",
    with_views("edges")
    + """, old AS (SELECT DISTINCT l_orderkey AS child_id, l_partkey AS parent_id FROM lineitem
              WHERE l_linestatus = 'F')
         SELECT l_orderkey AS child_id, l_partkey AS parent_id,
           min(CASE WHEN l_returnflag = 'A' THEN 'aggregation' ELSE 'filter' END) AS transformation_type
         FROM lineitem WHERE l_linestatus = 'O' AND NOT EXISTS (
           SELECT 1 FROM old WHERE child_id = l_orderkey AND parent_id = l_partkey)
         GROUP BY l_orderkey, l_partkey""",
)
def lineage_new_edges(spark, sf_dir):
    line = views.table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("child_id"),
        F.col("l_partkey").alias("parent_id"),
        F.when(F.col("l_returnflag") == "A", "aggregation").otherwise("filter").alias("transformation_type"),
        "l_linestatus",
    )
    old = line.where(F.col("l_linestatus") == "F").select("child_id", "parent_id").distinct()
    new = line.where(F.col("l_linestatus") == "O").drop("l_linestatus")
    return catalog.add_lineage(old, new)


@query(
    "dq_unknown_versions",
    with_views("f_wind")
    + """SELECT DISTINCT dataset_version FROM f_wind WHERE dataset_version NOT IN (
           SELECT year(o_orderdate) || 'Q' || quarter(o_orderdate) || '_v1' FROM orders)""",
)
def unknown_versions(spark, sf_dir):
    made = views.table(spark, sf_dir, "orders").select(
        F.concat(
            F.year("o_orderdate").cast("string"), F.lit("Q"), F.quarter("o_orderdate").cast("string"),
            F.lit("_v1"),
        ).alias("version")
    )
    return quality.unknown_versions(curated_table(spark, sf_dir, "wind"), made)


# --------------------------------------------------------------- listings

view(
    "manifest",
    ("hourly",),
    f"""SELECT variable, printf('%05d', station_id) AS station_id,
              printf('%s%05d_%d0101_%d1231_hist.zip', prefix, station_id, year, year) AS filename,
              year::VARCHAR AS year
       FROM (SELECT DISTINCT station_id, year FROM hourly),
            (VALUES {", ".join(f"('{v}', '{p}')" for v, p in PRODUCT_PREFIXES.items())})
              AS prefixes(variable, prefix)""",
)


@query(
    "manifest",
    with_views("manifest")
    + """SELECT variable, station_id, filename, year,
           'raw/dwd/' || variable || '/station_' || station_id || '/' || year || '/' || filename
             AS object_path FROM manifest""",
)
def manifest(spark, sf_dir):
    return listing.parse_listing(views.listing_pages(spark, sf_dir))


@query(
    "manifest_new_files",
    with_views("manifest", "stations")
    + """SELECT variable, station_id, filename, year FROM manifest
         WHERE year >= '2000' AND station_id IN (
           SELECT printf('%05d', station_id) FROM stations WHERE is_active)""",
)
def manifest_new_files(spark, sf_dir):
    found = listing.parse_listing(views.listing_pages(spark, sf_dir))
    loaded = found.where(F.col("year") < "2000").select("object_path")
    active = views.stations(spark, sf_dir).where("is_active")
    wanted = listing.restrict_stations(
        found, active.select(station_code("station_id").alias("station_id"))
    )
    return listing.skip_loaded(wanted, loaded).select("variable", "station_id", "filename", "year")


@query(
    "ingestion_statistics",
    with_views("manifest")
    + """SELECT variable, count(*) AS total_files, count(*) FILTER (WHERE year >= '2000') AS processed,
           count(*) FILTER (WHERE year < '2000') AS skipped, 0::BIGINT AS failed,
           coalesce(sum(length(filename)) FILTER (WHERE year >= '2000'), 0)::BIGINT AS total_bytes
         FROM manifest GROUP BY variable""",
)
def ingestion_statistics(spark, sf_dir):
    found = listing.parse_listing(views.listing_pages(spark, sf_dir))
    loaded = found.where(F.col("year") < "2000").select("object_path")
    files = listing.with_status(found, loaded).withColumn("size_bytes", F.length("filename"))
    return runs.ingestion_statistics(files, "variable")


@query(
    "object_paths",
    with_views("hourly")
    + """SELECT DISTINCT 'wind' AS path_variable, printf('%05d', station_id) AS path_station,
           year::VARCHAR AS path_year, printf('stundenwerte_FF_%05d_%d0101_%d1231_hist.zip',
             station_id, year, year) AS path_file, year::VARCHAR AS period_year FROM hourly""",
)
def object_paths(spark, sf_dir):
    rows = views.hourly(spark, sf_dir).select(STATION, F.year("timestamp").alias("year")).distinct()
    file = F.format_string(
        "stundenwerte_FF_%05d_%d0101_%d1231_hist.zip", F.col(STATION), F.col("year"), F.col("year")
    )
    paths = rows.select(object_path(F.lit("wind"), STATION, "year", file).alias("path"))
    out = path_columns(paths, "path")
    return out.withColumn("period_year", period_year("path_file")).drop("path")


# ------------------------------------------------------------ raw sources

_AIR_SQL = """SELECT station_id AS "STATIONS_ID", strftime(ts, '%Y%m%d%H') AS "MESS_DATUM",
    qn AS "QN_9", raw_tt AS "TT_TU", raw_rf AS "RF_TU", ts AS "timestamp" FROM hourly"""


@query("text_roundtrip", with_views("hourly") + _AIR_SQL)
def text_roundtrip(spark, sf_dir):
    """Observations as raw lines, parsed back."""
    lines = views.raw_lines(spark, sf_dir, "air_temperature").select("value")
    return observations.parse_lines(lines, "air_temperature")


@query("text_file_roundtrip", with_views("hourly") + _AIR_SQL)
def text_file_roundtrip(spark, sf_dir):
    """The same through files in a folder tree, read with the CSV source."""
    product = "air_temperature"
    folder = Layout(shared_folder(spark, "raw")).raw(product)
    rows = views.parsed(spark, sf_dir, product).withColumn("eor", F.lit("eor"))
    rows.withColumn("part", F.year("timestamp")).drop("timestamp").write.partitionBy("part").options(
        sep=";", header="true"
    ).csv(folder)
    read = observations.read_observations(spark, folder, product, pattern="*.csv")
    return read.drop("_source_file", "_source_prefix", "_parsed_at")


@query("archive_roundtrip", with_views("hourly") + _AIR_SQL)
def archive_roundtrip(spark, sf_dir):
    """The same through one stored archive per station and year."""
    unpacked, _ = views.unpacked_archives(spark, sf_dir, "air_temperature")
    return observations.parse_lines(archives.unpacked_lines(unpacked), "air_temperature")


@query(
    "archive_checked_lines",
    with_views("hourly")
    + """, even AS (SELECT station_id, year FROM hourly GROUP BY station_id, year HAVING count(*) % 2 = 0)
         SELECT station_id AS "STATIONS_ID", ts AS "timestamp", raw_tt AS "TT_TU"
         FROM hourly JOIN even USING (station_id, year)""",
)
def archive_checked_lines(spark, sf_dir):
    """Rows of the archives that agree with their side file; digests come from the pass that unpacked them."""
    unpacked, sides = views.unpacked_archives(spark, sf_dir, "air_temperature")
    lines = archives.unpacked_lines(unpacked, sides)
    return observations.parse_lines(lines, "air_temperature").select(STATION, "timestamp", "TT_TU")


@query(
    "checksum_mismatches",
    with_views("hourly")
    + """SELECT printf('station_%05d/%d.zip', station_id, year) AS path FROM hourly
         GROUP BY station_id, year HAVING count(*) % 2 = 1""",
)
def checksum_mismatches(spark, sf_dir):
    """Side files are right where a file has an even number of rows."""
    unpacked, sides = views.unpacked_archives(spark, sf_dir, "air_temperature")
    found = archives.differing(archives.unpacked_digests(unpacked), sides)
    return found.select(F.regexp_extract("path", r"station_[0-9]+/[0-9]+\.zip$", 0).alias("path"))


@query(
    "raw_format",
    with_views("hourly")
    + """SELECT reason, count(*) AS lines FROM (
           SELECT CASE WHEN qn = 1 THEN 'fields' WHEN qn = 2 THEN 'station' WHEN qn = 3 THEN 'time' END
             AS reason FROM hourly) WHERE reason IS NOT NULL GROUP BY reason""",
)
def raw_format(spark, sf_dir):
    """Lines broken on purpose: too few fields, bad station, bad time."""
    lines = _damaged_lines(spark, sf_dir)
    found = quality.raw_format(lines, "air_temperature")
    return found.groupBy("reason").agg(F.count(F.lit(1)).alias("lines"))


def _damaged_lines(spark, sf_dir):
    qn = F.get(F.split("value", ";"), F.lit(2))
    value = (
        F.when(qn == "1", F.substring_index("value", ";", 3))
        .when(qn == "2", F.concat(F.lit("x"), F.col("value")))
        .when(qn == "3", F.regexp_replace("value", r"^(\d+);(\d{8})\d\d", "$1;$2"))
        .otherwise(F.col("value"))
    )
    lines = views.raw_lines(spark, sf_dir, "air_temperature")
    return lines.select(F.lit("all").alias("file"), value.alias("value"))


@query(
    "parse_error_share",
    with_views("hourly")
    + """SELECT count(*) AS total_rows, count(*) FILTER (WHERE qn IN (2, 3)) AS error_rows,
           round(count(*) FILTER (WHERE qn IN (2, 3)) / count(*)::DOUBLE, 6) AS error_share,
           CASE WHEN count(*) FILTER (WHERE qn IN (2, 3)) / count(*)::DOUBLE > 0.3 THEN 'fail'
                ELSE 'pass' END AS status FROM hourly""",
)
def parse_error_share(spark, sf_dir):
    return rounded(quality.text_error_share(_damaged_lines(spark, sf_dir)))


@query(
    "rejected_rows",
    with_views("hourly") + "SELECT qn, count(*) AS rejected FROM hourly WHERE qn IN (2, 3) GROUP BY qn",
)
def rejected_rows(spark, sf_dir):
    """Rows without station or time, set apart by the parser."""
    # Broken lines that still have five fields.
    rows = observations.parse_lines(_damaged_lines(spark, sf_dir), "air_temperature")
    _, rejected = cleaning.split_rejects(rows)
    return rejected.groupBy(F.col("QN_9").alias("qn")).agg(F.count(F.lit(1)).alias("rejected"))


@query(
    "station_list",
    with_views("stations")
    + """SELECT station_id, station_name, round(latitude, 6) AS latitude,
           round(longitude, 6) AS longitude, elevation_m, state, start_date, end_date, is_active
         FROM stations""",
)
def station_list(spark, sf_dir):
    """Stations as lines of the list file, parsed back."""
    day = "yyyyMMdd"
    s = views.stations(spark, sf_dir)
    end = F.coalesce(F.date_format("end_date", day), F.lit("99999999"))
    line = F.concat_ws(
        ";", station_code("station_id"), F.date_format("start_date", day), end, "elevation_m",
        "latitude", "longitude", "station_name", "state",
    )
    return rounded(stations.parse_station_lines(s.select(line.alias("value"))))


@query(
    "dq_missing_products",
    with_views("manifest")
    + """SELECT name AS path_variable FROM (VALUES ('air_temperature'), ('precipitation'), ('wind'),
           ('snow_depth')) AS wanted(name)
         WHERE name NOT IN (SELECT variable FROM manifest)""",
)
def missing_products(spark, sf_dir):
    found = listing.parse_listing(views.listing_pages(spark, sf_dir))
    objects = path_columns(found.select("object_path"), "object_path")
    return quality.missing_products(
        objects, ("air_temperature", "precipitation", "wind", "snow_depth")
    )


# ---------------------------------------------------------- staged, curated

_G = "station_id, year, quarter, dataset_version"


@query(
    "staged_quarter",
    with_views("hourly")
    + """SELECT station_id AS "STATIONS_ID", ts AS "timestamp", nullif(raw_f, -999) AS "F",
           qn >= 5 AS quality_acceptable FROM hourly WHERE year = 1998 AND quarter = 2""",
)
def staged_quarter(spark, sf_dir):
    """Written to the staged zone, one quarter read back."""
    zone = Layout(shared_folder(spark, "staged"))
    tables.write_staged(views.cleaned(spark, sf_dir, "wind"), zone.staged("wind"))
    back = staged.load_staged(spark, zone, "wind", 1998, 2, "1998Q2_staged_v1")
    return back.select(STATION, "timestamp", "F", "quality_acceptable")


@query(
    "staged_statistics",
    with_views("hourly")
    + """SELECT count(*) AS total_rows, min(ts) AS min_timestamp, max(ts) AS max_timestamp,
           count(DISTINCT station_id) AS distinct_stations FROM hourly""",
)
def staged_statistics(spark, sf_dir):
    """Read-back check of a staged table laid out by station and year."""
    zone = Layout(shared_folder(spark, "staged"))
    rows = views.staged(spark, sf_dir, "moisture")
    tables.write_by_station(rows, zone.staged("moisture"), mode="append", parallel_commit=True, rebalance=False)
    read, tasks = (STATION, "timestamp"), views.tasks_for(spark, sf_dir, "lineitem")
    stored = tables.read_by_station(spark, zone.staged("moisture"), rows.schema, tasks, read)
    found = tables.table_statistics(stored, "_file", len(rows.columns))
    return found.select("total_rows", "min_timestamp", "max_timestamp", "distinct_stations")


@query(
    "upsert",
    with_views("f_humidity")
    + f"""SELECT {_G}, CASE WHEN year >= 2000 THEN count_observations + 1000 ELSE count_observations END
             AS count_observations
          FROM f_humidity WHERE NOT (year = 1996 AND quarter = 4)
            AND NOT (year = 1997 AND quarter = 1 AND station_id = 3)""",
)
def upsert(spark, sf_dir):
    """Two runs, the second replacing later quarters; then a quarter and a station deleted."""
    path = Layout(shared_folder(spark, "curated")).curated("humidity")
    rows = curated_table(spark, sf_dir, "humidity").select(*_G.split(", "), "count_observations")
    tables.upsert_features(rows, path)
    later = rows.where("year >= 2000").withColumn("count_observations", F.col("count_observations") + 1000)
    tables.upsert_features(later, path, targets=[("1996Q4_v1", 1996, 4)])
    tables.delete_features(spark, path, ("1997Q1_v1", 1997, 1), station_id=3)
    return spark.read.parquet(path).select(
        "station_id", "year", "quarter", "dataset_version", "count_observations"
    )


@query(
    "schema_evolution",
    with_views("f_wind")
    + f"""SELECT {_G}, gust_hours, CASE WHEN year >= 2000 THEN calm_hours ELSE -1 END AS calm_hours
          FROM f_wind""",
)
def schema_evolution(spark, sf_dir):
    """Partitions written before and after a column was added and another widened, read under one schema."""
    path = Layout(shared_folder(spark, "versions")).curated("wind")
    rows = curated_table(spark, sf_dir, "wind").select(*_G.split(", "), "gust_hours", "calm_hours")
    old = rows.where("year < 2000").drop("calm_hours").withColumn("gust_hours", F.col("gust_hours").cast("int"))
    new = rows.where("year >= 2000")
    tables.upsert_features(old, path)
    tables.upsert_features(new, path)
    both = staged.load_versions(spark, path, enrich.wider_schema(old.schema, new.schema))
    return enrich.fill_missing(both, {"calm_hours": -1})


# ------------------------------------------------------------- run records

@query(
    "run_quality",
    with_views("tagged")
    + """SELECT product, year, round(avg(missingness_ratio), 6) AS avg_missingness_ratio,
           count(DISTINCT station_id) AS total_stations, count(*) AS feature_count
         FROM tagged GROUP BY product, year""",
)
def run_quality(spark, sf_dir):
    rows = quality.tagged(views.curated(spark, sf_dir), "station_id", "year", "missingness_ratio")
    return rounded(runs.run_quality(rows, "product", "year"))


@query(
    "ingestion_runs",
    """SELECT o_orderkey AS run_id, 'variable_' || o_custkey % 7 AS variable,
         coalesce(max(CASE WHEN l_linestatus = 'F' THEN 'completed' END), 'running') AS status,
         count(l_orderkey) AS events FROM orders LEFT JOIN lineitem ON l_orderkey = o_orderkey
       GROUP BY ALL""",
)
def ingestion_runs(spark, sf_dir):
    """Runs started per order; a line with status F completes its run."""
    at = F.col("o_orderdate").alias("at")
    started = views.table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("run_id"), at, F.lit(0).alias("step"),
        F.concat(F.lit("variable_"), (F.col("o_custkey") % 7).cast("string")).alias("variable"),
        F.lit("running").alias("status"),
    )
    line = views.table(spark, sf_dir, "lineitem")
    # Updates come later than any start, so that the state follows from them alone.
    updated = line.select(
        F.col("l_orderkey").alias("run_id"),
        (F.col("l_shipdate") + F.expr("INTERVAL '3650' DAY")).alias("at"),
        F.lit(1).alias("step"),
        F.when(F.col("l_linestatus") == "F", "completed").alias("status"),
    )
    state = runs.fold_runs(started.unionByName(updated, allowMissingColumns=True))
    counts = line.groupBy(F.col("l_orderkey").alias("run_id")).agg(F.count(F.lit(1)).alias("events"))
    return state.join(counts, "run_id", "left").select(
        "run_id", "variable", "status", F.coalesce("events", F.lit(0).cast("bigint")).alias("events")
    )


@query(
    "raw_to_curated",
    contract_sql("pressure"),
)
def raw_to_curated(spark, sf_dir):
    """The whole way by jobs: raw files, staged table, curated table, read back."""
    product, table = "pressure", "pressure"
    zone = Layout(shared_folder(spark, "zones"))
    raw = views.parsed(spark, sf_dir, product).drop("timestamp")
    raw.write.options(sep=";", header="true").csv(zone.raw(product))
    jobs.stage(spark, zone, product, version="all_staged_v1", pattern="*.csv")
    jobs.curate(
        spark, zone, product, views.stations(spark, sf_dir),
        staged_version="all_staged_v1", version=version_name("year", "quarter"),
    )
    out = staged.load_features(spark, zone, table).drop("computed_at")
    return out.select(
        *[
            F.col(f.name).cast("double").alias(f.name) if f.dataType.typeName() == "decimal" else f.name
            for f in out.schema.fields
        ]
    )


@query(
    "batch_summary",
    """SELECT count(*) AS total, count(*) FILTER (WHERE o_orderstatus <> 'F') AS successful,
         count(*) FILTER (WHERE o_orderstatus = 'F') AS failed,
         round(count(*) FILTER (WHERE o_orderstatus <> 'F') / count(*)::DOUBLE, 6) AS success_share
       FROM orders""",
)
def batch_summary(spark, sf_dir):
    """A run log with one run per order."""
    status = F.when(F.col("o_orderstatus") == "F", "failed").otherwise("success")
    log = views.table(spark, sf_dir, "orders").select(status.alias("status"))
    return rounded(runs.batch_summary(log))
