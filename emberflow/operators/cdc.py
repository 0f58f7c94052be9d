"""Database change records: normalise, filter, route by configuration, and
derive current images / retract rows / dimension upserts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from emberflow import schemas as S


def cdc_normalize(raw: DataFrame, topic: str = "topic", value: str = "value") -> DataFrame:
    """Raw change record -> envelope ``database, tableName, before, after, type``.

    Database and table come from the topic ``server.database.table``; a
    missing image becomes an empty map; op ``c`` is ``insert``, ``u``
    ``update``, ``d`` ``delete``, ``r`` ``read``, ``t`` ``truncate``, ``m``
    ``message``. Other input columns are kept.
    """
    parts = F.split(F.col(topic), r"\.")
    rec = F.from_json(F.col(value), S.CHANGE_VALUE)
    empty = F.create_map().cast(S.STR_MAP)
    keep = [c for c in raw.columns if c not in (topic, value)]
    op = F.col("_r.op")
    # op letters of the change connector (fixed values): c create (named
    # insert), u update, d delete, r read (snapshot), t truncate, m message
    kind = (F.when(op == "c", "insert").when(op == "u", "update").when(op == "d", "delete")
            .when(op == "r", "read").when(op == "t", "truncate").when(op == "m", "message")
            .otherwise(F.lower(op)))
    # ``inline`` of a one-row array is a plan barrier: filters on the parsed
    # record stay above it, so each record is parsed once.
    parsed = raw.select(*keep, F.inline(F.array(F.struct(
        parts.getItem(1).alias("database"), parts.getItem(2).alias("tableName"), rec.alias("_r")))))
    return parsed.select(
        *keep, "database", "tableName",
        F.coalesce(F.col("_r.before"), empty).alias("before"),
        F.coalesce(F.col("_r.after"), empty).alias("after"),
        kind.alias("type"), F.col("_r.ts_ms").alias("ts_ms"))


def cdc_drop_deletes(envelopes: DataFrame) -> DataFrame:
    """Keep everything but deletes (a null type is kept)."""
    return envelopes.filter(~F.col("type").eqNullSafe("delete"))


def cdc_current_image(envelopes: DataFrame, pk: str = "id",
                      order: tuple = ("ts_ms", "partition", "seq")) -> DataFrame:
    """Current state per (table, key): the newest change wins, deleted keys
    disappear. An aggregate (``max_by``), partially combined per map task."""
    ordering = F.struct(*[F.col(c) for c in order if c in envelopes.columns])
    key = F.coalesce(F.col("after")[pk], F.col("before")[pk])
    latest = (envelopes.groupBy("database", "tableName", key.alias("pk"))
              .agg(F.max_by(F.struct("type", "after", *[F.col(c) for c in order
                                                        if c in envelopes.columns]),
                            ordering).alias("_l")))
    return latest.filter(~F.col("_l.type").eqNullSafe("delete")).select(
        "database", "tableName", "pk", F.col("_l.after").alias("image"),
        F.col("_l.type").alias("last_type"),
        *[F.col(f"_l.{c}").alias(c) for c in order if c in envelopes.columns])


def snapshot_then_changes(snapshot: DataFrame, changes: DataFrame) -> DataFrame:
    """Snapshot rows (``database, tableName, image``) as ``read`` records that
    come before every change, then the changes: the envelopes of a capture that
    starts with a full read."""
    first = snapshot.select("database", "tableName", F.create_map().cast(S.STR_MAP).alias("before"),
                            F.col("image").alias("after"), F.lit("read").alias("type"),
                            F.lit(None).cast("bigint").alias("ts_ms"))
    return changes.unionByName(first, allowMissingColumns=True)


def retract_rows(envelopes: DataFrame) -> DataFrame:
    """``(false, before)`` then ``(true, after)`` per change; empty images dropped."""
    keep = [c for c in envelopes.columns if c not in ("before", "after")]
    pairs = F.array(F.struct(F.lit(False).alias("is_add"), F.col("before").alias("row")),
                    F.struct(F.lit(True).alias("is_add"), F.col("after").alias("row")))
    return (envelopes.select(*keep, F.explode(pairs).alias("_p"))
            .filter(F.cardinality("_p.row") > 0)
            .select(*keep, "_p.is_add", "_p.row"))


# --------------------------------------------------------------------------
# Routing by the configuration table
# --------------------------------------------------------------------------
def current_config(config: DataFrame) -> DataFrame:
    """Newest config row per ``(source_table, operate_type)``; keys are never
    removed. Bounded by the number of configured tables x operations."""
    return (config.groupBy("source_table", "operate_type")
            .agg(F.max_by(F.struct(*[c for c in config.columns
                                      if c not in ("source_table", "operate_type")]),
                          F.col("version")).alias("_c"))
            .select("source_table", "operate_type", "_c.*"))


def route_join(envelopes: DataFrame, config: DataFrame) -> DataFrame:
    """Attach the routing row of ``tableName-type``; unmatched rows are dropped
    (see ``route_unmatched``). The config is a handful of rows per table, so it
    is broadcast: every task sees the whole map, as broadcast state does."""
    cfg = current_config(config)
    return envelopes.join(
        F.broadcast(cfg),
        (F.col("tableName") == F.col("source_table")) & (F.col("type") == F.col("operate_type")),
        "inner").drop("source_table", "operate_type")


def config_from_changes(envelopes: DataFrame, table: str = "table_process") -> DataFrame:
    """Configuration rows from the change records of their table, with
    ``effective_ms``, the time of the change. A deleted row keeps its route's
    key with no sink, so later records of that key have no route."""
    image = F.when(F.col("type") == "delete", F.col("before")).otherwise(F.col("after"))
    rows = envelopes.filter(F.col("tableName") == table).select("type", "ts_ms", image.alias("image"))
    out = []
    for f in S.TABLE_PROCESS.fields:
        value = F.col("image")[f.name].cast(f.dataType)
        out.append((F.when(F.col("type") != "delete", value) if f.name.startswith("sink") else value).alias(f.name))
    return rows.select(*out, F.col("ts_ms").alias("effective_ms"))


def route_join_as_of(envelopes: DataFrame, config_log: DataFrame, at: str = "ts_ms") -> DataFrame:
    """``route_join`` by the configuration as it was at each record's ``at``.

    ``config_log`` has every version of a route with its ``effective_ms``; the
    last one not after the record counts (of equal times the highest version).
    So a record is routed in the same way whenever it is processed: late, again
    after a failure, or in a backfill. A key's versions are one sorted array on
    the broadcast side (as many as it was configured times), so no row is
    joined to several.
    """
    fields = [c for c in config_log.columns if c not in ("source_table", "operate_type", "effective_ms")]
    version = F.struct("effective_ms", *(["version"] if "version" in fields else []), F.struct(*fields).alias("c"))
    history = config_log.groupBy("source_table", "operate_type").agg(F.sort_array(F.collect_set(version)).alias("_versions"))
    joined = envelopes.join(F.broadcast(history), (F.col("tableName") == F.col("source_table")) & (F.col("type") == F.col("operate_type")), "inner")
    known = F.filter("_versions", lambda v: v["effective_ms"] <= F.col(at))
    routed = joined.withColumn("_c", F.when(F.size(known) > 0, F.element_at(known, -1)["c"]))
    return (routed.where("_c.sink_type is not null").select(*envelopes.columns, *[F.col(f"_c.{c}").alias(c) for c in fields]))


def route_unmatched(envelopes: DataFrame, config: DataFrame) -> DataFrame:
    if "effective_ms" in config.columns:
        every = config.groupBy("source_table", "operate_type").agg(F.sort_array(F.collect_set(F.struct("effective_ms", "version", "sink_type"))).alias("_v"))
        joined = envelopes.join(F.broadcast(every), (F.col("tableName") == F.col("source_table")) & (F.col("type") == F.col("operate_type")), "left")
        known = F.filter("_v", lambda v: v["effective_ms"] <= F.col("ts_ms"))
        return joined.where(F.when(F.size(known) > 0, F.element_at(known, -1)["sink_type"]).isNull()).select(*envelopes.columns)
    cfg = current_config(config).select("source_table", "operate_type")
    return envelopes.join(
        F.broadcast(cfg),
        (F.col("tableName") == F.col("source_table")) & (F.col("type") == F.col("operate_type")),
        "left_anti")


def route_columns(routed: DataFrame) -> DataFrame:
    """Keep only the ``after`` keys listed in ``sink_columns`` (exact match)."""
    return routed.withColumn("after", F.map_filter(
        "after", lambda k, v: F.array_contains(F.split(F.col("sink_columns"), ","), k)))


def route_branch(routed: DataFrame, sink_type: str) -> DataFrame:
    """``kafka`` rows are facts, ``hbase`` rows dimensions; other types drop."""
    return routed.filter(F.col("sink_type") == sink_type)


def route(envelopes: DataFrame, config: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Full routing: drop deletes, match config, prune, split into
    ``(facts, dims)``. A configuration with ``effective_ms`` is a log of its
    versions and is read as of each record's time."""
    join = route_join_as_of if "effective_ms" in config.columns else route_join
    routed = route_columns(join(cdc_drop_deletes(envelopes), config))
    return route_branch(routed, S.SINK_TYPE_KAFKA), route_branch(routed, S.SINK_TYPE_HBASE)


def dim_table_schema(sink_columns: str):
    """All-string table shape of a dimension (names as configured, upper-cased)."""
    from pyspark.sql import types as T
    return T.StructType([T.StructField(c.upper(), T.StringType())
                         for c in sink_columns.split(",")])


def dim_table_columns(dims: DataFrame, config: DataFrame) -> DataFrame:
    """Columns of the dimension tables, as configured and as the changes fill them.

    ``dims`` are routed dimension changes. One row per table and configured
    column (all strings, upper-case names): its position, whether it is the
    key, the table's extra clause, how many changes carry the column, and how
    many of them with a value. Columns that no change carries have zeros.
    """
    filled = (dims.select("sink_table", F.explode("after").alias("col", "value"))
              .groupBy("sink_table", "col").agg(F.count(F.lit(1)).alias("n_changes"), F.count("value").alias("n_values")))
    named = (current_config(config).filter(F.col("sink_type") == S.SINK_TYPE_HBASE)
             .select("sink_table", F.coalesce("sink_pk", F.lit("id")).alias("pk"), F.coalesce("sink_extend", F.lit("")).alias("extend"),
                     F.posexplode(F.split("sink_columns", ",")).alias("position", "col"))
             .groupBy("sink_table", "col").agg(F.min("position").alias("position"), F.min("pk").alias("pk"), F.min("extend").alias("extend")))
    return named.join(filled, ["sink_table", "col"], "left").select(
        "sink_table", (F.col("position") + 1).alias("position"), F.upper("col").alias("name"), F.lit("string").alias("type"),
        (F.col("col") == F.col("pk")).alias("is_key"), "extend",
        F.coalesce("n_changes", F.lit(0).cast("bigint")).alias("n_changes"),
        F.coalesce("n_values", F.lit(0).cast("bigint")).alias("n_values"))


# --------------------------------------------------------------------------
# Dimension upsert
# --------------------------------------------------------------------------
def dim_upsert(current: DataFrame | None, changes: DataFrame, columns: list[str],
               pk: str = "id", order: tuple = ("ts_ms", "partition", "seq")) -> DataFrame:
    """Apply routed dimension changes to a dimension table.

    ``changes`` holds ``after`` maps (already pruned). Per key and column the
    newest value among the changes that *contain* that column wins; columns a
    change does not carry, and stored columns that ``columns`` does not name,
    keep their old value. Stored columns are upper-case strings; the key is
    ``pk`` in upper case. Work is two aggregates (per key+column, then per key)
    and one outer join on the key, so a busy key is combined map-side.
    """
    key = pk.upper()
    order = [c for c in order if c in changes.columns]
    seq = F.struct(*[F.col(c) for c in order])
    cells = (changes.select(F.col("after")[pk].alias("_pk"), seq.alias("_seq"),
                            F.explode("after").alias("_col", "_val"))
             .filter(F.col("_col").isin(columns) & F.col("_pk").isNotNull()))
    newest = cells.groupBy("_pk", "_col").agg(F.max_by("_val", "_seq").alias("_val"))
    # pivot the few configured columns back into a row per key
    wide = newest.groupBy("_pk").agg(*[
        F.max(F.when(F.col("_col") == c, F.struct(F.lit(True).alias("has"), F.col("_val").alias("v")))).alias(f"_n_{c}")
        for c in columns])
    new = {c.upper(): F.col(f"_n_{c}") for c in columns if c.upper() != key}
    if current is None:
        return wide.select(F.col("_pk").alias(key), *[v["v"].alias(n) for n, v in new.items()])
    joined = current.alias("cur").join(wide, F.col(f"cur.{key}") == F.col("_pk"), "full_outer")
    out = [F.coalesce(F.col("_pk"), F.col(f"cur.{key}")).alias(key)]
    names = [c for c in current.columns if c != key]
    for name in [*names, *[n for n in new if n not in names]]:
        old = F.col(f"cur.{name}") if name in names else F.lit(None)
        value = F.when(F.coalesce(new[name]["has"], F.lit(False)), new[name]["v"]).otherwise(old) if name in new else old
        out.append(value.cast("string").alias(name))
    return joined.select(*out)
