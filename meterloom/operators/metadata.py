"""Entity metadata: attribute enrichment and selection by id."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meterloom.functions.text import attributes_in, display_name, non_empty
from meterloom.sources.tables import basic_metadata

Attributes = tuple[DataFrame, DataFrame, DataFrame]

ATTRIBUTES = ("friendly_name", "device_class", "state_class")
_NO_CLASSES = ("CAST(NULL AS STRING) AS device_class", "CAST(NULL AS STRING) AS state_class")


def without_attributes(meta: DataFrame) -> DataFrame:
    """Metadata when no attribute history exists: the stored name stands in."""
    return basic_metadata(meta).selectExpr("*", "name AS friendly_name", *_NO_CLASSES)


def latest_attributes(states: DataFrame, untimed: bool = False) -> DataFrame:
    """The attribute set in force per entity: newest state that has one, ties by highest id. A
    state without a time counts only if `untimed`, and then behind all others.

    The states are read once, in two aggregates over fixed-width numbers with map-side combine: the
    highest set per entity and time, then the set of the latest time. An entity with a long history
    is spread over its times in the first and is one row per task in the second."""
    known = states.filter("attributes_id IS NOT NULL AND metadata_id IS NOT NULL")
    if not untimed:
        known = known.filter("last_updated_ts IS NOT NULL")
    highest = known.groupBy("metadata_id", "last_updated_ts").agg(F.max("attributes_id").alias("highest"))
    # Without any time there is one row, and no latest.
    latest = F.coalesce(F.max_by("highest", "last_updated_ts"), F.max("highest"))
    return highest.groupBy("metadata_id").agg(latest.alias("attributes_id"))


def entity_attributes(
    attributes: Attributes, small: bool = False, untimed: bool = False
) -> DataFrame:
    """One row per known entity id with its latest attributes; JSON is read after the join.

    There are far more attribute sets than entities. When the entities (states_meta) were measured
    as small, a broadcast of their ids in force thins the sets, so their texts are never shuffled;
    states of other entities do not count towards it."""
    states_meta, states, attribute_sets = attributes
    if small:
        listed = F.broadcast(states_meta.select("metadata_id"))
        states = states.join(listed, "metadata_id", "left_semi")
    latest = latest_attributes(states, untimed)
    if small:
        in_force = F.broadcast(latest.select("attributes_id"))
        attribute_sets = attribute_sets.join(in_force, "attributes_id", "left_semi")
    joined = states_meta.join(latest, "metadata_id", "left").join(
        attribute_sets, "attributes_id", "left"
    )
    return joined.selectExpr("entity_id", "metadata_id", attributes_in("shared_attrs", ATTRIBUTES))


def attributes_of(entities: DataFrame, attributes: Attributes, small: bool = False) -> DataFrame:
    """Latest attributes of the listed entities, nulls where nothing is known."""
    looked_up = _one_per_entity(entity_attributes(attributes, small, untimed=True))
    listed = entities.selectExpr("statistic_id AS entity_id")
    return listed.join(looked_up, "entity_id", "left")


def _one_per_entity(looked_up: DataFrame) -> DataFrame:
    """An entity id listed twice keeps the attributes of its highest metadata id. Grouping and
    the join that follows share the key, so this adds no shuffle of its own."""
    newest = F.expr(f"max_by(struct({', '.join(ATTRIBUTES)}), metadata_id)")
    return looked_up.groupBy("entity_id").agg(newest.alias("a")).select("entity_id", "a.*")


def _drop_timestamp_entities(meta: DataFrame) -> DataFrame:
    return meta.filter("NOT state_class <=> 'timestamp'")


def _joined(meta: DataFrame, looked_up: DataFrame) -> DataFrame:
    return meta.join(looked_up, meta["statistic_id"] == looked_up["entity_id"], "left")


def enriched(
    meta: DataFrame, attributes: Attributes | None, small: bool = False
) -> DataFrame:
    """All metadata rows. An attribute name that is an empty string is kept."""
    if attributes is None:
        return without_attributes(meta)
    base = basic_metadata(meta)
    name = f"coalesce(friendly_name, {display_name('statistic_id')}) AS friendly_name"
    rows = _joined(base, entity_attributes(attributes, small))
    return _drop_timestamp_entities(
        rows.selectExpr(*base.columns, name, "device_class", "state_class")
    )


def latest_per_entity(meta: DataFrame) -> DataFrame:
    """The row with the highest id per statistic id."""
    base = basic_metadata(meta)
    rest = [c for c in base.columns if c not in ("statistic_id", "id")]
    newest = base.groupBy("statistic_id").agg(
        F.max("id").alias("id"), F.expr(f"max_by(struct({', '.join(rest)}), id)").alias("row")
    )
    return newest.select("id", "statistic_id", "row.*")


def enriched_latest(
    meta: DataFrame, attributes: Attributes | None, small: bool = False
) -> DataFrame:
    """One row per entity. A missing or empty attribute name is derived from the id."""
    base = latest_per_entity(meta)
    derived = display_name("statistic_id")
    if attributes is None:
        return base.selectExpr("*", f"{derived} AS friendly_name", *_NO_CLASSES)
    name = f"coalesce({non_empty('friendly_name')}, {derived}) AS friendly_name"
    rows = _joined(base, _one_per_entity(entity_attributes(attributes, small, untimed=True)))
    return _drop_timestamp_entities(
        rows.selectExpr(*base.columns, name, "device_class", "state_class")
    )


def by_ids(meta: DataFrame, ids: DataFrame, id_column: str = "id") -> DataFrame:
    """Basic metadata of the listed ids. The list may be the id column of a fact table; it is made
    distinct with map-side combine, so a hot id is one row per task."""
    wanted = ids.selectExpr(f"{id_column} AS id").distinct()
    return basic_metadata(meta).join(wanted, "id", "left_semi")


def malformed_attributes(attribute_sets: DataFrame) -> DataFrame:
    """How many attribute texts are not valid JSON (they read as null)."""
    bad = "shared_attrs IS NOT NULL AND get_json_object(shared_attrs, '$') IS NULL"
    return attribute_sets.selectExpr(f"count_if({bad}) AS malformed", "count(*) AS total")
