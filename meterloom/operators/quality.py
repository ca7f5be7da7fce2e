"""Validation, repair, metrics and issue reports."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meterloom.functions import quality as q
from meterloom.functions.numeric import finite_or_null, is_infinite, percent
from meterloom.functions.sql import lit, one_of, total
from meterloom.operators.sizing import maybe_broadcast
from meterloom.rules import QualityRules, ScanRules
from meterloom.schemas import FIELDS

RULES = QualityRules()
SCAN_RULES = ScanRules()


def with_limits(entities: DataFrame, rules: QualityRules = RULES) -> DataFrame:
    """Attach the value limits to the entity side, before it meets the readings."""
    limits = [f"{sql} AS {name}" for name, sql in q.limits(rules).items()]
    tightest = [f"{sql} AS {name}" for name, sql in q.TIGHTEST.items()]
    return entities.selectExpr("*", *limits).selectExpr("*", *tightest)


def screen(first: DataFrame, rules: QualityRules = RULES) -> DataFrame:
    """The part of the judgement that needs no entity: is the time valid, and what is left of
    each field without NaN, infinities and sentinels. Done before the entities are attached,
    it keeps the expressions behind the join small: generated code beyond a certain method
    size is not compiled by the JVM."""
    others = [c for c in first.columns if c not in FIELDS]
    return first.selectExpr(
        *others,
        *[f"{f} AS raw_{f}" for f in FIELDS],
        *[f"{q.usable_or_null(f, rules)} AS usable_{f}" for f in FIELDS],
        f"{q.is_valid_time('start_ts', rules)} AS time_ok",
    )


def judge(screened: DataFrame) -> DataFrame:
    """Repair the fields of screened readings by the limits of their entities.

    Adds status (valid, corrected, invalid), why a reading is invalid, and per-reading counts.
    The raw fields stay available as raw_<field> for reports; unused ones are pruned."""
    usable = [f"usable_{f}" for f in FIELDS]
    issue_counts = " + ".join(q.issue_count(f"raw_{f}", f"usable_{f}") for f in FIELDS)
    repaired = screened.selectExpr(
        *[c for c in screened.columns if c not in usable],
        *[f"{q.repaired(u)} AS {f}" for f, u in zip(FIELDS, usable)],
        f"CASE WHEN time_ok THEN {issue_counts} ELSE 0 END AS n_issues",
    )
    # Repairing never maps a value to itself, so a difference is a correction.
    counted = repaired.selectExpr(
        "*",
        total(f"coalesce({f} <> raw_{f}, false)" for f in FIELDS) + " AS n_corrected",
        total(f"(raw_{f} IS NOT NULL AND {f} IS NULL)" for f in FIELDS) + " AS n_nulled",
        f"coalesce({', '.join(FIELDS)}) IS NULL AS nothing_left",
    )
    return counted.selectExpr(
        *[c for c in counted.columns if c != "nothing_left"],
        "CASE WHEN NOT time_ok OR nothing_left THEN 'invalid'"
        " WHEN n_corrected > 0 THEN 'corrected' ELSE 'valid' END AS status",
        "CASE WHEN NOT time_ok THEN 'time' WHEN nothing_left THEN 'no field' END"
        " AS invalid_reason",
    )


def validate(matched: DataFrame, rules: QualityRules = RULES) -> DataFrame:
    """Screen and judge readings that already carry their entity and its limits."""
    return judge(screen(matched, rules))


def unvalidated(matched: DataFrame) -> DataFrame:
    """The bypass: every first reading passes, but NaN and infinities never become points."""
    others = [c for c in matched.columns if c not in ("value", "mean")]
    return matched.selectExpr(
        *others,
        *[f"{finite_or_null(f)} AS {f}" for f in ("value", "mean")],
        "true AS time_ok",
        "'valid' AS status",
        "CAST(NULL AS STRING) AS invalid_reason",
        "0 AS n_issues",
        "0 AS n_corrected",
        "0 AS n_nulled",
    )


def with_point_flag(validated: DataFrame) -> DataFrame:
    """Whether a reading leads to a point: its time is valid and state or mean survived. (One
    surviving field makes the reading valid, so its status needs no second look.)"""
    return validated.selectExpr("*", "time_ok AND coalesce(value, mean) IS NOT NULL AS has_point")


def _table_metrics(validated: DataFrame, matched: str = "true") -> DataFrame:
    """Per table, from first readings and their copy counts: one aggregate, then two rows. Only
    readings for which `matched` holds count beyond the total."""

    def of(rank: int, copies: str) -> str:
        mine = f"table_rank = {rank} AND {matched}"
        return f"""named_struct(
            'table_rank', {rank},
            'n_total', coalesce(sum({copies}), 0),
            'n_matched', coalesce(sum({copies}) FILTER (WHERE {matched}), 0),
            'valid_records', count_if({mine} AND status <> 'invalid'),
            'corrected_records', count_if({mine} AND status = 'corrected'),
            'n_issues', coalesce(sum(n_issues) FILTER (WHERE {mine}), 0),
            'n_nulled', coalesce(sum(n_nulled) FILTER (WHERE {mine}), 0),
            'n_points', count_if({mine} AND has_point)) AS t{rank}"""

    wide = with_point_flag(validated).selectExpr(of(0, "n_short"), of(1, "n_long"))
    return wide.selectExpr("inline(array(t0, t1))")


def judge_all(first: DataFrame, entities: DataFrame, small: bool = False) -> DataFrame:
    """All first readings judged, with a flag for those whose entity survived; the metrics of a run
    need the others as well, and one pass has both."""
    side = entities.withColumnRenamed("id", "metadata_id").drop("source")
    side = side.selectExpr("*", "true AS found")
    joined = screen(first).join(maybe_broadcast(side, small), "metadata_id", "left")
    return judge(joined.selectExpr("* EXCEPT (found)", "found IS NOT NULL AS matched"))


def processing_metrics(judged: DataFrame) -> DataFrame:
    """Counters of one run, one row per table, from judge_all: failures are matched but invalid
    (copies included), skipped adds the unmatched."""
    rows = _table_metrics(judged, "matched")
    return rows.withColumnRenamed("n_total", "total_records").selectExpr(
        "table_rank",
        "total_records",
        "valid_records",
        "corrected_records",
        "total_records - valid_records AS skipped_records",
        "n_matched - valid_records AS validation_failures",
        "total_records - n_matched AS unmatched_records",
        "n_issues",
        "n_nulled",
        f"coalesce({percent('valid_records', 'total_records')}, 100D) AS success_rate",
    )


def run_summary(validated: DataFrame) -> DataFrame:
    """Totals of an export run over the readings of the filtered entities."""
    return _table_metrics(validated).selectExpr(
        "sum(n_matched) FILTER (WHERE table_rank = 0) AS short_term_records",
        "sum(n_matched) FILTER (WHERE table_rank = 1) AS long_term_records",
        "sum(n_matched) AS total_records",
        "sum(n_points) FILTER (WHERE table_rank = 0) AS recent_points",
        "sum(n_points) FILTER (WHERE table_rank = 1) AS historical_points",
        "sum(n_points) AS total_points",
        "sum(corrected_records) AS data_corrections",
        "sum(n_matched) - sum(valid_records) AS data_quality_issues",
        f"coalesce({percent('sum(valid_records)', 'sum(n_matched)')}, 100D) AS success_rate",
    )


def issues(validated: DataFrame, rules: QualityRules = RULES) -> DataFrame:
    """One row per issue, for reports; the export itself never explodes."""
    per_field = ", ".join(
        f"named_struct('field', {lit(f)}, 'raw_value', raw_{f},"
        f" 'codes', {q.issue_codes(f'raw_{f}', rules)})"
        for f in FIELDS
    )
    base = ("metadata_id", "statistic_id", "unit_of_measurement", "start_ts", "table_rank")
    bounds = ("unit_low", "unit_high")
    flat = (
        validated.filter("n_issues > 0")
        .selectExpr(*base, *bounds, f"inline(array({per_field}))")
        .selectExpr(*base, *bounds, "field", "raw_value", "explode(codes) AS code")
    )
    limit = (
        "CASE code WHEN 'below_minimum' THEN unit_low WHEN 'above_maximum' THEN unit_high END"
    )
    return flat.selectExpr("*", f"{limit} AS limit_value").selectExpr(
        "metadata_id",
        "statistic_id",
        "start_ts",
        "table_rank",
        "field",
        "raw_value",
        "code",
        f"{q.issue_category('code')} AS issue_category",
        "limit_value",
        q.issue_message("code", "raw_value", "limit_value", "unit_of_measurement") + " AS message",
    )


def _per_entity(issue_rows: DataFrame, *categories: str) -> DataFrame:
    """Issue counts per (category, entity): the common first level of every issue report."""
    return issue_rows.groupBy(*categories, "statistic_id").agg(F.count("*").alias("n"))


def issue_breakdown(issue_rows: DataFrame, *categories: str) -> DataFrame:
    """Issues and distinct entities per category. Two levels, so a category with most of the
    issues is already one row per entity when it is brought together."""
    categories = categories or ("issue_category",)
    return (
        _per_entity(issue_rows, *categories)
        .groupBy(*categories)
        .agg(F.sum("n").alias("n_issues"), F.count("*").alias("n_entities"))
    )


def issue_totals(validated: DataFrame, rules: QualityRules = RULES) -> DataFrame:
    """The same breakdown for the issues of validated readings, without a row or a text per
    issue: integers per category are summed by entity, then turned into one row per category."""
    counts = q.category_counts([f"raw_{f}" for f in FIELDS], rules)
    names = [f"c{i}" for i in range(len(counts))]
    per_entity = (
        validated.filter("n_issues > 0")
        .selectExpr("statistic_id", *[f"{sql} AS {n}" for n, sql in zip(names, counts.values())])
        .groupBy("statistic_id")
        .agg(*[F.sum(n).alias(n) for n in names])
    )
    rows = ", ".join(f"{lit(group)}, {n}" for n, group in zip(names, counts))
    long_form = per_entity.selectExpr(f"stack({len(names)}, {rows}) AS (issue_category, n)")
    return (
        long_form.filter("n > 0")
        .groupBy("issue_category")
        .agg(F.sum("n").alias("n_issues"), F.count("*").alias("n_entities"))
    )


def issue_entity_samples(
    issue_rows: DataFrame, n: int = 3, category: str = "issue_category"
) -> DataFrame:
    """The first n affected entities per category by id, and how many more there are."""
    entities = _per_entity(issue_rows, category)
    position = f"row_number() OVER (PARTITION BY {category} ORDER BY statistic_id) AS position"
    first = entities.selectExpr(category, "statistic_id", position).filter(f"position <= {n}")
    # One row per issue category: bounded by the fixed list of issues.
    counts = entities.groupBy(category).agg(F.count("*").alias("affected"))
    return first.join(F.broadcast(counts), category).selectExpr(
        category, "position", "statistic_id", f"greatest(affected - {n}, 0) AS n_more"
    )


_READING = ("table_rank", "metadata_id", "statistic_id", "unit_of_measurement", "start_ts", "id")


def _fields_as_rows(matched_raw: DataFrame, kind: str) -> DataFrame:
    """One row per (reading, field) for which the expression over raw_value gives a kind. Rows
    are only made for readings with at least one such field."""
    kinds = [kind.replace("raw_value", f) for f in FIELDS]
    hits = matched_raw.filter("matched").filter(
        " OR ".join(f"({k}) IS NOT NULL" for k in kinds)
    )
    fields = ", ".join(
        f"named_struct('field', {lit(f)}, 'raw_value', {f}, 'kind', {k})"
        for f, k in zip(FIELDS, kinds)
    )
    rows = hits.selectExpr(*_READING, f"inline(array({fields}))")
    return rows.filter("kind IS NOT NULL")


def _issue_type(rules: ScanRules) -> str:
    """Issue of one raw value, first match wins; null for none."""
    by_unit = " ".join(
        f"WHEN unit_of_measurement = {lit(u)} AND (raw_value < {lit(low)}"
        + (f" OR raw_value > {lit(high)}" if high is not None else "")
        + f") THEN {lit(name)}"
        for u, (name, low, high) in rules.unit_checks.items()
    )
    return (
        "CASE WHEN isnan(raw_value) THEN 'NaN'"
        f" WHEN {is_infinite('raw_value')} THEN 'Infinite'"
        f" WHEN raw_value IN ({lit(RULES.sentinel_low)}, {lit(RULES.sentinel_high)}) THEN 'Error'"
        f" {by_unit} END"
    )


def raw_issues(matched_raw: DataFrame, rules: ScanRules = SCAN_RULES) -> DataFrame:
    """Issues of the raw scan, one row per field concerned. It looks at the readings as stored,
    without de-duplication or repair."""
    return _fields_as_rows(matched_raw, _issue_type(rules)).withColumnRenamed("kind", "issue_type")


def unusual_values(matched_raw: DataFrame, rules: ScanRules = SCAN_RULES) -> DataFrame:
    """Large values of entities whose unit does not explain them. NaN is not large; a missing
    unit explains nothing."""
    exempt = one_of("coalesce(unit_of_measurement, '')", rules.unusual_exempt_units)
    kind = (
        f"CASE WHEN NOT isnan(raw_value) AND abs(raw_value) > {lit(rules.unusual_above)}"
        f" AND NOT ({exempt}) THEN true END"
    )
    return _fields_as_rows(matched_raw, kind).drop("kind")


def scan_overview(matched_raw: DataFrame, rules: ScanRules = SCAN_RULES) -> DataFrame:
    """Per table: readings looked at, entities with issues, issues. One pass, in two levels so
    that a table is already one row per entity when it is brought together."""
    kind = _issue_type(rules)
    hits = total(f"(({kind.replace('raw_value', f)}) IS NOT NULL)" for f in FIELDS)
    per_entity = (
        matched_raw.filter("matched")
        .selectExpr("table_rank", "statistic_id", f"{hits} AS hits")
        .groupBy("table_rank", "statistic_id")
        .agg(F.count("*").alias("n"), F.sum("hits").alias("hits"))
    )
    return per_entity.groupBy("table_rank").agg(
        F.sum("n").alias("n_readings"),
        F.expr("count_if(hits > 0)").alias("n_entities"),
        F.sum("hits").alias("n_issues"),
    )


def worst_entities(issue_rows: DataFrame, n: int = 5) -> DataFrame:
    """The n entities with the most raw issues in each table."""
    place = (
        "row_number() OVER (PARTITION BY table_rank ORDER BY n_issues DESC, statistic_id) AS place"
    )
    return (
        issue_rows.groupBy("table_rank", "statistic_id", "unit_of_measurement")
        .agg(F.count("*").alias("n_issues"))
        .selectExpr("*", place)
        .filter(f"place <= {n}")
    )


def worst_examples(issue_rows: DataFrame, n: int = 5, examples: int = 3) -> DataFrame:
    """The first issues of each of the worst entities, by time and then field order.

    Counts and examples come from one pass over the issues: per (entity, day) their number and
    the first of them, then the same per entity over these few rows, so the days of an entity with
    very many issues are spread over tasks."""
    fields = ", ".join(lit(f) for f in FIELDS)
    order = f"ORDER BY start_ts, id, array_position(array({fields}), field)"
    entity = "PARTITION BY table_rank, statistic_id"
    days = issue_rows.selectExpr("*", "to_date(start_ts) AS day").selectExpr(
        "*",
        f"row_number() OVER ({entity}, day {order}) AS place_in_day",
        f"count(*) OVER ({entity}, day) AS n_in_day",
    )
    first = days.filter(f"place_in_day <= {examples}").selectExpr(
        "*",
        f"row_number() OVER ({entity} {order}) AS position",
        f"sum(CASE WHEN place_in_day = 1 THEN n_in_day END) OVER ({entity}) AS n_issues",
    )
    # An entity keeps few rows here, and those of the first n are found before they are dealt.
    rank = "dense_rank() OVER (PARTITION BY table_rank ORDER BY n_issues DESC, statistic_id) AS place"
    worst = first.filter(f"position <= {examples}").selectExpr("*", rank).filter(f"place <= {n}")
    return worst.select(*issue_rows.columns, "position")


def reading_sample(readings: DataFrame, n: int | None = None) -> DataFrame:
    """The readings that a report looks at: all of them, or the first n by entity and time."""
    if n is None:
        return readings
    return readings.orderBy("metadata_id", "start_ts", "table_rank", "id").limit(n)
