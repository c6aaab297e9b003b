"""A small metric layer: declared tables, relationships and synonyms, and aggregates over them."""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..sources.fixtures import Tables
from .changes import live_rows


@dataclass(frozen=True)
class LogicalTable:
    source: str
    key: tuple[str, ...]
    dimensions: dict[str, list[str]]
    facts: dict[str, list[str]] = field(default_factory=dict)
    times: dict[str, list[str]] = field(default_factory=dict)

    def columns(self) -> dict[str, tuple[str, list[str]]]:
        out = {c: ("dimension", s) for c, s in self.dimensions.items()}
        out.update({c: ("time", s) for c, s in self.times.items()})
        out.update({c: ("fact", s) for c, s in self.facts.items()})
        return out


# Business names of the columns
MODEL: dict[str, LogicalTable] = {
    "street_lights": LogicalTable(
        "lights",
        ("light_id",),
        {
            "_deleted": ["deleted_flag", "is_deleted", "removed"],
            "light_id": ["asset_id", "fixture_id", "lamp_id", "light_identifier", "pole_id"],
            "location": ["coordinates", "geo_point", "gps_location", "position"],
            "neighborhood_id": ["area_id", "district_id", "locality_id", "zone_id"],
            "status": ["condition", "light_status", "operational_status", "state", "working_status"],
        },
        {"wattage": ["energy_usage", "power", "power_consumption", "power_rating", "watts"]},
        {
            "installation_date": ["commissioned_date", "deployment_date", "install_date", "setup_date"],
            "last_maintenance": ["last_inspection", "last_repair", "last_service", "maintenance_date"],
        },
    ),
    "maintenance_requests": LogicalTable(
        "requests",
        ("request_id",),
        {
            "_deleted": [],
            "request_id": ["case_id", "incident_id", "issue_id", "ticket_id", "work_order_id"],
            "light_id": ["asset_id", "fixture_id", "lamp_id"],
            "issue_type": ["defect_type", "failure_type", "fault_type", "issue_category", "problem_category", "problem_type"],
        },
        {},
        {
            "reported_at": ["created_at", "opened_at", "report_date", "reported_date", "submission_date"],
            "resolved_at": ["closed_at", "completed_at", "fixed_at", "repair_date", "resolution_date"],
        },
    ),
    "neighborhoods": LogicalTable(
        "zones",
        ("neighborhood_id",),
        {
            "_deleted": [],
            "boundary": ["area_boundary", "geographic_boundary", "polygon"],
            "neighborhood_id": ["area_id", "district_id", "locality_id", "zone_id"],
            "name": ["area_name", "district_name", "locality_name", "neighborhood_name"],
        },
        {"population": ["inhabitants", "people", "population_count", "residents"]},
    ),
    "suppliers": LogicalTable(
        "suppliers",
        ("supplier_id",),
        {
            "_deleted": [],
            "location": ["coordinates", "office_location", "position"],
            "supplier_id": ["company_id", "contractor_id", "vendor_id"],
            "name": ["company_name", "contractor_name", "supplier_name", "vendor_name"],
            "specialization": ["equipment_type", "expertise", "focus_area", "specialty"],
            "contact_phone": ["contact", "phone", "phone_number", "telephone"],
        },
        {
            "avg_response_hours": ["average_response", "response_time", "sla_hours", "turnaround_time"],
            "service_radius_km": ["coverage_distance", "coverage_radius", "service_area"],
        },
    ),
    "weather_enrichment": LogicalTable(
        "weather",
        ("light_id", "season"),
        {"_deleted": [], "light_id": ["fixture_id", "lamp_id"], "season": ["seasonal_period", "time_of_year", "weather_season"]},
        {
            "avg_temperature_c": ["average_temperature", "avg_temp", "temperature"],
            "failure_risk_score": ["failure_likelihood", "failure_probability", "risk_level", "risk_score"],
            "rainfall_mm": ["average_rainfall", "precipitation", "rain"],
        },
        {"predicted_failure_date": ["expected_failure", "failure_prediction", "predicted_outage"]},
    ),
    "demographics_enrichment": LogicalTable(
        "demographics",
        ("neighborhood_id",),
        {
            "_deleted": [],
            "neighborhood_id": ["area_id", "district_id", "zone_id"],
            "urban_classification": ["area_type", "development_level", "urbanization", "zone_type"],
        },
        {"population_density": ["density", "people_per_sqkm", "residents_per_area"]},
    ),
    "power_grid_enrichment": LogicalTable(
        "power_grid",
        ("light_id",),
        {"_deleted": [], "light_id": ["fixture_id", "lamp_id"], "grid_zone": ["electrical_zone", "grid_area", "power_zone", "supply_zone"]},
        {
            "avg_load_percent": ["capacity_usage", "grid_load", "load_percentage", "power_load"],
            "outage_history_count": ["blackouts", "outage_count", "outages", "power_outages"],
        },
    ),
}

# Columns that the stored tables have in another form: geometries as WKT text
_POINT = "concat('POINT(', cast(lon as string), ' ', cast(lat as string), ')')"
COMPUTED = {
    ("street_lights", "location"): _POINT,
    ("suppliers", "location"): _POINT,
    ("neighborhoods", "boundary"): "concat('POLYGON((', array_join(transform(ring, p -> concat(cast(p.lon as string), ' ', cast(p.lat as string))), ', '), '))')",
}

# (many side, column, one side)
RELATIONSHIPS = [
    ("street_lights", "neighborhood_id", "neighborhoods"),
    ("maintenance_requests", "light_id", "street_lights"),
    ("weather_enrichment", "light_id", "street_lights"),
    ("demographics_enrichment", "neighborhood_id", "neighborhoods"),
    ("power_grid_enrichment", "light_id", "street_lights"),
]

GRAINS = ("day", "week", "month", "quarter", "year")
_AGGREGATES = ("count", "count_distinct", "sum", "avg", "min", "max")


def resolve(name: str, prefer: str | None = None) -> tuple[str, str]:
    """(table, column) of a business name, optionally written ``table.name``.

    A name shared by several tables needs ``prefer`` or the table prefix.
    """
    table, _, column = name.rpartition(".")
    found = [
        (t, c)
        for t, spec in MODEL.items()
        for c, (_, synonyms) in spec.columns().items()
        if (not table or t == table) and (c == column or column in synonyms)
    ]
    if prefer and any(t == prefer for t, _ in found):
        found = [f for f in found if f[0] == prefer]
    exact = [f for f in found if f[1] == column]
    found = exact if len(exact) == 1 else found
    if len(found) != 1:
        raise ValueError(f"{name!r} matches {found or 'nothing'}")
    return found[0]


def _path(start: str, goal: str) -> list[tuple[str, str]]:
    """Many-to-one steps (column, table) from one table to another."""
    if start == goal:
        return []
    for many, column, one in RELATIONSHIPS:
        if many == start:
            try:
                return [(column, one), *_path(one, goal)]
            except ValueError:
                continue
    raise ValueError(f"no many-to-one path from {start} to {goal}")


def _rows(t: Tables, table: str, deleted: bool = False) -> DataFrame:
    """A logical table with all columns of the model; live rows only unless ``deleted``."""
    rows = getattr(t, MODEL[table].source)
    rows = rows if deleted else live_rows(rows)
    return rows.selectExpr("*", *[f"{text} as {name}" for (owner, name), text in COMPUTED.items() if owner == table])


def metric_query(
    t: Tables,
    fact_table: str,
    metrics: dict[str, tuple[str, str]],
    dimensions: list[str],
    where: dict[str, list] | None = None,
    deleted: bool = False,
) -> DataFrame:
    """Aggregate facts of one table by dimensions reachable over many-to-one relationships.

    A time column takes a grain, as in ``reported_at:month``; the output column is ``reported_at_month``, the first day
    of the period. ``metrics`` maps an output name to (aggregate, fact); ``("count", "*")`` counts rows. ``where`` keeps the
    listed values per dimension. Soft-deleted rows are left out on every table; facts whose reference is missing
    or deleted form a NULL group, so totals always cover all live facts (a filter on another table keeps only
    facts with a match). The fact rows are aggregated by their own dimensions and the first foreign key before
    any join, and merged after it; a counted-distinct fact joins those keys. ``deleted=True`` keeps soft-deleted
    rows of all tables, which the ``_deleted`` column then tells apart.
    """
    dims, grains = [], {}
    for name in dimensions:
        name, _, grain = name.partition(":")
        table, column = resolve(name, fact_table)
        if grain:
            if grain not in GRAINS or MODEL[table].columns()[column][0] != "time":
                raise ValueError(f"no {grain!r} of {table}.{column}")
            grains[table, f"{column}_{grain}"] = column, grain
            column = f"{column}_{grain}"
        dims.append((table, column))

    def rows_of(table: str) -> DataFrame:
        rows = _rows(t, table, deleted)
        for (owner, name), (column, grain) in grains.items():
            if owner == table:
                rows = rows.withColumn(name, F.to_date(F.date_trunc(grain, F.col(column))))
        return rows

    filters = [(resolve(d, fact_table), values) for d, values in (where or {}).items()]
    base = rows_of(fact_table)
    for (table, column), values in filters:
        if table == fact_table:
            base = base.where(F.col(column).isin(values))
    own = [c for table, c in dims if table == fact_table]
    remote = {table for table, _ in dims if table != fact_table} | {tb for (tb, _), _ in filters if tb != fact_table}
    paths = {table: _path(fact_table, table) for table in remote}
    first_keys = sorted({p[0][0] for p in paths.values()})

    parts: list[Column] = []
    for name, (agg, fact) in metrics.items():
        if agg not in _AGGREGATES:
            raise ValueError(f"unknown aggregate {agg}")
        value = F.lit(1) if fact == "*" else F.col(resolve(fact, fact_table)[1])
        if agg == "count_distinct":
            continue
        if agg == "avg":
            parts += [F.sum(value).alias(f"_s_{name}"), F.count(value).alias(f"_n_{name}")]
        else:
            parts.append(getattr(F, agg)(value).alias(f"_s_{name}"))
    apart = {name: resolve(fact, fact_table)[1] for name, (agg, fact) in metrics.items() if agg == "count_distinct"}
    kept = [F.col(c).alias(f"_d_{c}") for c in sorted(set(apart.values()))]
    partial = base.groupBy(*dict.fromkeys(own + first_keys), *kept).agg(*(parts or [F.count("*").alias("_rows")]))

    joined, done = partial, {fact_table}
    names = {(tb, c): (c if tb == fact_table else f"{tb}__{c}") for tb, c in dims}
    for path in sorted(paths.values(), key=len):
        here = fact_table
        for column, table in path:
            if table not in done:
                right = rows_of(table)
                for (tb, c), values in filters:
                    if tb == table:
                        right = right.where(F.col(c).isin(values))
                wanted = {c for tb, c in dims if tb == table} | {c for m, c, o in RELATIONSHIPS if m == table}
                key = MODEL[table].key[0]
                right = right.select(
                    F.col(key).alias("_k"), *[F.col(c).alias(f"{table}__{c}") for c in sorted(wanted)]
                )
                left_key = column if here == fact_table else f"{here}__{column}"
                filtered = any(tb == table for (tb, _), _ in filters)
                joined = joined.join(right, F.col(left_key) == F.col("_k"), "inner" if filtered else "left").drop("_k")
                done.add(table)
            here = table

    merged: list[Column] = []
    for name, (agg, _) in metrics.items():
        part = F.col(f"_s_{name}")
        if agg == "count_distinct":
            merged.append(F.count_distinct(F.col(f"_d_{apart[name]}")).alias(name))
        elif agg in ("count", "sum"):
            merged.append(F.sum(part).alias(name))
        elif agg == "avg":
            merged.append((F.sum(part).cast("double") / F.nullif(F.sum(f"_n_{name}"), F.lit(0))).alias(name))
        else:
            merged.append(getattr(F, agg)(part).alias(name))
    keys = [F.col(names[d]).alias(d[1] if [x[1] for x in dims].count(d[1]) == 1 else names[d]) for d in dims]
    return joined.groupBy(*keys).agg(*merged)


def facts_query(
    t: Tables, facts: dict[str, dict[str, tuple[str, str]]], dimensions: list[str], where: dict[str, list] | None = None, deleted: bool = False
) -> DataFrame:
    """Metrics of several fact tables by dimensions that all of them reach.

    Every fact is aggregated on its own to the shared groups (``metric_query``) before the results meet, so no fact
    multiplies another's rows. A group that a fact does not have counts 0 there, and its other metrics are null.
    Dimensions must mean the same column for every fact; metric names must differ.
    """
    names = [name for metrics in facts.values() for name in metrics]
    if len(set(names)) < len(names):
        raise ValueError("two metrics of one name")
    meant = {tuple(resolve(d.partition(":")[0], fact) for d in dimensions) for fact in facts}
    if len(meant) > 1:
        raise ValueError(f"{dimensions} mean different columns: {sorted(meant)}")
    single = []
    for fact, metrics in facts.items():
        one = metric_query(t, fact, metrics, dimensions, where, deleted)
        kept = [c for c in one.columns if c not in metrics]
        single.append(one.select(*kept, *metrics))
    shared = [c for c in single[0].columns if c not in names]
    every = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), single)
    counted = {name for metrics in facts.values() for name, (agg, _) in metrics.items() if agg in ("count", "count_distinct")}
    value = lambda n: F.coalesce(F.max(n), F.lit(0)) if n in counted else F.max(n)
    return every.groupBy(*shared).agg(*[value(n).alias(n) for n in names])


def synonym_rows() -> list[tuple[str, str, str, str]]:
    return [
        (word, table, column, kind)
        for table, spec in MODEL.items()
        for column, (kind, synonyms) in spec.columns().items()
        for word in [column, *synonyms]
    ]


def resolve_synonyms(t: Tables) -> DataFrame:
    """Every business name with its column and how many live rows carry a value there; one scan per table."""
    parts = []
    for table, spec in MODEL.items():
        counts = _rows(t, table).agg(*[F.count(c).alias(c) for c in spec.columns()])
        rows = [
            F.struct(
                F.lit(word).alias("business_name"), F.lit(table).alias("table_name"), F.lit(column).alias("column_name"),
                F.lit(kind).alias("kind"), F.col(column).alias("filled_rows"),
            )
            for word, owner, column, kind in synonym_rows()
            if owner == table
        ]
        parts.append(counts.select(F.inline(F.array(*rows))))
    return reduce(DataFrame.unionByName, parts)
