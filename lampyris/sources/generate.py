"""Data generators: repeatable pseudo-random columns from key hashes, any partitioning gives the same rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import geo, rules

# City box and centre, value choices and weights
LON_MIN, LON_MAX, LAT_MIN, LAT_MAX = 77.5, 77.7, 12.8, 13.1
CENTER_LON, CENTER_LAT = 77.5946, 12.9716
WATTAGES = [100, 150, 200, 250]
RADII = [5, 8, 10, 12, 15]
RESPONSES = [2, 3, 4, 5, 6, 8]
SEASON_SLOTS = {"monsoon": 30, "summer": 20, "winter": 10}
RESOLUTION_WEIGHTS = [10, 20, 30, 20, 10, 5, 5]
# season: temperature range, rainfall range, base risk range
SEASON_RANGES = {
    "monsoon": ((25, 30), (150, 250), (0.70, 0.90)),
    "summer": ((32, 38), (15, 40), (0.50, 0.70)),
    "winter": ((18, 25), (5, 20), (0.20, 0.40)),
}
ZONE_LOADS = {"ZONE-A": 75, "ZONE-B": 82, "ZONE-C": 68, "ZONE-D": 78, "ZONE-E": 71}
REPORTS = {
    "bulb_failure": ["Lamp is dark since last night.", "Lamp flickers and then goes out.", "Lamp is very dim."],
    "wiring": ["Exposed wire at the base, danger.", "Sparks from the joint box when it rains.", "Loose contact, light comes and goes."],
    "pole_damage": ["Column leaning after a vehicle collision.", "Rust at the foot of the column.", "Bracket is broken."],
    "power_supply": ["Whole row dark, no supply.", "Voltage keeps changing.", "Breaker trips every evening."],
    "sensor_failure": ["Light burns all day, sensor fault.", "Timer runs at the wrong hours.", "Controller does not answer."],
}
SEASON_NOTES = {
    "monsoon": ["Heavy rain before it happened.", "Street was under water.", ""],
    "summer": ["It was extremely hot.", "", ""],
    "winter": ["Fog in the morning.", "", ""],
}
_TRIES = (8, 100)
_CHUNK = 10000


def uniform(seed: int, tag: str, *keys: Column) -> Column:
    """Uniform [0, 1) from a key: the top 53 bits of a hash."""
    h = F.xxhash64(*keys, F.lit(tag), F.lit(seed))
    return F.shiftrightunsigned(h, 11).cast("double") / F.lit(9007199254740992.0)


def _between(u: Column, lo: float, hi: float) -> Column:
    return lo + u * (hi - lo)


def _int_between(u: Column, lo: int, hi: int) -> Column:
    return (F.lit(lo) + F.floor(u * (hi - lo + 1))).cast("int")


def _choice(u: Column, values: list) -> Column:
    return F.element_at(F.array(*[F.lit(v) for v in values]), (F.floor(u * len(values)) + 1).cast("int"))


def _clamp(c: Column, lo: float, hi: float) -> Column:
    return F.least(F.greatest(c, F.lit(lo)), F.lit(hi))


def _spread(df: DataFrame, count: Column, out: str) -> DataFrame:
    """Repeat each row ``count`` times with ``out`` = 1..count.

    Large counts are cut into chunks that are shuffled first, so one big row does not explode in one task.
    """
    chunks = df.withColumn("_count", count).withColumn(
        "_chunk", F.explode(F.sequence(F.lit(0), F.greatest(F.ceil(F.col("_count") / _CHUNK) - 1, F.lit(0))))
    )
    last = F.least(F.col("_count"), (F.col("_chunk") + 1) * _CHUNK)
    return (
        chunks.repartition("_chunk", *df.columns[:1])
        .withColumn(out, F.explode(F.sequence(F.col("_chunk") * _CHUNK + 1, last)))
        .drop("_chunk", "_count")
    )


def gen_neighborhoods(index: DataFrame, seed: int = 42) -> DataFrame:
    """One zone per row of ``index`` (column ``i`` = 0..n-1) on a jittered square grid."""
    n = index.agg(F.count("*")).scalar()
    i = F.col("i")
    base = index.select("i").withColumn("g", F.floor(F.sqrt(n)) + 1)
    dlat, dlon = (LAT_MAX - LAT_MIN) / F.col("g"), (LON_MAX - LON_MIN) / F.col("g")
    placed = (
        base.withColumn("clat", LAT_MIN + (F.floor(i / F.col("g")) + 0.5 + _between(uniform(seed, "jy", i), -0.2, 0.2)) * dlat)
        .withColumn("clon", LON_MIN + (i % F.col("g") + 0.5 + _between(uniform(seed, "jx", i), -0.2, 0.2)) * dlon)
        .withColumn("size", dlat * 0.4)
        .withColumn("points", _int_between(uniform(seed, "np", i), 5, 8))
    )

    def vertex(v: Column) -> Column:
        radius = F.col("size") * _between(uniform(seed, "r", i, v), 0.7, 1.0)
        return F.struct(
            _clamp(F.col("clon") + radius * _between(uniform(seed, "vx", i, v), -1, 1), LON_MIN, LON_MAX).alias("lon"),
            _clamp(F.col("clat") + radius * _between(uniform(seed, "vy", i, v), -1, 1), LAT_MIN, LAT_MAX).alias("lat"),
        )

    open_ring = F.transform(F.sequence(F.lit(1), F.col("points")), vertex)
    return placed.withColumn("_open", open_ring).select(
        F.format_string("NH-%03d", i + 1).alias("neighborhood_id"),
        F.format_string("Neighborhood %d", i + 1).alias("name"),
        F.concat("_open", F.slice("_open", 1, 1)).alias("ring"),
        _int_between(uniform(seed, "pop", i), 50000, 200000).alias("population"),
    )


def gen_street_lights(zones: DataFrame, total: int, as_of: rules.AsOf = None, seed: int = 42) -> DataFrame:
    """``total`` lights shared out by population, at least one per zone, placed inside the zone's ring.

    Quotas and numbering need an order over zones only (one narrow row per zone); lights are made in parallel.
    """
    people = zones.agg(F.sum("population")).scalar()
    quota = zones.select("neighborhood_id", "population", "ring").withColumn(
        "quota", F.greatest(F.floor(F.lit(total) * F.col("population") / people), F.lit(1))
    )
    zone_count = F.count("*").over(Window.partitionBy())
    missing = F.greatest(F.lit(total) - F.sum("quota").over(Window.partitionBy()), F.lit(0))
    rank = F.row_number().over(Window.orderBy(F.desc("population"), "neighborhood_id"))
    extra = F.floor(missing / zone_count) + F.when(rank <= missing % zone_count, 1).otherwise(0)
    shares = quota.drop("ring", "population").join(quota.select("neighborhood_id", "population"), "neighborhood_id")
    numbered = shares.withColumn("n", F.col("quota") + extra).withColumn(
        "offset", F.sum("n").over(Window.orderBy("neighborhood_id").rowsBetween(Window.unboundedPreceding, -1))
    )
    lights = _spread(
        numbered.select("neighborhood_id", "n", F.coalesce("offset", F.lit(0)).alias("offset")), F.col("n"), "j"
    ).withColumn("light_no", F.col("offset") + F.col("j"))
    no = F.col("light_no")
    shapes = zones.select(
        "neighborhood_id", geo.ring_bbox(F.col("ring")).alias("b"), geo.ring_edges(F.col("ring")).alias("e"),
        geo.centroid(F.col("ring")).alias("c"),
    )

    def candidate(k: Column) -> Column:
        return F.struct(
            (F.col("b.min_lon") + uniform(seed, "x", no, k) * (F.col("b.max_lon") - F.col("b.min_lon"))).alias("lon"),
            (F.col("b.min_lat") + uniform(seed, "y", no, k) * (F.col("b.max_lat") - F.col("b.min_lat"))).alias("lat"),
        )

    def first_inside(tries: int) -> Column:
        inside = F.filter(
            F.transform(F.sequence(F.lit(1), F.lit(tries)), candidate), lambda p: geo.in_edges(p["lon"], p["lat"], F.col("e"))
        )
        return F.try_element_at(inside, F.lit(1))

    today = rules.as_of_date(as_of)
    age = _int_between(uniform(seed, "age", no), 365, 3650)
    slot = (no * 617 + seed) % 1000
    placed = lights.join(shapes, "neighborhood_id").withColumn("p", F.coalesce(*[first_inside(k) for k in _TRIES], F.col("c")))
    return placed.withColumn("_age", age).select(
        "light_no",
        F.format_string("SL-%04d", no).alias("light_id"),
        F.col("p.lon").alias("lon"),
        F.col("p.lat").alias("lat"),
        F.when(slot < 850, F.lit("operational")).when(slot < 950, F.lit("maintenance_required")).otherwise(F.lit("faulty")).alias("status"),
        _choice(uniform(seed, "w", no), WATTAGES).alias("wattage"),
        F.date_sub(today, F.col("_age")).alias("installation_date"),
        (
            F.date_sub(today, (F.lit(30) + F.floor(uniform(seed, "m", no) * (F.col("_age") - 29))).cast("int")).cast("timestamp_ntz")
            + F.expr("interval 12 hours")
        ).alias("last_maintenance"),
        "neighborhood_id",
    )


def gen_maintenance(lights: DataFrame, count: int = 1500, as_of: rules.AsOf = None, seed: int = 42) -> DataFrame:
    """A year of requests: days drawn without replacement from season-weighted slots.

    ``lights`` carries ``light_no`` = 1..n. The slots of a day grow with ``count``, so that there are always enough.
    """
    spark = lights.sparkSession
    today = rules.as_of_date(as_of)
    more = -(-count // (365 * min(SEASON_SLOTS.values())))
    days = spark.range(1).select(F.explode(F.sequence(F.date_sub(today, 365), F.date_sub(today, 1))).alias("d"))
    slots = days.withColumn("season", rules.season(F.col("d"))).withColumn(
        "slot", F.explode(F.sequence(F.lit(1), F.element_at(F.create_map(*[F.lit(x) for season, n in SEASON_SLOTS.items() for x in (season, n * more)]), F.col("season"))))
    )
    drawn = slots.orderBy(F.xxhash64("d", "slot", F.lit(seed)), "d", "slot").limit(count)
    no = F.row_number().over(Window.orderBy("d", "slot"))
    n_lights = lights.agg(F.max("light_no")).scalar()
    rows = drawn.withColumn("no", no)
    key = F.col("no")
    u = uniform(seed, "days", key) * sum(RESOLUTION_WEIGHTS)
    bound, repair = 0, F.lit(len(RESOLUTION_WEIGHTS))
    for day_count, weight in reversed(list(enumerate(RESOLUTION_WEIGHTS, start=1))):
        bound = sum(RESOLUTION_WEIGHTS[:day_count])
        repair = F.when(u < bound, F.lit(day_count)).otherwise(repair)
    issue_draw = uniform(seed, "issue", key) * 10
    issue = (
        F.when(issue_draw < 5, F.lit("bulb_failure")).when(issue_draw < 7, F.lit("wiring")).when(issue_draw < 8, F.lit("pole_damage"))
        .when(issue_draw < 9, F.lit("power_supply")).otherwise(F.lit("sensor_failure"))
    )

    def pick_text(table: dict[str, list[str]], by: Column, tag: str) -> Column:
        arrays = F.create_map(*[x for k, v in table.items() for x in (F.lit(k), F.array(*[F.lit(s) for s in v]))])
        options = F.element_at(arrays, by)
        return F.element_at(options, (F.floor(uniform(seed, tag, key) * F.size(options)) + 1).cast("int"))

    hours = repair * 24 + _int_between(uniform(seed, "h", key), 1, 8)
    reported = F.col("d").cast("timestamp_ntz")
    made = rows.select(
        "no", "d", "season",
        (F.floor(uniform(seed, "light", key) * n_lights) + 1).alias("light_no"),
        issue.alias("issue_type"),
        F.when(uniform(seed, "open", key) >= 0.05, hours).alias("_hours"),
    )
    return made.join(lights.select("light_no", "light_id"), "light_no").select(
        F.format_string("REQ-%04d", key).alias("request_id"),
        "light_id",
        reported.alias("reported_at"),
        (reported + F.make_dt_interval(hours=F.col("_hours"))).alias("resolved_at"),
        "issue_type",
        F.rtrim(
            F.concat_ws(" ", pick_text(REPORTS, F.col("issue_type"), "text"), pick_text(SEASON_NOTES, F.col("season"), "note"))
        ).alias("description"),
    )


def gen_suppliers(index: DataFrame, seed: int = 42) -> DataFrame:
    """One supplier per row of ``index``: 40% around the centre, the rest anywhere in the city box."""
    i = F.col("i")

    def gauss(tag: str) -> Column:
        # Box-Muller
        return F.sqrt(-2 * F.log(1 - uniform(seed, tag + "a", i))) * F.cos(2 * F.pi() * uniform(seed, tag + "b", i))

    central = uniform(seed, "central", i) < 0.4
    lon = F.when(central, CENTER_LON + 0.05 * gauss("gx")).otherwise(_between(uniform(seed, "ux", i), LON_MIN, LON_MAX))
    lat = F.when(central, CENTER_LAT + 0.05 * gauss("gy")).otherwise(_between(uniform(seed, "uy", i), LAT_MIN, LAT_MAX))
    spec = uniform(seed, "spec", i) * 10
    return index.select(
        F.format_string("SUP-%03d", i + 1).alias("supplier_id"),
        F.format_string("Supplier %d", i + 1).alias("name"),
        _clamp(lon, LON_MIN, LON_MAX).alias("lon"),
        _clamp(lat, LAT_MIN, LAT_MAX).alias("lat"),
        F.format_string("+91-80-%d", _int_between(uniform(seed, "tel", i), 20000000, 99999999)).alias("contact_phone"),
        _choice(uniform(seed, "radius", i), RADII).alias("service_radius_km"),
        _choice(uniform(seed, "resp", i), RESPONSES).alias("avg_response_hours"),
        F.when(spec < 4, F.lit("LED")).when(spec < 6, F.lit("Sodium Vapor")).otherwise(F.lit("All")).alias("specialization"),
    )


def gen_weather(lights: DataFrame, as_of: rules.AsOf = None, seed: int = 42) -> DataFrame:
    """Three seasons per light; risk grows with age and with pending maintenance."""
    today = rules.as_of_date(as_of)
    seasons = F.array(
        *[
            F.struct(
                F.lit(s).alias("season"),
                *[F.lit(float(x)).alias(n) for x, n in zip((*temp, *rain, *risk), ("t0", "t1", "r0", "r1", "k0", "k1"))],
            )
            for s, (temp, rain, risk) in SEASON_RANGES.items()
        ]
    )
    rows = lights.select("light_id", "status", "installation_date", F.inline(seasons))

    def draw(tag: str, lo: str, hi: str) -> Column:
        return F.col(lo) + uniform(seed, tag, F.col("light_id"), F.col("season")) * (F.col(hi) - F.col(lo))

    age = F.least(F.lit(0.15), F.datediff(today, "installation_date") / F.lit(365.0 * 30))
    pending = F.when(F.col("status") == "maintenance_required", 0.10).otherwise(0.0)
    risk = F.least(F.lit(0.99), draw("risk", "k0", "k1") + age + pending).cast("decimal(3,2)")
    lead = F.floor((7 + uniform(seed, "lead", F.col("light_id"), F.col("season")) * 173) * (1 - F.col("failure_risk_score").cast("double")))
    return (
        rows.withColumn("failure_risk_score", risk)
        .select(
            "light_id",
            "season",
            draw("temp", "t0", "t1").cast("decimal(5,2)").alias("avg_temperature_c"),
            draw("rain", "r0", "r1").cast("decimal(6,2)").alias("rainfall_mm"),
            "failure_risk_score",
            F.when(
                (F.col("status") != "faulty") & (F.col("failure_risk_score") > 0.5), F.date_add(today, lead.cast("int"))
            ).alias("predicted_failure_date"),
        )
    )


def gen_demographics(zones: DataFrame, seed: int = 42) -> DataFrame:
    area = _between(uniform(seed, "area", F.col("neighborhood_id")), 2, 10)
    return zones.select("neighborhood_id", F.floor(F.col("population") / area).cast("int").alias("population_density")).withColumn(
        "urban_classification", rules.urban_class(F.col("population_density"))
    )


def gen_power_grid(lights: DataFrame, seed: int = 42) -> DataFrame:
    """Grid zone by light number, load around the zone's base, outages by load band."""
    names = list(ZONE_LOADS)
    key = F.col("light_id")
    zone = F.element_at(F.array(*[F.lit(z) for z in names]), (F.col("light_no") % len(names) + 1).cast("int"))
    base = F.element_at(F.create_map(*[F.lit(x) for kv in ZONE_LOADS.items() for x in kv]), F.col("grid_zone"))
    load = (base + _between(uniform(seed, "load", key), -5, 5)).cast("decimal(5,2)")
    u = uniform(seed, "outage", key)
    outages = (
        F.when(F.col("avg_load_percent") > 80, _int_between(u, 3, 8))
        .when(F.col("avg_load_percent") > 75, _int_between(u, 1, 4))
        .otherwise(_int_between(u, 0, 2))
    )
    return (
        lights.select("light_id", zone.alias("grid_zone"))
        .withColumn("avg_load_percent", load)
        .withColumn("outage_history_count", outages)
    )


def gen_summary(lights: DataFrame, requests: DataFrame, power_grid: DataFrame, demographics: DataFrame) -> DataFrame:
    """Row counts by status, issue type, season, grid zone and urban class."""

    def counts(df: DataFrame, label: str, column: Column) -> DataFrame:
        return df.groupBy(column.alias("value")).agg(F.count("*").alias("rows")).select(F.lit(label).alias("attribute"), "value", "rows")

    return (
        counts(lights, "status", F.col("status"))
        .unionByName(counts(requests, "issue_type", F.col("issue_type")))
        .unionByName(counts(requests, "season", rules.season(F.to_date("reported_at"))))
        .unionByName(counts(power_grid, "grid_zone", F.col("grid_zone")))
        .unionByName(counts(demographics, "urban_classification", F.col("urban_classification")))
    )
