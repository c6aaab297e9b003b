"""Projection of the shared test tables onto the seven domain tables.

Every column is integer arithmetic on a key, so the same expression text gives the same value in
any SQL engine and at any scale.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

AS_OF = "2001-08-01"
AS_OF_TS = "2001-08-01 18:00:00"

# L-shaped zone outline, offsets in degrees from the zone's south-west corner.
ZONE_OUTLINE = [
    ("0e0", "0e0"),
    ("3.8e-2", "0e0"),
    ("3.8e-2", "2.8e-2"),
    ("1.9e-2", "2.8e-2"),
    ("1.9e-2", "5.7e-2"),
    ("0e0", "5.7e-2"),
    ("0e0", "0e0"),
]

PHRASES = [
    "Danger near the school gate, cover is missing.",
    "Trip HAZARD beside the footpath after digging.",
    "Urgent repair wanted by the shop owners.",
    "Exposed wire seen at the base of the column.",
    "Small fire reported in the control box.",
    "Spark heard and seen when it rains.",
    "Column is leaning after a vehicle collision.",
    "Lamp will flicker all night long.",
    "Lamps blink during storm and heavy rain.",
    "Intermittent supply, voltage seems low.",
    "Lamp goes on and off every few minutes.",
    "Lamp stays dark, no visible damage.",
]
SUFFIXES = [" Seen in monsoon weather with water around.", " Seen in summer heat.", " Seen in winter fog."]


def _pick(values: list[str], index: str) -> str:
    return f"split_part('{'|'.join(values)}', '|', cast({index} + 1 as int))"


def _season_no(month: str) -> str:
    return f"(case when {month} between 6 and 9 then 0 when {month} between 3 and 5 then 1 else 2 end)"


_REPORTED = (
    "cast(o_orderdate as timestamp_ntz) + cast(k%24 as int)*interval '1' hour"
    " + cast((k*7)%60 as int)*interval '1' minute"
)
_STATUS = (
    "case when (k*37)%1000 < 850 then 'operational'"
    " when (k*37)%1000 < 950 then 'maintenance_required' else 'faulty' end"
)
_UPDATED = f"timestamp_ntz '{AS_OF_TS}' - cast((k*{{step}})%20000 as int)*interval '1' minute"
_RISK = (
    "cast(least(9.9e-1, (case s when 0 then 7e-1 when 1 then 5e-1 else 2e-1 end) + ((k*13)%21)/1e2"
    f" + (case when ({_STATUS}) = 'maintenance_required' then 1e-1 else 0e0 end)) as decimal(3,2))"
)
_LOAD = (
    "cast((case k%5 when 0 then 7.5e1 when 1 then 8.2e1 when 2 then 6.8e1 when 3 then 7.8e1 else 7.1e1 end)"
    " + ((k*7)%1001)/1e2 - 5e0 as decimal(5,2))"
)

# name -> (source table, key column, columns as (name, expression), row filter)
PROJECTIONS: dict[str, tuple[str, str, list[tuple[str, str]], str | None]] = {
    "lights": (
        "customer",
        "c_custkey",
        [
            ("light_id", "k"),
            ("lon", "cast(7.75e1 + ((k*7919)%200000)/1e6 as double)"),
            ("lat", "cast(1.28e1 + ((k*104729)%300000)/1e6 as double)"),
            ("status", _STATUS),
            ("wattage", "cast(100+50*(k%4) as int)"),
            ("installation_date", f"date '{AS_OF}' - cast(365+(k*97)%3286 as int)"),
            (
                "last_maintenance",
                f"cast(date '{AS_OF}' - cast(30+(k*53)%335 as int) as timestamp_ntz) + interval '12' hour",
            ),
            ("neighborhood_id", "cast(case when k%97=0 then null else c_nationkey end as int)"),
            ("created_at", f"cast(date '{AS_OF}' - cast(365+(k*97)%3286 as int) as timestamp_ntz)"),
            (
                "updated_at",
                f"cast(date '{AS_OF}' - cast(30+(k*53)%335 as int) as timestamp_ntz) + interval '12' hour",
            ),
            ("_deleted", "k%83=7"),
            ("_updated_at", _UPDATED.format(step=41)),
        ],
        None,
    ),
    "zones": (
        "nation",
        "n_nationkey",
        [
            ("neighborhood_id", "cast(k as int)"),
            ("name", "case when k=24 then 'NATION_6' else n_name end"),
            ("population", "cast(50000+(k*60013)%150001 as int)"),
            ("x0", "cast(7.75e1 + 4e-2*(k%5) as double)"),
            ("y0", "cast(1.28e1 + 6e-2*floor(k/5) as double)"),
            ("created_at", f"timestamp_ntz '{AS_OF} 00:00:00'"),
            ("_deleted", "k=13"),
            ("_updated_at", _UPDATED.format(step=4001)),
        ],
        None,
    ),
    "demographics": (
        "nation",
        "n_nationkey",
        [
            ("neighborhood_id", "cast(k as int)"),
            ("population_density", "cast(3000+(k*7919)%25000 as int)"),
            (
                "urban_classification",
                "case when 3000+(k*7919)%25000 > 15000 then 'urban'"
                " when 3000+(k*7919)%25000 > 5000 then 'suburban' else 'rural' end",
            ),
            ("created_at", f"timestamp_ntz '{AS_OF} 00:00:00'"),
            ("_deleted", "k=8"),
            ("_updated_at", _UPDATED.format(step=3001)),
        ],
        "k%12<>11",
    ),
    "suppliers": (
        "supplier",
        "s_suppkey",
        [
            ("supplier_id", "k"),
            ("name", "s_name"),
            ("lon", "cast(7.75e1 + ((k*15485863)%200000)/1e6 as double)"),
            ("lat", "cast(1.28e1 + ((k*32452843)%300000)/1e6 as double)"),
            ("contact_phone", "concat('+91-80-', cast(20000000+(k*7919)%80000000 as string))"),
            (
                "service_radius_km",
                "cast(case k%5 when 0 then 5 when 1 then 8 when 2 then 10 when 3 then 12 else 15 end as int)",
            ),
            (
                "avg_response_hours",
                "cast(case k%6 when 0 then 2 when 1 then 3 when 2 then 4 when 3 then 5 when 4 then 6 else 8 end as int)",
            ),
            (
                "specialization",
                "case when k%10 < 4 then 'LED' when k%10 < 6 then 'Sodium Vapor' else 'All' end",
            ),
            ("created_at", f"timestamp_ntz '{AS_OF} 00:00:00'"),
            ("_deleted", "k%29=5"),
            ("_updated_at", _UPDATED.format(step=1009)),
        ],
        None,
    ),
    "requests": (
        "orders",
        "o_orderkey",
        [
            ("request_id", "k"),
            ("light_id", "o_custkey"),
            ("reported_at", _REPORTED),
            (
                "resolved_at",
                f"case when k%19=0 then null else {_REPORTED} + cast(24*(1+k%7)+(1+k%8) as int)*interval '1' hour"
                " + cast((k*11)%60 as int)*interval '1' minute end",
            ),
            (
                "issue_type",
                "case when (k*31)%10 < 5 then 'bulb_failure' when (k*31)%10 < 7 then 'wiring'"
                " when (k*31)%10 = 7 then 'pole_damage' when (k*31)%10 = 8 then 'power_supply'"
                " else 'sensor_failure' end",
            ),
            (
                "description",
                f"case when k%101=0 then null else concat({_pick(PHRASES, 'k%12')}, "
                f"{_pick(SUFFIXES, _season_no('month(o_orderdate)'))}) end",
            ),
            ("created_at", _REPORTED),
            ("_deleted", "k%71=3"),
            ("_updated_at", _UPDATED.format(step=17)),
        ],
        None,
    ),
    "weather": (
        "customer",
        "c_custkey",
        [
            ("light_id", "k"),
            ("season", "case s when 0 then 'monsoon' when 1 then 'summer' else 'winter' end"),
            (
                "avg_temperature_c",
                "cast((case s when 0 then 2.5e1 when 1 then 3.2e1 else 1.8e1 end) + ((k*11)%50)/1e1 as decimal(5,2))",
            ),
            (
                "rainfall_mm",
                "cast((case s when 0 then 1.5e2 when 1 then 1.5e1 else 5e0 end) + ((k*11)%50)/1e1 as decimal(6,2))",
            ),
            ("failure_risk_score", _RISK),
            (
                "predicted_failure_date",
                f"case when ({_STATUS}) = 'faulty' or {_RISK} <= 5e-1 then null"
                f" else date '{AS_OF}' + cast((k*17+29*s)%120 as int) end",
            ),
            ("created_at", f"timestamp_ntz '{AS_OF} 00:00:00'"),
            ("_deleted", "k%59=11"),
            ("_updated_at", _UPDATED.format(step=23)),
        ],
        None,
    ),
    "power_grid": (
        "customer",
        "c_custkey",
        [
            ("light_id", "k"),
            (
                "grid_zone",
                "case k%5 when 0 then 'ZONE-A' when 1 then 'ZONE-B' when 2 then 'ZONE-C'"
                " when 3 then 'ZONE-D' else 'ZONE-E' end",
            ),
            ("avg_load_percent", _LOAD),
            (
                "outage_history_count",
                f"cast(case when {_LOAD} > 80 then 3+k%6 when {_LOAD} > 75 then 1+k%4 else k%3 end as int)",
            ),
            ("created_at", f"timestamp_ntz '{AS_OF} 00:00:00'"),
            ("_deleted", "k%61=2"),
            ("_updated_at", _UPDATED.format(step=31)),
        ],
        "k%211<>0",
    ),
    "feed": (
        "events",
        "event_id",
        [
            ("light_id", "user_id"),
            ("version", "k"),
            ("changed_at", "cast(ts as timestamp_ntz)"),
            ("op", "case event_type when 'view' then 'delete' when 'signup' then 'insert' else 'update' end"),
            (
                "status",
                "case event_type when 'error' then 'faulty' when 'click' then 'maintenance_required'"
                " when 'view' then null else 'operational' end",
            ),
        ],
        None,
    ),
}

def project(source: DataFrame, name: str) -> DataFrame:
    """Apply one projection to its source table (batch or streaming)."""
    _, key, columns, where = PROJECTIONS[name]
    df = source.withColumn("k", F.col(key).cast("bigint"))
    if where:
        df = df.where(where)
    if name == "weather":
        df = df.withColumn("s", F.explode(F.array(F.lit(0), F.lit(1), F.lit(2))))
    df = df.selectExpr(*[f"{expr} as {col}" for col, expr in columns])
    if name == "zones":
        ring = ", ".join(
            f"named_struct('lon', x0 + {dx}, 'lat', y0 + {dy})" for dx, dy in ZONE_OUTLINE
        )
        df = df.withColumn("ring", F.expr(f"array({ring})")).drop("x0", "y0")
    return df


@dataclass(frozen=True)
class Tables:
    """The domain tables of one data folder. Each is a lazy scan; unused columns are pruned."""

    spark: SparkSession
    path: str

    def raw(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.path.rstrip('/')}/{name}.parquet")

    def _domain(self, name: str) -> DataFrame:
        return project(self.raw(PROJECTIONS[name][0]), name)

    @cached_property
    def lights(self) -> DataFrame:
        return self._domain("lights")

    @cached_property
    def zones(self) -> DataFrame:
        return self._domain("zones")

    @cached_property
    def demographics(self) -> DataFrame:
        return self._domain("demographics")

    @cached_property
    def suppliers(self) -> DataFrame:
        return self._domain("suppliers")

    @cached_property
    def requests(self) -> DataFrame:
        return self._domain("requests")

    @cached_property
    def weather(self) -> DataFrame:
        return self._domain("weather")

    @cached_property
    def power_grid(self) -> DataFrame:
        return self._domain("power_grid")

    @cached_property
    def feed(self) -> DataFrame:
        return self._domain("feed")


DOMAIN_TABLES = ["zones", "lights", "requests", "suppliers", "weather", "demographics", "power_grid"]


def scan_tables(spark: SparkSession, path: str) -> Tables:
    return Tables(spark, path)
