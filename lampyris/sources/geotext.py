"""Geometry columns that arrive as text: WKT or hex EWKB. Pure column expressions, NULL on bad input."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_NUM = r"[-+]?[0-9]*\.?[0-9]+(?:[eE][-+]?[0-9]+)?"
_POINT = rf"(?i)^\s*POINT\s*\(\s*({_NUM})\s+({_NUM})\s*\)\s*$"
_POLYGON = rf"(?i)^\s*POLYGON\s*\(\(\s*((?:{_NUM}\s+{_NUM}\s*,\s*)+{_NUM}\s+{_NUM})\s*\)\)\s*$"
_POINT_TYPE, _POLYGON_TYPE, _SRID_FLAG = 1, 3, 0x20000000


def _double(text: Column) -> Column:
    return text.try_cast("double")


def point_from_wkt(text: Column) -> Column:
    """``POINT (lon lat)`` -> struct(lon, lat)."""
    lon = _double(F.regexp_extract(text, _POINT, 1))
    lat = _double(F.regexp_extract(text, _POINT, 2))
    return F.when(lon.isNotNull() & lat.isNotNull(), F.struct(lon.alias("lon"), lat.alias("lat")))


def polygon_from_wkt(text: Column) -> Column:
    """``POLYGON ((lon lat, ...))`` -> array of struct(lon, lat)."""
    body = F.regexp_extract(text, _POLYGON, 1)
    ring = F.transform(
        F.split(body, r"\s*,\s*"),
        lambda pair: F.struct(
            _double(F.split(F.trim(pair), r"\s+")[0]).alias("lon"), _double(F.split(F.trim(pair), r"\s+")[1]).alias("lat")
        ),
    )
    return F.when(body != "", ring)


def _le_hex_to_bigint(text: Column, size: int) -> Column:
    """Little-endian hex of ``size`` bytes (at most 7 significant) as BIGINT."""
    flipped = F.concat(*[F.substring(text, 2 * i + 1, 2) for i in reversed(range(size))])
    return F.conv(flipped, 16, 10).cast("bigint")


def _le_hex_to_double(text: Column) -> Column:
    """Little-endian IEEE-754 double from 16 hex digits, assembled from its sign, exponent and mantissa."""
    flipped = F.concat(*[F.substring(text, 2 * i + 1, 2) for i in reversed(range(8))])
    head = F.conv(F.substring(flipped, 1, 3), 16, 10).cast("int")
    mantissa = F.conv(F.substring(flipped, 4, 13), 16, 10).cast("bigint").cast("double")
    sign = F.when(head >= 2048, F.lit(-1.0)).otherwise(F.lit(1.0))
    exponent = F.when(head >= 2048, head - 2048).otherwise(head)
    return F.when((exponent == 0) & (mantissa == 0), sign * 0.0).otherwise(
        sign * (mantissa + 4503599627370496.0) * F.pow(F.lit(2.0), (exponent - 1075).cast("double"))
    )


def _header(text: Column, kind: int) -> tuple[Column, Column]:
    """(is this geometry kind, 1-based position of the first digit after the header)."""
    code = _le_hex_to_bigint(F.substring(text, 3, 8), 4)
    has_srid = code.bitwiseAND(F.lit(_SRID_FLAG)) != 0
    is_kind = text.rlike("^(?:[0-9A-Fa-f]{2})+$") & text.startswith("01") & (code.bitwiseAND(F.lit(0xFF)) == kind)
    return is_kind, F.when(has_srid, F.lit(19)).otherwise(F.lit(11))


def _pair(text: Column, start: Column) -> Column:
    return F.struct(
        _le_hex_to_double(F.substr(text, start, F.lit(16))).alias("lon"),
        _le_hex_to_double(F.substr(text, start + 16, F.lit(16))).alias("lat"),
    )


def point_from_ewkb_hex(text: Column) -> Column:
    """Little-endian EWKB point in hex, with or without SRID -> struct(lon, lat)."""
    ok, start = _header(text, _POINT_TYPE)
    return F.when(ok & (F.length(text) == start + 31), _pair(text, start))


def polygon_from_ewkb_hex(text: Column) -> Column:
    """Little-endian EWKB polygon in hex; the outer ring -> array of struct(lon, lat)."""
    ok, start = _header(text, _POLYGON_TYPE)
    count = _le_hex_to_bigint(F.substr(text, start + 8, F.lit(8)), 4).cast("int")
    ring = F.transform(F.sequence(F.lit(0), count - 1), lambda i: _pair(text, start + 16 + i * 32))
    return F.when(ok & (count > 0) & (F.length(text) >= start + 15 + count * 32), ring)


def try_point(text: Column) -> Column:
    """Point from either notation, NULL when neither fits."""
    return F.coalesce(point_from_wkt(text), point_from_ewkb_hex(text))


def point_to_wkt(lon: Column, lat: Column) -> Column:
    return F.concat(F.lit("POINT ("), lon.cast("string"), F.lit(" "), lat.cast("string"), F.lit(")"))


def polygon_to_wkt(ring: Column) -> Column:
    pairs = F.transform(ring, lambda p: F.concat_ws(" ", p["lon"].cast("string"), p["lat"].cast("string")))
    return F.concat(F.lit("POLYGON (("), F.array_join(pairs, ", "), F.lit("))"))


def ring_to_text(ring: Column, digits: int = 6) -> Column:
    """Ring as ``lon lat;lon lat`` with fixed digits, for comparing and hashing."""
    return F.array_join(
        F.transform(
            ring,
            lambda p: F.concat_ws(
                " ", p["lon"].cast(f"decimal(18,{digits})").cast("string"), p["lat"].cast(f"decimal(18,{digits})").cast("string")
            ),
        ),
        ";",
    )
