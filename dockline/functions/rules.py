"""Quality rules as Column builders (F1, F2, F2s, F3, F4, F8).

Every predicate is a native Column, so it is evaluated inside whole-stage
codegen and pushed as far down as Catalyst allows. ``valid`` columns are
wrapped in ``coalesce(..., false)`` so NULL never means "keep".
"""
from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .. import settings as S
from . import timefn as T


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def _first_failure(cases: list[tuple[Column, str]]) -> Column:
    """``when`` chain returning the label of the first failing rule, NULL if
    all pass. ``cases`` are (failure condition, label) in rule order."""
    expr = None
    for cond, label in cases:
        expr = F.when(cond, F.lit(label)) if expr is None else expr.when(cond, F.lit(label))
    return expr


# ---- F1: station rule -----------------------------------------------------
def station_reject_reason(station_id="station_id", capacity="capacity",
                          latitude="latitude", longitude="longitude") -> Column:
    sid, cap, lat, lon = map(_c, (station_id, capacity, latitude, longitude))
    return _first_failure([
        (sid.isNull(), "missing_station_id"),
        (cap.isNull(), "missing_capacity"),
        (cap < 0, "negative_capacity"),
        (lat.isNull(), "missing_latitude"),
        (~lat.between(*S.LAT_RANGE), "latitude_out_of_box"),
        (lon.isNull(), "missing_longitude"),
        (~lon.between(*S.LON_RANGE), "longitude_out_of_box"),
    ])


def station_valid(**cols) -> Column:
    return station_reject_reason(**cols).isNull()


# ---- F2 / F2s: reading rule -----------------------------------------------
def reading_reject_reason(strict: bool = False, station_id="station_id",
                          bikes="num_bikes_available", docks="num_docks_available",
                          observed_at="observed_at", capacity="capacity") -> Column:
    """Default: unknown capacity skips the coherence check (tested rule).
    ``strict``: unknown capacity rejects (the filter the reference executes)."""
    sid, b, d, ts, cap = map(_c, (station_id, bikes, docks, observed_at, capacity))
    cases = [
        (sid.isNull(), "missing_station_id"),
        (b.isNull(), "missing_bikes"),
        (b < 0, "negative_bikes"),
        (d.isNull(), "missing_docks"),
        (d < 0, "negative_docks"),
        (ts.isNull(), "missing_observed_at"),
    ]
    if strict:
        cases.append((cap.isNull(), "unknown_capacity"))
    cases.append((cap.isNotNull() & ((b + d) > (cap + S.CAPACITY_TOLERANCE)), "over_capacity"))
    return _first_failure(cases)


def reading_valid(strict: bool = False, **cols) -> Column:
    return reading_reject_reason(strict=strict, **cols).isNull()


# ---- F4: functional audit -------------------------------------------------
def capacity_incoherent(bikes="num_bikes_available", docks="num_docks_available",
                        capacity="capacity") -> Column:
    b, d, cap = map(_c, (bikes, docks, capacity))
    return F.coalesce((b + d) > (cap + S.AUDIT_CAPACITY_TOLERANCE), F.lit(False))


# ---- F8: relational constraints as predicates -----------------------------
def _len_over(c: Column, n: int) -> Column:
    return c.isNotNull() & (F.length(c) > n)


def _int4_bad(c: Column) -> Column:
    return c.isNotNull() & ((c < 0) | (c > S.INT4_MAX))


def station_row_violation(station_id="station_id", name="name", latitude="latitude",
                          longitude="longitude", capacity="capacity", commune="commune") -> Column:
    """First violated constraint of the ``stations`` table, NULL if none."""
    sid, nm, lat, lon, cap, com = map(_c, (station_id, name, latitude, longitude, capacity, commune))
    return _first_failure([
        (sid.isNull(), "station_id_null"),
        (_len_over(sid, S.MAX_LEN_STATION_ID), "station_id_too_long"),
        (nm.isNull(), "name_null"),
        (_len_over(nm, S.MAX_LEN_NAME), "name_too_long"),
        (lat.isNull(), "latitude_null"),
        (lon.isNull(), "longitude_null"),
        (cap.isNull(), "capacity_null"),
        (_int4_bad(cap), "capacity_out_of_range"),
        (_len_over(com, S.MAX_LEN_COMMUNE), "commune_too_long"),
    ])


def reading_row_violation(station_id="station_id", bikes="num_bikes_available",
                          ebikes="num_ebikes_available", docks="num_docks_available",
                          is_renting="is_renting", is_returning="is_returning",
                          observed_at="observed_at", batch_id="batch_id") -> Column:
    """First violated constraint of the ``disponibilite_releve`` table."""
    sid, b, e, d, r1, r2, ts, bid = map(_c, (station_id, bikes, ebikes, docks, is_renting,
                                            is_returning, observed_at, batch_id))
    return _first_failure([
        (sid.isNull(), "station_id_null"),
        (_len_over(sid, S.MAX_LEN_STATION_ID), "station_id_too_long"),
        (b.isNull(), "bikes_null"),
        (_int4_bad(b), "bikes_out_of_range"),
        (e.isNull(), "ebikes_null"),
        (_int4_bad(e), "ebikes_out_of_range"),
        (d.isNull(), "docks_null"),
        (_int4_bad(d), "docks_out_of_range"),
        (r1.isNull(), "is_renting_null"),
        (r2.isNull(), "is_returning_null"),
        (ts.isNull(), "observed_at_null"),
        (bid.isNull(), "batch_id_null"),
        (_len_over(bid, S.MAX_LEN_BATCH_ID), "batch_id_too_long"),
    ])


def alert_row_violation(alert_type="alert_type", severity="severity", description="description") -> Column:
    """First violated constraint of the ``pipeline_alertes`` table."""
    t, sev, desc = map(_c, (alert_type, severity, description))
    return _first_failure([
        (t.isNull(), "alert_type_null"),
        (_len_over(t, S.MAX_LEN_ALERT_TYPE), "alert_type_too_long"),
        (sev.isNull() | ~sev.isin(*S.SEVERITIES), "severity_not_allowed"),
        (desc.isNull(), "description_null"),
    ])


# ---- F1 / F2 over one record of an envelope ---------------------------------
def record_station_valid(r: Column) -> Column:
    geo = r["coordonnees_geo"]
    return station_valid(station_id=r["stationcode"], capacity=r["capacity"], latitude=geo["lat"], longitude=geo["lon"])


def record_observed_at(r: Column) -> Column:
    return T.to_ntz(T.parse_instant(r["duedate"]))


def record_reading_valid(r: Column) -> Column:
    return reading_valid(station_id=r["stationcode"], bikes=r["numbikesavailable"], docks=r["numdocksavailable"],
                         observed_at=record_observed_at(r), capacity=r["capacity"])
