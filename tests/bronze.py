"""Generate small landed trees for tests: two zones, three points each."""

from __future__ import annotations

import datetime as dt
import json
import math

from tidewright.schemas import GRID_BRONZE, WEATHER_FIELDS, tide_bronze, weather_bronze

START = dt.datetime(2026, 1, 31, 9, 0)
ZONES = [("Z1", "First", "West", 9.4, -82.2), ("Z2", "Second", "East", 8.0, -79.7)]
POINTS = [(f"{z[0]}_{side}", z[0]) for z in ZONES for side in ("left", "right", "inner")]


def iso(moment):
    return moment.isoformat()


def _point_row(point, zone, run, feed, raw):
    return (point, zone, zone, "x", 1.0, 2.0, "r", "p", iso(run), "c", feed, raw)


def weather_rows(run, hours=49, points=POINTS, wave=lambda h: 1.0, wind=lambda h: 5.0):
    out = []
    for point, zone in points:
        reply = []
        for h in range(hours):
            values = {name: (1.0,) for name in WEATHER_FIELDS}
            values.update(
                waveHeight=(wave(h),), windSpeed=(wind(h),), airTemperature=(25.0,), pressure=(1010.0,),
                cloudCover=(50.0,), visibility=(10.0,), precipitation=(float(h % 3),),
            )
            reply.append((iso(run + dt.timedelta(hours=h)), *[values[name] for name in WEATHER_FIELDS]))
        out.append(_point_row(point, zone, run, "stormglass", (reply,)))
    return out


def tide_rows(run, hours=49, points=POINTS):
    out = []
    for point, zone in points:
        heights, extremes = [], []
        for h in range(hours):
            moment = run + dt.timedelta(hours=h)
            stamp = int(moment.replace(tzinfo=dt.timezone.utc).timestamp())
            heights.append((stamp, iso(moment), math.sin(h * math.pi / 6), "RISING"))
            if h % 6 == 3:
                high = h % 12 == 3
                extremes.append((stamp, iso(moment), 1.0 if high else -1.0, "HIGH TIDE" if high else "LOW_TIDE"))
        out.append(_point_row(point, zone, run, "marea", (heights, extremes)))
    return out


def grid_rows(run, days=3, first_day=0, skip_zones=()):
    """Stacked single-variable rows per cell; the last cell lies over land."""
    out = []
    for zone, name, *_ in ZONES:
        if zone in skip_zones:
            continue
        for d in range(first_day, first_day + days):
            day = dt.datetime(run.year, run.month, run.day) + dt.timedelta(days=d)
            for cell in range(3):
                lat, lon = 9.0 + cell, -80.0
                land = cell == 2
                value = None if land else 20.0 + cell + d
                cur = None if land else 0.5
                out += [
                    (day, 0.5, lat, lon, value, None, None, None, zone, name, "forecast_temp", run),
                    (day, 0.5, lat, lon, None, None if land else 35.0, None, None, zone, name, "forecast_sal", run),
                    (day, 0.5, lat, lon, None, None, cur, cur, zone, name, "forecast_curr", run),
                ]
    return out


def landing_path(root, source, run, variant="forecast"):
    folder = f"{root}/{source}/year={run:%Y}/month={run:%m}/{variant}/day={run:%d}"
    return f"{folder}/{source}_{variant}_48h_{run:%Y%m%d_%H%M%S}.parquet"


def write_one_file(df, path):
    """A single parquet file at exactly this path."""
    import os

    import pyarrow.parquet as pq

    os.makedirs(os.path.dirname(path), exist_ok=True)
    table = df.toArrow()
    pq.write_table(table, path)


def land(spark, root, feed, run, rows=None, **kw):
    schema = {"stormglass": weather_bronze(), "marea": tide_bronze(), "copernicus": GRID_BRONZE}[feed]
    make = {"stormglass": weather_rows, "marea": tide_rows, "copernicus": grid_rows}[feed]
    path = landing_path(root, feed, run)
    write_one_file(spark.createDataFrame(rows if rows is not None else make(run, **kw), schema), path)
    return path


def config(path, points=POINTS):
    entries = [
        {"id": p, "zona_id": z, "zona_nombre": z, "tipo_punto": "interior", "lat": 1.0, "lng": 2.0,
         "provincias": "p", "region": "r"}
        for p, z in points
    ]
    entries[0]["activo"] = False
    entries[1]["activo"] = True
    with open(path, "w") as out:
        json.dump({"apis": {"x": 1}, "puntos_muestreo": entries}, out, indent=1)
