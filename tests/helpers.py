import datetime as dt

from meteora.schemas import BRONZE

NOW = dt.datetime(2026, 1, 1)


def bronze_rows(spark, rows):
    """rows: dicts with any BRONZE fields; the rest default to NULL."""
    names = [f.name for f in BRONZE.fields]
    number = {f.name for f in BRONZE.fields if f.dataType.typeName() == "double"}
    data = [tuple(float(r[n]) if n in number and r.get(n) is not None else r.get(n) for n in names) for r in rows]
    return spark.createDataFrame(data, BRONZE)


def obs(city, time, temp, wind=10.0, code=0, country="C", ingested=NOW, seq=None, hum=50, precip=0.0):
    return dict(city=city, country=country, time=time, temperature_c=temp, wind_speed_kmh=wind,
                weather_code=code, ingested_at=ingested, ingest_seq=seq, humidity_pct=hum,
                precipitation_mm=precip)


def daily_rows(spark, rows):
    """rows: (city, country, date, avg_temp, wind, precip)."""
    schema = ("city string, country string, date timestamp_ntz, avg_temp_c double, min_temp_c double, "
              "max_temp_c double, avg_feels_like_c double, avg_humidity_pct double, "
              "avg_wind_speed_kmh double, total_precipitation_mm double")
    data = [(c, k, d, t, t, t, t, 50.0, w, p) for c, k, d, t, w, p in rows]
    return spark.createDataFrame(data, schema)
