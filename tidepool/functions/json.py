"""Geocoding reply parsing: ``result{title, location{lng, lat}}``.

A reply that is not JSON, lacks ``result`` or lacks ``location`` yields the
default triple ``("", 0.0, 0.0)``, as the enrichment job does.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

GEOCODE_SCHEMA = T.StructType([
    T.StructField("result", T.StructType([
        T.StructField("title", T.StringType()),
        T.StructField("location", T.StructType([
            T.StructField("lng", T.DoubleType()),
            T.StructField("lat", T.DoubleType()),
        ])),
    ])),
])


def geocode_fields(json_col: Column | str) -> list[Column]:
    """Columns ``title, lng, lat`` with the defaults applied."""
    c = F.col(json_col) if isinstance(json_col, str) else json_col
    parsed = F.from_json(c, GEOCODE_SCHEMA, {"mode": "PERMISSIVE"})
    res = parsed.getField("result")
    loc = res.getField("location")
    usable = res.isNotNull() & loc.isNotNull()
    title = F.when(usable, F.coalesce(res.getField("title"), F.lit(""))).otherwise(F.lit(""))
    lng = F.when(usable, F.coalesce(loc.getField("lng"), F.lit(0.0))).otherwise(F.lit(0.0))
    lat = F.when(usable, F.coalesce(loc.getField("lat"), F.lit(0.0))).otherwise(F.lit(0.0))
    return [title.alias("title"), lng.alias("lng"), lat.alias("lat")]
