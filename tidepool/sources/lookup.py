"""Lookup sources for enrichment.

``jdbc_dimension`` reads a dimension table once per batch (a set join
instead of one query per record). ``table_geocoder`` is a stub, for tests and the
registered query, where no service may be called: it answers from the address
text alone and covers the failure shapes a real HTTP geocoding service returns
(bad JSON, no ``result``, no ``location``).
"""

from __future__ import annotations

import json
import re

from pyspark.sql import DataFrame, SparkSession


def jdbc_dimension(spark: SparkSession, url: str, table: str, properties: dict | None = None) -> DataFrame:
    """The dimension table through JDBC (credentials come from the caller)."""
    return spark.read.jdbc(url, table, properties=properties or {})


_DIGITS = re.compile(r"([0-9]+)$")


def table_geocoder(address: str) -> str | None:
    """Stub: a deterministic geocoding reply for an address.

    Rules: last digit 7 -> not JSON; 3 -> no ``result``; 5 -> no ``location``;
    otherwise title = upper-cased address, lng = 100 + length / 100,
    lat = (trailing number mod 90) + 0.5 (0.5 when there is none).
    """
    if address is None:
        return None
    last = address[-1:] if address else ""
    if last == "7":
        return "<html>service unavailable</html>"
    if last == "3":
        return json.dumps({"status": 1, "message": "no result"})
    if last == "5":
        return json.dumps({"result": {"title": address.upper(), "level": "city"}})
    m = _DIGITS.search(address)
    lat = (int(m.group(1)) % 90 if m else 0) + 0.5
    return json.dumps({"status": 0, "result": {"title": address.upper(),
                                               "location": {"lng": 100 + len(address) / 100, "lat": lat}}})
