"""Geo-temporal analytics on Spark: station readings to gridded hourly condition vectors."""
