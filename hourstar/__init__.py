"""Hourly sensor series to a queryable star schema, as Spark plans."""
