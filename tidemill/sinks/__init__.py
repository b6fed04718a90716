"""Sinks: keyed upsert, table create/replace, load metadata, views, JSON."""
