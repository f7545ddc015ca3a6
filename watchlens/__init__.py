"""Viewing-behaviour analytics on Spark: ingest, sessions, quality, statistics, recommendations, A/B tests."""
