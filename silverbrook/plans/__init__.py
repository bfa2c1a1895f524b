"""Pipelines: silver, curated, marts, monitoring, quality, scoring."""
