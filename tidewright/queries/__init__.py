"""Queries over the driver's tables with their SQL; each module registers its own."""

from tidewright.queries import aggregates, channels, filters, graphs, identity, integrity, joins, payloads, people, ranking, registries, reshaping, scalars, scores, sources, streams, value_rows, verdicts
from tidewright.queries.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES", "aggregates", "channels", "filters", "graphs", "identity", "integrity", "joins", "payloads", "people", "ranking", "registries", "reshaping", "scalars", "scores", "sources", "streams", "value_rows", "verdicts"]
