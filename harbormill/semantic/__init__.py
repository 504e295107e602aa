"""Governed metrics over the declared models."""

from harbormill.semantic.layer import Filter, Metric, MetricView, SemanticLayer

__all__ = ["Filter", "Metric", "MetricView", "SemanticLayer"]
