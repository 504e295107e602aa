"""Declared table models: schema, descriptions, roles, links and glossary terms."""

from harbormill.models.registry import Field, Link, Model, Registry, dimension, join_to, primary_key

__all__ = ["Field", "Link", "Model", "Registry", "dimension", "join_to", "primary_key"]
