"""Registered queries: each operator run over whole tables, with the SQL that must give the same rows."""

from __future__ import annotations

from riskloom.catalog import blending, encoding, features, interactions, learning, scoring, tables
from riskloom.catalog.base import REGISTRY

__all__ = ["REGISTRY", "blending", "encoding", "features", "interactions", "learning", "scoring", "tables"]
