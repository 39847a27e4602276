"""Imports every module that registers queries."""

from checks import q_analytics, q_loads, q_quality, q_streaming, q_transforms, q_verbs  # noqa: F401
