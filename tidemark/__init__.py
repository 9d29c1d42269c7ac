"""Spark jobs for governed analytics: masking, encryption, drift, control, lineage, mapping."""

__version__ = "0.1.0"
