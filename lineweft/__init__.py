"""Lineage and catalogue-metadata graphs from document corpora, built on Spark DataFrames."""

from lineweft.config import LineageConfig

__all__ = ["LineageConfig"]
