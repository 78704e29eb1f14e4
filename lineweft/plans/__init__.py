"""Whole corpora to graphs, and graphs to exports."""
