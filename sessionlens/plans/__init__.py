"""Compositions of operators: named reports, staging and the end-to-end run."""

from sessionlens.plans.staging import stage, unstage

__all__ = ["stage", "unstage"]
