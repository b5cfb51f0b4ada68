"""Batch only: the engine's sources are dated snapshots, so no stream is defined.

Freshness is a batch rule (evidence newer than the newest load event) and lives
in ``verigrid.plans.quality``.
"""
