"""Fluxweave: life-cycle inventory and impact analytics as Spark DataFrame jobs."""
