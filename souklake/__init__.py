"""Marketplace lakehouse jobs on Spark: synthesis, landing, silver, gold, publish and checks."""
