"""Behaviour analytics and purchase propensity on Spark."""
