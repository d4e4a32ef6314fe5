"""Vessel position reports to voyages, as plain Spark DataFrame transformations."""
