"""Retail retention analytics as Spark jobs: raw CSV to cleaned tables to marts."""
