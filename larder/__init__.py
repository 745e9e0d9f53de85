"""Household food-consumption analytics as Spark DataFrame operators."""
