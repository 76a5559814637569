"""Offer economics and incrementality as Spark DataFrame operators."""
