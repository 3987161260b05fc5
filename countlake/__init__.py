"""Visitor-counter analytics written with the Spark DataFrame API."""
