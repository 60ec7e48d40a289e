"""Comparable-property analysis as Spark DataFrame jobs."""
