"""Observations per place and day: parse, clean, store and report them with Spark."""
