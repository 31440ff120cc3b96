"""Cleaning rules, suites, star schema, business questions and jobs."""
