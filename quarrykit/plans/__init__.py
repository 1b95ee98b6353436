"""Whole plans: the queries over the test tables, stages and configuration."""
