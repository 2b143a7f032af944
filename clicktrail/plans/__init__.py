"""Whole analyses: from a path or an event table to a set of result tables."""
