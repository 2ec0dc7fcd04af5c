"""Whole runs: the stage chain, and the registered queries with their SQL."""
