"""Whole refresh runs and the registered queries with their comparison SQL."""
