"""Reusable DataFrame -> DataFrame operators of the marts."""
