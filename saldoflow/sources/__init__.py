"""Inputs: callback feed, sheets, tables."""
