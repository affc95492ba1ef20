"""Whole-corpus flow and the registered queries."""
