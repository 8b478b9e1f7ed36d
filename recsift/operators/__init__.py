"""Whole-table operators and composite jobs. Every function returns a lazy DataFrame."""
