"""Tick analytics as PySpark DataFrame functions.

Operators take and return DataFrames, so a whole report is one Catalyst plan.
"""
