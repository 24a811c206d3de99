"""Freight-operations warehouse as Spark jobs.

Every public callable takes and returns DataFrames (or Columns), stays lazy and
uses built-in expressions only; an action happens where a stage is written.
"""
