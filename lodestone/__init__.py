"""Lodestone: a Spark-first analytics engine.

Operators are functions from DataFrames to DataFrames. They declare logical plans and leave the
physical strategy to Catalyst, Tungsten and adaptive execution.
"""
