"""Operators: functions from DataFrames to DataFrames.

Almost all are lazy. Linking writes its term vectors and stratified sampling
its bucket counts to the shared folder when called.
"""
