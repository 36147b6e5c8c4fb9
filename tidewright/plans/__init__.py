"""Compositions of the operators: landed feeds to silver facts, gold tables, features and serving views.

Every plan takes the clock as ``as_of`` and returns lazy frames.
"""
