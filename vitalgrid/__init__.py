"""Wearable time-series analytics on Spark DataFrames.

A table holds many series (people, devices, metrics) side by side; every operator takes the
columns that identify a series (``keys``) and returns DataFrames, reports included.
"""

from pyspark import cloudpickle as _cloudpickle

# Functions that run in Python workers travel with the task, so executors need no installation.
_cloudpickle.register_pickle_by_value(__import__(__name__))
