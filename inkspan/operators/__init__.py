"""Dataflow operators: functions of DataFrames, without collecting."""
