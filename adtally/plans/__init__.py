"""Reports. Each takes its tables as DataFrames and its time range as parameters.

Reports keep the hour or day in the group key, so one job covers any range: the scheduled
run passes one bucket, a backfill passes a month.
"""
