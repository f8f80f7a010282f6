"""tidewell: a content-intelligence engine expressed as Spark plans.

Every operator maps DataFrames (or Columns) to DataFrames (or Columns); nothing here schedules work by hand.
"""
