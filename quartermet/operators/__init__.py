"""Set-oriented operators on DataFrames."""
