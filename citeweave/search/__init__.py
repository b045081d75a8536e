"""Search requests compiled to DataFrames."""
