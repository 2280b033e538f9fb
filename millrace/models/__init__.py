"""Models fitted by MLlib on the executors, and their metrics as DataFrames."""
