"""Named analytical questions, each a function of DataFrames."""
