"""Table operators over DataFrames."""
