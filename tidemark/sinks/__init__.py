"""Writers: DataFrames to files and text records."""
