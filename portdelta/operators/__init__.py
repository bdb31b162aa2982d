"""DataFrame operators; every one maps DataFrames to DataFrames and stays lazy."""
