"""DataFrame-in, DataFrame-out building blocks; names of keys and columns are arguments."""
