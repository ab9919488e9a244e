"""Column functions: flags, CIGAR strings, names, intervals, sequences, estimators."""
