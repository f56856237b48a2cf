"""Operators that prepare training data: formatting, mixing, near-copies, decontamination, search, scoring."""
