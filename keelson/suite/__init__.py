"""The registered queries: each operator over a customer feed derived from the test tables."""
