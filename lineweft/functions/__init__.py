"""Column-to-column functions shared by the operators."""
