"""Multi-step runs built from the operators."""
