"""Multi-step jobs that chain the operators."""
