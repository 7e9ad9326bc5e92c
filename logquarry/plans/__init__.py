"""Layer pipelines made of the operators."""
