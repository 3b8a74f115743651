"""Daily jobs: compositions of operators over the whole lake."""
