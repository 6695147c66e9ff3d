"""End-to-end plans (data build, walk-forward selection, evaluation) and the query registry."""
