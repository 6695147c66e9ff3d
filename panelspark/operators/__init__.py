"""DataFrame -> DataFrame operators: cleaning, features, folds, panels, models, metrics."""
