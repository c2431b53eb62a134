"""DataFrame operators: windows, features, splits, sampling, evaluation, models, tracking."""
