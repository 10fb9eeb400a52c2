"""DataFrame operators: cleaning, splits, profiling, features, models, evaluation, explanation."""
