"""DataFrame operators: cleaning, features, statistics, search, encoders, models and metrics."""
