"""DataFrame operators: presence, periods, quality, models, evaluation, profile, analytics."""
