"""Split, evaluation, training, scoring, tuning and forecasting operators."""
