"""Domain plans put together from operators: loading, daily state, intraday, features, evaluation."""
