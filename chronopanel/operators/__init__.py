"""DataFrame operators of the panel model: joins, aggregates, windows,
reshaping, sampling, models, forecasting and attribution."""
