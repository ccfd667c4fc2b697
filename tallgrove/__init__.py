"""tallgrove: tabular prediction and forecasting as Spark jobs."""
