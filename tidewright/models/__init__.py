"""Risk model: training frame, split, fit, metrics, scoring. Data stays on the executors."""
