"""Multi-step plans: refined layers, scorecard, and the mapping of test tables to dataset roles."""
