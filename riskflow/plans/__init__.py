"""riskflow.plans."""
