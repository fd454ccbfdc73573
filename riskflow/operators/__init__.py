"""riskflow.operators."""
