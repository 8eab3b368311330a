"""The campaign steps, composed from the operators."""
