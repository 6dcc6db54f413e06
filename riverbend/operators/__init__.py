"""DataFrame -> DataFrame operators (batch and streaming alike)."""
