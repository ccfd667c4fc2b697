"""Relations: tables, feature views, model rows and the model registry."""
