"""Plans made of operators: the field fit, its tuning, and the pipelines."""
