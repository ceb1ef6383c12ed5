"""Training-data operators: one module an operator, their queries in ``queries``."""
