"""Training-data pipeline operators, one module per operator, and their registered queries (``queries``)."""
