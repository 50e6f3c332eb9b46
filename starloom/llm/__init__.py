"""Training-data operators: each module is one operator, ``registry`` holds the queries."""
