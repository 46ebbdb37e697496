"""Training-data operators: each module is one operator with its own interface;
``queries`` registers the driver-facing query of each."""
