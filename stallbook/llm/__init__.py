"""Training-data operators: each module is one operator; nothing else in the package imports them."""
