"""Which operators run on which inputs: reporting periods, the full layer, the query catalog."""
