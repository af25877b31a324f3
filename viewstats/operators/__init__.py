"""DataFrame-to-DataFrame operators, all keyed by ``_load_date``."""
