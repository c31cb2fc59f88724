"""Sources: the table registry and the ERP views it serves."""
