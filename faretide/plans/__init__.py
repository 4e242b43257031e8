"""Reports and gold tables. Trips are aggregated first; names are joined to the few rows left."""
