"""DataFrame -> DataFrame operators of the warehouse (no storage access)."""
