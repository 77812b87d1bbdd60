"""Incremental maintenance of the daily demand counts (the reference is batch-only;
this applies the same D1 operator to ticket files as they land)."""
