"""Tierline: a retail lakehouse library written as PySpark DataFrame code.

Raw transaction feeds become an append-only Bronze table, a typed, gated and
deduplicated Silver table, and Gold marts; features, retrieval, dashboard
figures, access rules and table upkeep work on those tables.
"""
