"""Training-data operators: dedup, mixing, scans, quality and decontamination.

Nothing outside this subpackage imports it; ``queries`` holds the registered
``opN_*`` queries and their SQL.
"""
