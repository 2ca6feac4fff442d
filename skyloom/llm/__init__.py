"""Training-data operators: near-duplicates, packing, scoring, extraction, mixing, archives.

Nothing outside this subpackage imports it.  Each module holds one operator with a general
interface; ``queries`` binds them to the tables with their production parameters.
"""
