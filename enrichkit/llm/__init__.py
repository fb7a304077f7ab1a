"""Training-data operators: one module per operator, their registered queries in ``queries``.

Nothing outside this subpackage imports it; the entry module adds its queries
only when the subpackage is there.
"""
