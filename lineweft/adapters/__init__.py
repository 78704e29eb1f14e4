"""Documents built from relational tables, one document per entity, with planted hard cases.

The operators must parse these documents; the checks compute the expected rows from the
same tables without them.
"""
