"""Scans of landed files.  Each yields one row per record, in a known order.

Common columns: ``ord`` (position of the record in its source, a sortable struct),
``payload`` (the whole record as VARIANT, or its text when it
could not be read) and ``malformed`` (it could not be read).  The record itself is either text columns (CSV) or one VARIANT column ``record``.
"""
