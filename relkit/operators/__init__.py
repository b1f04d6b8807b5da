"""The queries, one function each, taking a :class:`relkit.Tables`."""
