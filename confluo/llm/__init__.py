"""Training-data operators: cleaning, deduplication, tokenisation and search over document tables.

Nothing else in the library imports this subpackage. Rules that hold for every operator here:

* a null text counts as an empty text, a null id is an ordinary id;
* rows that repeat an id and a text are all kept and get the same result (unless dropping copies is the operator's task);
* an empty table gives an empty result with the same columns;
* columns the operator doesn't know are passed on by the filtering forms and ignored by the digest forms, and helper
  columns carry a ``__`` prefix, so names like ``n``, ``start`` or ``key`` in the input don't clash.
"""
