"""Training-data operators (search, extraction, deduplication, tokens, language, packing, mixing).

Nothing else in the library imports this subpackage. Each module holds one operator with its
general interface; :mod:`sensorwerk.llm.queries` registers the ``opN_*`` queries.
"""
