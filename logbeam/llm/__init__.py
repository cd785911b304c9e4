"""Training-data operators: ten numbered operators and what they share.

Nothing outside this folder imports it; ``__spark_entry__.py`` adds its
queries only when it is present.  ``queries.py`` holds the registered
queries, ``oracle.py`` their SQL, one module per operator the rest.
"""
