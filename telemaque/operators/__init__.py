"""DataFrame → DataFrame operators, used through ``df.transform``.

Each one works on batch tables and on streams, except where its docstring says "batch".
"""
