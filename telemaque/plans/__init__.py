"""Bindings of tables to topics, and the named queries over them with their SQL counterparts."""
