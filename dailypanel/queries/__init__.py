"""Registered queries: each operator bound to the provided tables, with its SQL counterpart."""
