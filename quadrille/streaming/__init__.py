"""No streaming operators: feature tables are batch data.

The column functions in ``quadrille.functions`` keep no state, so they can be used on a
streaming DataFrame as they are.
"""
