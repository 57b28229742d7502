"""DataFrame -> DataFrame operators.

Stateless operators (projections, filters, casts, JSON parsing, banding)
never collect or cache, so they also run unchanged on a streaming frame.
"""
