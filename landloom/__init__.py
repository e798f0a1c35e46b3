"""landloom: land-register data as Spark jobs.

Versioned object tables, array-valued relations, map layers, register marts
and geometry work, all expressed as DataFrame plans.
"""
