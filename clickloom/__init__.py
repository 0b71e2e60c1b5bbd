"""Shop-behaviour analytics on Spark: DataFrame in, DataFrame out.

Every function works on the caller's session; none of them creates or stops one.
"""
