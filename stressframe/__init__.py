"""stressframe: credit-stress and pre-delinquency analytics as Spark jobs.

Sub-packages
------------
sources    readers for customer / statement tables, derived test tables, sinks
functions  column expressions (exact ratios, clips, predicates, bins)
operators  table operators: cleaning, features, profiles, splits, metrics,
           encoding, models, explanation, risk policy
plans      registered queries and their SQL oracles
streaming  the stateless path (clean -> features -> policy) on readStream
"""

__version__ = "0.1.0"
