"""martforge: a retail star-schema ELT engine expressed as Spark DataFrame plans.

Raw order, customer, product and order-item tables are cleaned, staged,
turned into a star schema (surrogate-keyed dimensions plus an order-item
fact), maintained incrementally and audited -- every step a lazy
DataFrame -> DataFrame function that Catalyst and AQE plan for the cluster.
"""

__version__ = "0.1.0"
