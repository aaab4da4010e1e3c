"""tidemark: subscription-revenue analytics as lazy Spark DataFrame operators.

Two canonical inputs (customers, transactions) are turned into the standard
result tables of subscription finance.  Every operator is a function
``DataFrame -> DataFrame`` built from Spark SQL expressions, windows, joins and
Spark ML; nothing is collected to the driver except bounded split points.
"""

__version__ = "0.1.0"
