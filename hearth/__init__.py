"""hearth: district-table analytics as Spark DataFrame operators.

Sub-packages: ``sources`` (scans, fixtures, sinks), ``functions`` (column
expressions), ``operators`` (quality, features, relational, statistics,
regression, scoring), ``plans`` (compositions and the query registry),
``streaming`` (the stateless operators on ``readStream``).
"""

__version__ = "0.1.0"
