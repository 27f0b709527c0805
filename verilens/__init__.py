"""verilens: workspace reports (items, tasks, tipline conversations) on Spark.

A workspace is a set of relational tables exported from a fact-checking
tool.  The package turns one into three wide, typed report tables using
DataFrame/SQL operators only:

* ``sources``    - load / validate / derive workspaces (``dict[str, DataFrame]``)
* ``functions``  - Column -> Column helpers (JSON, YAML lines, answers, casts)
* ``operators``  - table operators (top-1 per key, ordered string agg, typing)
* ``plans``      - the reports and every intermediate relation they use
"""

__version__ = "0.1.0"


