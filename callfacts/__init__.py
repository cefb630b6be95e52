"""Call-center fact enrichment on Spark.

A client dimension and date-partitioned call (CSV) and chat (JSON, nested
message list) facts are read under declared schemas, brought to UTC, checked
rule by rule, joined to the dimension and written to staging tables.  All the
data work is DataFrame expressions; Catalyst and AQE pick the physical plan.

Sub-packages:

* ``sources``   -- catalog / CSV / JSON / text readers, partition selection
* ``functions`` -- column expressions: time zones, offsets, patterns, keys, rules
* ``operators`` -- DataFrame operators: normalize, enrich (measured join tiers),
                   shapes, checks
* ``plans``     -- size checks, cache scope, plan text, the batch job ``run``
* ``sinks``     -- generic writer (save modes, partition overwrite, self-overwrite
                   guard) and staged publish of several catalog tables
* ``streaming`` -- the same job driven by newly landing date folders
"""

from callfacts import schemas

__all__ = ["schemas"]
