"""tessera: Spark-native workload and record-erasure toolkit.

Every operator is a function over ``pyspark.sql.DataFrame`` built from public
DataFrame / SQL operations; Catalyst plans and Spark executes them.

* ``tessera.sources`` / ``tessera.sinks`` -- files, catalog tables, partitions, JDBC
* ``tessera.functions`` -- seeded, partition-independent column generators
* ``tessera.operators`` -- stage operators, splits, generator, joins, erase
* ``tessera.plans`` -- stage flows, workloads, jobs, run and stage metrics
* ``tessera.streaming`` -- erase requests applied as they arrive
* ``python -m tessera <job> <config>`` -- the jobs from key=value configs
"""

__version__ = "0.1.0"

__all__ = ["functions", "operators", "plans", "sinks", "sources", "streaming"]
