"""flagstar: layered batch refinement of tables on Spark.

Raw files land as dated Parquet partitions (Bronze), declarative quality rules
flag bad rows instead of dropping them (Silver), and a star schema with a
generated calendar and an "unknown" member is modelled on top (Gold), together
with referential-integrity reports, data-contract checks and KPI marts.

Every operator is a DataFrame -> DataFrame function built from Spark SQL
built-ins, so Catalyst plans, prunes and pushes down the whole chain.
"""

from flagstar.session import get_session, scratch_dir

__all__ = ["get_session", "scratch_dir"]
