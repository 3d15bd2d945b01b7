"""tiers: layered (bronze / silver / gold) batch analytics on Spark.

Raw CSV files are listed and ingested into typed tables with audit columns
(``tiers.sources``), cleaned by declarative table specs (``tiers.plans``)
built from column rules (``tiers.functions``) and table operators
(``tiers.operators``), and modelled as a star of dimension and fact tables
through checked lookup joins. Every step is a lazy DataFrame plan; only the
catalog writes, the ingest run and the checks act.
"""

from tiers.session import get_session, shared_dir

__all__ = ["get_session", "shared_dir"]
