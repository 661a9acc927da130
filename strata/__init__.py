"""strata: a PySpark library for batch medallion pipelines.

Landed JSON pages become versioned, slice-replaceable bronze tables; staging
functions flatten and type them; mart functions aggregate per (entity, season);
audits gate publishing; serving functions answer parameterised queries.

Every transformation is a ``DataFrame -> DataFrame`` function so Catalyst sees
one logical plan per job.
"""

from strata.session import build_session, cluster_conf, work_root

__all__ = ["build_session", "cluster_conf", "work_root"]
