"""Repository activity analytics on Spark.

Landed API pages, mined commit logs and CI archives go in; sixteen typed, pseudonymised tables, resolved
commit identities, per-repository summaries and contribution metrics come out. Every operator is a lazy
``DataFrame -> DataFrame`` function keyed by repository, so one job serves any number of repositories.
"""

from repolume.session import build_session, scratch_dir

__all__ = ["build_session", "scratch_dir"]
