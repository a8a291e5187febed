"""tidewatch: topic-trend analytics as Spark DataFrame jobs.

Every stage is a plain ``DataFrame -> DataFrame`` function.  Record-level work
(cleaning, scoring, tokenising) stays in JVM column expressions; everything that
is per-topic is aggregated first so that no stage ever pulls a whole topic,
source or corpus into one task or onto the driver.
"""

from tidewatch.session import build_session, checkpoint_root

__all__ = ["build_session", "checkpoint_root"]
