"""trilake: a Spark-native three-zone (raw CSV -> trusted -> curated) title finance lake.

Every public function takes and returns DataFrames (or builds SQL text over views);
Python only composes logical plans, Catalyst and AQE pick the physical strategy.
"""

from trilake.session import build_session, shared_dir

__all__ = ["build_session", "shared_dir"]
