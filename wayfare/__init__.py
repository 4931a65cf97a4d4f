"""wayfare: a Spark-native event-to-recommendation engine.

Events are normalised, ingested with Structured Streaming into a day-partitioned
table, folded into weighted user-item interactions, indexed, fed to implicit ALS,
and the top items per user are published with reference data joined in. A
leave-one-out evaluation and bulk serving queries run over the same DataFrames.
"""

from wayfare.session import build_session, checkpoint_root, scratch_path

__all__ = ["build_session", "checkpoint_root", "scratch_path"]
