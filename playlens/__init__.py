"""playlens: game-statistics analytics on Spark DataFrames and Structured Streaming.

Everything is expressed with the DataFrame API so Catalyst can prune, push
down and pipeline it; Python runs on executors only inside the stateful
streaming memo (``streaming.memo_state``).
"""

__version__ = "0.1.0"
