"""meteora: station-observation analytics on Spark.

Every public function takes DataFrames (plus a config) and returns a lazy
DataFrame; only job functions in ``meteora.plans`` run actions or writes.
"""

from meteora.config import PipelineConfig

__all__ = ["PipelineConfig"]
__version__ = "0.1.0"
