"""Raw Data Vault loading on Spark: stage, hash, and insert only what is new."""

from vaultwright.spec import Batch, HashRule, HubSpec, LinkSpec, SatSpec, StageSpec

__all__ = ["Batch", "HashRule", "HubSpec", "LinkSpec", "SatSpec", "StageSpec"]
