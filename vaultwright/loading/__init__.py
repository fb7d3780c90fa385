"""Jobs that write: staging, hub, link and satellite loads."""

from vaultwright.loading.vault import LoadResult, Vault

__all__ = ["LoadResult", "Vault"]
