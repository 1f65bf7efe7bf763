"""Settings of a catalog run."""

from __future__ import annotations

import hashlib
import json
from dataclasses import asdict, dataclass


@dataclass(frozen=True)
class CatalogConfig:
    """Defaults are those of the command line."""

    parallax_snr: float = 5.0
    proximity_arcsec: float = 2.0
    proximity_mag_tolerance: float = 1.0  # accepted for compatibility; matching doesn't use it
    chunk_size: float = 50.0
    chunks_per_partition_axis: int = 8  # chunks along each axis that share an output folder
    broadcast_hosts: int = 200_000  # up to this many hosts are broadcast to the stars; beyond it both sides shuffle

    dense_cell: int = 100_000  # stars of a cell of the match's grid that meet in one join key where both sides shuffle

    def fingerprint(self, *inputs: str) -> str:
        """Identifies parameters and inputs, so that a checkpoint of another run isn't taken up."""
        return hashlib.sha256(json.dumps([asdict(self), *inputs], sort_keys=True).encode()).hexdigest()
