"""Where inputs come from: Parquet paths, lake tables and series text files."""

from laborloom.sources.files import read_jolts, read_qcew, read_series
from laborloom.sources.lake import LakeSource

__all__ = ["LakeSource", "read_jolts", "read_qcew", "read_series"]
