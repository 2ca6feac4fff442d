"""Table schemas, product scopes and their contracts."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

_KINDS = {"s": T.StringType(), "t": T.TimestampNTZType(), "d": T.DoubleType(), "l": T.LongType(), "i": T.IntegerType(), "b": T.BooleanType()}


def _struct(spec: str) -> T.StructType:
    """``name:kind`` fields; a question mark makes a field nullable."""
    fields = []
    for part in spec.split():
        name, kind = part.split(":")
        fields.append(T.StructField(name, _KINDS[kind[0]], kind.endswith("?")))
    return T.StructType(fields)


REGION_REGISTRY = _struct("country_code:s region_type:s source_region_id:s canonical_region_id:s region_name:s parent_region_id:s? timezone:s geometry_version:s geometry_checksum:s loaded_at:t")
GRID_WEIGHTS = _struct("grid_row:i grid_col:i canonical_region_id:s overlap_weight:d geometry_version:s")
GRID_CELLS = _struct("granule_id:s observation_time:t observation_hour:t grid_row:i grid_col:i no2:d? quality_flag:i latitude:d longitude:d")
GRANULE_INVENTORY = _struct(
    "granule_id:s concept_id:s acquisition_start:t? acquisition_end:t? cmr_revision_at:t? last_seen_at:t download_url:s? local_path:s? checksum_sha256:s? file_size_bytes:l? "
    "observation_time:t? observation_hour:t? discovery_status:s download_status:s validation_status:s processing_status:s discovered_at:t downloaded_at:t? validated_at:t? processed_at:t? error_message:s? updated_at:t"
)
RUN_EVENTS = _struct("run_id:s job_name:s step:s status:s started_at:t finished_at:t? rows_written:l? message:s?")
REGION_HOURS = _struct(
    "observation_hour:t canonical_region_id:s country_code:s region_type:s no2_mean:d? no2_median:d? no2_p90:d? valid_pixel_count:l total_pixel_count:l valid_area_km2:d total_area_km2:d "
    "coverage_fraction:d quality_flag_accepted:b source_granule_count:i all_granules_validated:b revision:l geometry_version:s ingested_at:t"
)
GRID_LATEST = _struct("grid_row:i grid_col:i latitude:d longitude:d cell_area_km2:d observation_time:t observation_hour:t no2:d? quality_flag:i quality_flag_accepted:b granule_id:s ingested_at:t")
CONTRACT = _struct("contract_key:s contract_version:s min_region_coverage:d stale_hours_warn:i stale_hours_error:i anomaly_baseline_days:i anomaly_min_baseline_samples:i accepted_quality_flags:s")

FINEST_TYPES = ("county", "census_subdivision", "municipality")
COUNTRIES = ("US", "CA", "MX")


@dataclass(frozen=True)
class Contract:
    """The policy of one scope; ``parse_contract`` validates it."""

    contract_version: str = "0.4.0"
    min_region_coverage: float = 0.25
    stale_hours_warn: int = 6
    stale_hours_error: int = 12
    anomaly_baseline_days: int = 28
    anomaly_min_baseline_samples: int = 7
    accepted_quality_flags: tuple[int, ...] = (0, 1)

    def __post_init__(self):
        if not 0 <= self.min_region_coverage <= 1:
            raise ValueError("min_region_coverage must be between 0 and 1")
        if self.stale_hours_warn < 1 or self.stale_hours_error <= self.stale_hours_warn:
            raise ValueError("stale_hours_error must exceed stale_hours_warn, which must be 1 or more")
        if self.anomaly_baseline_days < 1 or self.anomaly_min_baseline_samples < 1:
            raise ValueError("baseline days and samples must be 1 or more")


@dataclass(frozen=True)
class Scope:
    """A product scope: its name, database prefix and contract."""

    name: str
    contract: Contract

    def database(self, layer: str) -> str:
        if layer not in ("raw", "ops", "staging", "intermediate", "marts", "observability"):
            raise ValueError(f"unknown layer {layer}")
        return f"{self.name}_{layer}"


SCOPES = {"no2": Scope("no2", Contract()), "no2_std": Scope("no2_std", Contract(stale_hours_warn=24, stale_hours_error=48))}


def scope(name: str) -> Scope:
    key = name.lower().replace("-", "_")
    if key not in SCOPES:
        raise ValueError(f"unknown scope {name}; known: {', '.join(SCOPES)}")
    return SCOPES[key]
