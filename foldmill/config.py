"""Run settings.

Extraction settings come from a YAML or JSON file, all others from defaults that
environment variables of the same name override.
"""

from __future__ import annotations

import json
import os
from collections.abc import Mapping
from dataclasses import dataclass, field, fields, replace
from typing import Any

from foldmill import fixed_values as fixed
from foldmill.functions.tiers import check_policy


class ConfigError(ValueError):
    """A setting is missing or wrong."""


@dataclass(frozen=True)
class ExtractConfig:
    genome_fasta: str
    annotation_gff: str
    gene_list: str
    output_dir: str = "extracted_regions"
    output_mode: str = "multifasta"
    min_utr_length: int = fixed.MIN_UTR_LENGTH
    filter_short_utrs: bool = False
    codon_flank_length: int = fixed.CODON_FLANK_LENGTH
    tail_length: int = fixed.TAIL_LENGTH
    isoform_priority: tuple[str, ...] = ()
    regions_to_extract: tuple[str, ...] = ()

    @classmethod
    def from_mapping(cls, settings: Mapping[str, Any]) -> ExtractConfig:
        inputs = settings.get("inputs") or {}
        for key in ("genome_fasta", "annotation_gff", "gene_list"):
            if key not in inputs:
                raise ConfigError(f"the settings name no inputs.{key}")
        known = {f.name for f in fields(cls)}
        given = {**inputs, **(settings.get("outputs") or {}), **(settings.get("processing") or {})}
        values = {k: tuple(v or ()) if k in ("isoform_priority", "regions_to_extract") else v
                  for k, v in given.items() if k in known}
        return cls(**values)

    @classmethod
    def load(cls, path: str) -> ExtractConfig:
        with open(path, encoding="utf-8") as handle:
            text = handle.read()
        if path.endswith(".json"):
            return cls.from_mapping(json.loads(text))
        try:
            import yaml
        except ImportError as missing:
            raise ConfigError("PyYAML is needed for YAML settings; use a .json file") from missing
        return cls.from_mapping(yaml.safe_load(text) or {})


@dataclass(frozen=True)
class RunConfig:
    multifasta_dir: str = "extracted_regions"
    manifest_tsv: str = ""
    tier_root: str = "lists"
    results_dir: str = "results/rnafold"
    raw_shuffles_dir: str = "results/rnafold_raw_shuffles"
    errors_dir: str = "errors/rnafold"
    calibration_root: str = "calibration"
    rnafold_bin: str = "RNAfold"
    tier_bounds: tuple[int, ...] = fixed.TIER_BOUNDS
    tier_shuffles: tuple[int, ...] = fixed.TIER_SHUFFLES
    n_shuffles: int = fixed.DEFAULT_SHUFFLES
    min_valid_percent: int = fixed.MIN_VALID_PERCENT
    slurm_time: str = fixed.DEFAULT_TIME
    slurm_mem_per_cpu: str = fixed.DEFAULT_MEMORY
    concurrent_limit: int = fixed.CONCURRENT_LIMIT
    samples_per_tier: int = fixed.SAMPLES_PER_TIER
    safety_factor_time: int = fixed.SAFETY_FACTOR_TIME
    safety_factor_mem: int = fixed.SAFETY_FACTOR_MEM
    seed: int = field(default=0)

    def __post_init__(self):
        check_policy(self.tier_bounds, self.tier_shuffles)
        if not self.manifest_tsv:
            object.__setattr__(self, "manifest_tsv", f"{self.multifasta_dir}/manifest.tsv")

    @classmethod
    def from_env(cls, env: Mapping[str, str] | None = None, **overrides: Any) -> RunConfig:
        """Defaults, overridden by non-empty variables, overridden by arguments."""
        env = os.environ if env is None else env
        values: dict[str, Any] = {}
        for setting in fields(cls):
            text = env.get(setting.name.upper(), "")
            if text == "":
                continue
            if isinstance(setting.default, tuple):
                values[setting.name] = tuple(int(n) for n in text.split())
            else:
                values[setting.name] = type(setting.default)(text)
        return replace(cls(**values), **overrides) if overrides else cls(**values)
