"""Fixed values.

These constants have to equal the published pipeline's values for results to
agree: column names and order, region names, status words, patterns, tier
policy, safety factors and the MAD scale. They are data, not logic.
"""

from __future__ import annotations

# Length tiers: nine exclusive upper bounds make ten tiers.
TIER_BOUNDS = (80, 150, 280, 500, 900, 1600, 2800, 5000, 10000)
TIER_SHUFFLES = (1000, 1000, 1000, 1000, 1000, 1000, 1000, 100, 10, 0)

# Scoring.
DEFAULT_SHUFFLES = 1000
MIN_VALID_PERCENT = 90
MAD_SCALE = 1.4826

FEW_SHUFFLES = "insufficient shuffles"
INVALID_ENERGY = "invalid orig MFE"

# Calibration.
SAMPLES_PER_TIER = 3
SAFETY_FACTOR_TIME = 2
SAFETY_FACTOR_MEM = 2
MEMORY_FLOOR_MB = 200

# Submission.
CONCURRENT_LIMIT = 10
DEFAULT_TIME = "03:00:00"
DEFAULT_MEMORY = "1000MB"

# Extraction.
REGIONS = ("mRNA", "CDS", "5UTR", "3UTR",
           "start_codon_region", "stop_codon_region", "tail_region")
MIN_UTR_LENGTH = 30
CODON_FLANK_LENGTH = 30
TAIL_LENGTH = 100
TRANSCRIPT_TYPES = ("transcript", "mRNA")
LONGEST_CDS = "longest_cds"

STATUS_SUCCESS = "Success"
STATUS_NO_CDS = "No_CDS"
STATUS_SHORT = "Short_or_Missing_UTRs"
STATUS_MISSING = "Missing"
STATUS_NOT_IN_FASTA = "No_CDS_in_FASTA"
REASON_NOT_FOUND = "Not_Found_in_GFF"

# Patterns.
VALUE_PATTERN = r"([^; \n]+)"
CDS_PATTERN = r"CDS=(\d+)-(\d+)"
MFE_LINE_PATTERN = r"\(\s*([-+]?[0-9]*\.?[0-9]+)\s*\)$"
MFE_PATTERN = r"^[-+]?[0-9]*\.?[0-9]+$"

# Schemas, in file order.
MANIFEST_SCHEMA = ("seqname STRING, gene_id STRING, transcript_id STRING, region STRING, "
                   "length INT, selection_reason STRING, short_utrs BOOLEAN")
MANIFEST_COLUMNS = ("gene_id", "transcript_id", "region", "length",
                    "selection_reason", "short_utrs")
RAW_MANIFEST_COLUMNS = ("gene_id", "transcript_id", "region")
SUMMARY_COLUMNS = ("Gene_ID", "Transcript_ID", "Selection_Reason", "Total_Length",
                   "CDS_Length", "5UTR_Length", "3UTR_Length", "Status")
RESULT_SCHEMA = ("seq_name STRING, orig_mfe DOUBLE, median_mfe DOUBLE, pvalue DOUBLE, "
                 "zscore DOUBLE, n_valid INT, n_missing INT, n_shuffles_requested INT")
RAW_SCHEMA = "transcript_id STRING, iteration INT, shuffled_mfe DOUBLE"
LENGTHS_SCHEMA = "length INT, seqname STRING, tier INT"
PER_SAMPLE_SCHEMA = ("tier INT, seqname STRING, length INT, n_shuffles INT, "
                     "wall_s INT, rss_mb INT")
RECOMMENDATION_SCHEMA = ("tier INT, n_shuffles INT, n_samples INT, max_len INT, "
                         "max_wall_s INT, max_rss_mb INT, rec_time STRING, rec_mem STRING")
