"""Thresholds and vocabulary shared by the operators."""

from __future__ import annotations

# Quality thresholds of the validator.
COVERAGE_CLEAN = 0.97
COVERAGE_WARN = 0.90
CONFLICT_LIMIT = 0.05
CONFLICT_CONFIDENCE = 0.45
CLASS_PURITY = 0.7

# Reach of the part splitter, in blocks.
LOOK_AHEAD = 5
LOOK_BACK = 9

# Letters of Vietnamese point numbering, in their order.
POINT_ALPHABET = "abcdđeghiklmnopqrstuvxy"

# Level of each node type; a smaller level encloses a larger one.
LEVELS = {
    "phan": 0,
    "chuong": 1,
    "muc": 2,
    "tieu_muc": 3,
    "dieu": 4,
    "khoan": 5,
    "diem": 6,
    "gach_dau_dong": 7,
    "phu_luc": 0,
}

# Sizes and seed of the two samples.
SAMPLE_DEV = 5000
SAMPLE_GOLDEN = 30
SAMPLE_SEED = 42
