"""Fixed values of the credit-application domain.

Fixed values: column names, allowed levels, encodings, thresholds and weights
below must equal the published pipeline's, otherwise results differ. Operators
never read this module; the jobs in ``scorewarden.plans`` pass it to them.
"""

from __future__ import annotations

import datetime as dt

# --- columns -----------------------------------------------------------------
CASE = "案件編號"
DAY = "進件日"
MONTH = "進件年月"
OUTCOME = "授信結果"
LABEL = "授信結果_二元"
LEAK = "成功案例"

REQUIRED_COLUMNS = [
    "案件編號", "進件日", "授信結果", "年齡", "性別", "教育程度", "婚姻狀況", "月所得", "職業說明",
    "居住地", "廠牌車型", "原申辦金額", "申辦期數", "車齡", "動產設定", "內部往來次數",
    "近半年同業查詢次數", "所留市內電話數",
]
INTEGER_COLUMNS = ["申辦期數", "年齡", "所留市內電話數", "內部往來次數", "近半年同業查詢次數"]
DOUBLE_COLUMNS = ["原申辦金額", "車齡"]
CATEGORY_COLUMNS = ["性別", "教育程度", "婚姻狀況", "職業說明", "居住地", "廠牌車型", "動產設定", "授信結果"]
FILL_COLUMNS = ["教育程度", "婚姻狀況", "職業說明", "居住地", "性別", "月所得"]
MISSING = "Missing"

COLUMN_TYPES = {
    **{c: "string" for c in REQUIRED_COLUMNS},
    "進件日": "date",
    **{c: "integer" for c in INTEGER_COLUMNS},
    **{c: "double" for c in DOUBLE_COLUMNS},
}
ALLOWED_LEVELS = {
    "性別": ["男", "女", None, "Missing"],
    "婚姻狀況": ["已婚", "未婚", "離婚", "同居", None, "Missing"],
    "教育程度": ["國中", "高中", "專科", "大學", "碩士", "碩士以上", "博士以上", "其他", None, "Missing"],
    "授信結果": ["APP(核准)", "WTCD(婉拒)", "PEND(審核中)", "CANCEL(取消)"],
    "動產設定": ["Y", "N", "0", "1", None],
}
NUMERIC_RANGES = {
    "年齡": (18, 100),
    "申辦期數": (1, 120),
    "原申辦金額": (0, 10_000_000),
    "車齡": (-1, 100),
    "內部往來次數": (-1, 1000),
    "近半年同業查詢次數": (-1, 100),
    "所留市內電話數": (0, 10),
}
NULL_RATIO_LIMITS = {
    "案件編號": 0.0, "進件日": 0.0, "授信結果": 0.0, "年齡": 0.05, "性別": 0.10,
    "教育程度": 0.50, "月所得": 0.30, "車齡": 0.50,
}
NULL_RATIO_DEFAULT = 0.30
MIN_TOTAL_ROWS = 1000
MIN_MONTHLY_ROWS = 50
MAX_DUPLICATE_RATIO = 0.01
MAX_UNSEEN_RATIO = 0.05
MAX_SINGLE_LEVEL_RATIO = 0.95
POSITIVE_RATIO_RANGE = (0.05, 0.95)
MAX_OTHER_LABEL_RATIO = 0.05
MAX_LABEL_DRIFT = 0.10

# --- encodings ---------------------------------------------------------------
TARGET = {"APP(核准)": 1, "WTCD(婉拒)": 0}
SEX = {"男": 1, "女": 0}
MARRIAGE = {"已婚": 1, "未婚": 0}
MERGED_LEVELS = {"婚姻狀況": {"同居": "未婚"}}
EDUCATION = {
    "Missing": 0, "其他": 1, "國中": 2, "高中": 3, "專科": 4, "大學": 5, "碩士": 6, "碩士以上": 6, "博士以上": 7,
}
EDUCATION_FROM_JOB = {"學生(大專生)": "大學", "學生(高中職生)": "高中", "學生(國中生)": "國中"}
INCOME_BANDS = {
    "Missing": 0,
    "~20,000": 1, "20,000~24,999": 2, "25,000~29,999": 3, "30,000~34,999": 4, "35,000~39,999": 5,
    "40,000~44,999": 6, "45,000~49,999": 7, "50,000~54,999": 8, "55,000~59,999": 9, "60,000~64,999": 10,
    "65,000~69,999": 11, "70,000~74,999": 12, "75,000~79,999": 13, "80,000~": 14,
    "20,000~29,999": 2, "30,000~39,999": 4, "40,000~49,999": 6,
    "50,000~59,999": 8, "60,000~69,999": 10, "70,000~79,999": 12,
}
INCOME_MIDPOINTS = {
    "Missing": 30000.0,
    "~20,000": 15000.0, "20,000~24,999": 22500.0, "25,000~29,999": 27500.0, "30,000~34,999": 32500.0,
    "35,000~39,999": 37500.0, "40,000~44,999": 42500.0, "45,000~49,999": 47500.0, "50,000~54,999": 52500.0,
    "55,000~59,999": 57500.0, "60,000~64,999": 62500.0, "65,000~69,999": 67500.0, "70,000~74,999": 72500.0,
    "75,000~79,999": 77500.0, "80,000~": 100000.0,
    "20,000~29,999": 25000.0, "30,000~39,999": 35000.0, "40,000~49,999": 45000.0,
    "50,000~59,999": 55000.0, "60,000~69,999": 65000.0, "70,000~79,999": 75000.0,
}
INCOME_DEFAULT = 30000.0
# (exclusive upper age, band); anything else, unknown ages included, is the last band
AGE_BANDS = [(21, "~20"), (31, "21-30"), (41, "31-40"), (51, "41-50"), (61, "51-60")]
AGE_LAST_BAND = "61~"
AGE_ORDINALS = {"~20": 0, "21-30": 1, "31-40": 2, "41-50": 3, "51-60": 4, "61~": 5}
CAR_AGE_SENTINEL = -1
CAR_AGE_CEILING = 100

# --- features ----------------------------------------------------------------
NUMERIC_TO_SCALE = [
    "年齡", "申辦期數", "原申辦金額_log", "車齡_log", "內部往來次數_log", "近半年同業查詢次數_log", "所留市內電話數_log",
]
ORDINAL_FEATURES = ["教育程度_序位", "月所得_序位", "年齡組_序位"]
BINARY_FEATURES = [
    "性別_二元", "婚姻狀況_二元", "動產設定", "車齡_是否缺失", "車齡_異常旗標", "教育程度_是否缺失",
    "月所得_是否缺失", "內部往來次數_是否特殊值", "近半年同業查詢次數_是否缺失",
]
HIGH_CARDINALITY = ["居住地", "職業說明", "廠牌車型"]
CROSS_FEATURES = ["負債月所得比", "年齡_婚姻交互", "車齡_金額交互", "教育_所得交互"]
KEY_COLUMNS = [CASE, DAY, MONTH]
NON_FEATURES = [
    "案件編號", "進件日", "進件年月", "授信結果", "授信結果_二元", "性別", "教育程度", "婚姻狀況", "月所得",
    "職業說明", "居住地", "廠牌車型", "動產設定", "bronze_load_timestamp", "silver_process_timestamp",
    "gold_process_timestamp", "年", "月",
]
PRUNED_FEATURES = [
    "車齡_異常旗標", "內部往來次數_是否特殊值", "近半年同業查詢次數_是否缺失", "教育程度_是否缺失",
    "負債月所得比_scaled", "教育_所得交互_scaled",
]
SEGMENT_LEVELS = ["教育程度", "月所得", "年齡組_序位", "性別_二元", "婚姻狀況_二元", "職業說明", "居住地"]
SEGMENT_NUMBERS = [
    "年齡_scaled", "原申辦金額_log_scaled", "車齡_log_scaled", "內部往來次數_log_scaled",
    "近半年同業查詢次數_log_scaled", "負債月所得比_scaled",
]
# substring groups in order of priority, then the class they give
FEATURE_CLASSES = [
    (["交互", "比"], "cross_feature"),
    (["是否缺失", "異常旗標", "是否特殊值"], "missing_flag"),
    (["序位"], "ordinal"),
    (["二元"], "binary"),
    (["頻率"], "frequency_encoded"),
    (["scaled", "log"], "numeric_scaled"),
]

# --- calendar ----------------------------------------------------------------
DATA_START = dt.date(2024, 4, 1)
OOT_START = dt.date(2025, 10, 1)
TRAIN_MONTHS, MONITOR_MONTHS, STEP_MONTHS = 4, 2, 2
DEVELOPMENT_MONTHS, POLICY_MONTHS, HOLDOUT_MONTHS = 18, 4, 2

# --- zones and thresholds ----------------------------------------------------
ZONE_NAMES = {2: "高通過機率區", 1: "人工審核區", 0: "低通過機率區"}
DEFAULT_LOWER, DEFAULT_UPPER = 0.5, 0.85
LOWER_GRID = [0.30, 0.40, 0.50, 0.60, 0.70, 0.80]
UPPER_GRID = [0.70, 0.80, 0.85, 0.90, 0.95]
MIN_GRID_GAP = 0.15
POLICY = {
    "max_manual": 0.15, "min_auto": 0.85, "min_low": 0.02,
    "precision_high": 0.95, "precision_low": 0.70, "target_auto": 0.90,
    "w_precision": 0.40, "w_auto": 0.35, "w_balance": 0.25,
    "low_bonus": 0.1, "precision_bonus": 0.05,
}

# --- model selection ---------------------------------------------------------
CHAMPION_WEIGHTS = {
    "cv_auc": 0.10, "monitor_auc": 0.20, "monitor_f1_reject": 0.35, "monitor_ks": 0.15, "stability": 0.20,
}
LEGACY_CHAMPION_WEIGHTS = {
    "cv_auc": 0.25, "monitor_auc": 0.35, "monitor_f1_reject": 0.30, "monitor_ks": 0.0, "stability": 0.10,
}
TUNING_WEIGHTS = {
    "holdout_f1_reject": 0.25, "avg_monitor_f1_reject": 0.15, "holdout_brier": 0.15, "avg_monitor_brier": 0.10,
    "holdout_auc": 0.10, "avg_monitor_auc": 0.10, "stability_score": 0.15,
}
DECISION = {
    "w_low_zone_reject_precision": 0.25, "w_high_zone_approve_precision": 0.15, "w_manual_review": 0.15,
    "w_holdout_f1_reject": 0.15, "w_holdout_brier": 0.10, "w_holdout_auc": 0.10, "w_holdout_ks": 0.10,
    "overfitting_weight": 2.0, "max_train_monitor_auc_gap": 0.03, "max_monitor_holdout_auc_gap": 0.04,
    "max_stability_score": 0.03, "robustness_weight": 1.5, "max_f1r_gap": 0.05, "max_calibration_gap": 0.10,
    "min_high_zone_approve_precision": 0.98, "max_manual_review_ratio": 0.12, "min_auto_decision_rate": 0.85,
    "hard_train_monitor_auc_gap": 0.08, "target_low_zone_reject_precision": 0.65,
}
UPGRADE = {
    "precision_gain": 0.005, "workload_slack": 0.02, "auc_slack": 0.01, "f1_reject_slack": 0.02,
    "min_high_precision": 0.98, "max_overfitting": 0.03,
}
MONITORING = {
    "min_auc": 0.85, "min_f1_reject": 0.30, "max_score_psi": 0.25, "retrain_months": 6,
    "warning_auc": 0.88, "warning_score_psi": 0.10, "warning_zone_shift": 0.10,
}

# --- candidate learners (names and parameters) -------------------------------
BASE_CANDIDATES = {
    "logistic_regression": {"C": 0.5, "max_iter": 1000},
    "random_forest": {"trees": 300, "depth": 6, "min_leaf": 20, "min_split": 50},
    "boosted_trees": {"trees": 300, "depth": 3, "rate": 0.03, "min_leaf": 20, "subsample": 0.7, "columns": 0.7,
                      "l1": 1.0, "l2": 5.0, "gamma": 1.0, "max_step": 1},
}
# Named by trees and depth.
TUNING_CANDIDATES = [
    ("boosted_300_depth3", "boosted_trees", {"trees": 300, "depth": 3, "rate": 0.03, "min_leaf": 20, "subsample": 0.7, "columns": 0.7,
      "l1": 1.0, "l2": 5.0, "gamma": 1.0, "max_step": 1}),
    ("boosted_400_depth3", "boosted_trees", {"trees": 400, "depth": 3, "rate": 0.02, "min_leaf": 30, "subsample": 0.7, "columns": 0.6,
      "l1": 2.0, "l2": 8.0, "gamma": 1.5, "max_step": 2}),
    ("boosted_300_depth4", "boosted_trees", {"trees": 300, "depth": 4, "rate": 0.03, "min_leaf": 15, "subsample": 0.8, "columns": 0.7,
      "l1": 1.0, "l2": 5.0, "gamma": 0.5, "max_step": 1}),
    ("boosted_500_depth2", "boosted_trees", {"trees": 500, "depth": 2, "rate": 0.03, "min_leaf": 25, "subsample": 0.7, "columns": 0.6,
      "l1": 3.0, "l2": 10.0, "gamma": 2.0, "max_step": 2}),
    ("forest_300_depth6", "random_forest", {"trees": 300, "depth": 6, "min_leaf": 20, "min_split": 50}),
    ("forest_500_depth5", "random_forest", {"trees": 500, "depth": 5, "min_leaf": 30, "min_split": 80}),
]
TUNING_CALIBRATIONS = ["isotonic", "sigmoid", "none"]
DECISION_CANDIDATES = [
    ("boosted_300_depth3", "boosted_trees", {"trees": 300, "depth": 3, "rate": 0.03, "min_leaf": 20, "subsample": 0.7, "columns": 0.7,
      "l1": 1.0, "l2": 5.0, "gamma": 1.0, "max_step": 1}),
    ("boosted_500_depth2", "boosted_trees", {"trees": 500, "depth": 2, "rate": 0.02, "min_leaf": 30, "subsample": 0.65, "columns": 0.6,
      "l1": 3.0, "l2": 12.0, "gamma": 2.5, "max_step": 2}),
    ("boosted_400_depth3", "boosted_trees", {"trees": 400, "depth": 3, "rate": 0.025, "min_leaf": 25, "subsample": 0.7, "columns": 0.65,
      "l1": 2.0, "l2": 8.0, "gamma": 2.0, "max_step": 2}),
    ("boosted_300_depth4", "boosted_trees", {"trees": 300, "depth": 4, "rate": 0.03, "min_leaf": 15, "subsample": 0.75, "columns": 0.7,
      "l1": 1.5, "l2": 6.0, "gamma": 1.0, "max_step": 1}),
    ("boosted_400_depth4", "boosted_trees", {"trees": 400, "depth": 4, "rate": 0.02, "min_leaf": 25, "subsample": 0.7, "columns": 0.6,
      "l1": 2.5, "l2": 10.0, "gamma": 1.5, "max_step": 2}),
    ("boosted_350_depth3", "boosted_trees", {"trees": 350, "depth": 3, "rate": 0.03, "min_leaf": 20, "subsample": 0.7, "columns": 0.7,
      "l1": 1.5, "l2": 6.0, "gamma": 1.0, "max_step": 3}),
    ("boosted_800_depth3", "boosted_trees", {"trees": 800, "depth": 3, "rate": 0.01, "min_leaf": 20, "subsample": 0.7, "columns": 0.7,
      "l1": 1.5, "l2": 6.0, "gamma": 1.0, "max_step": 2}),
    ("forest_500_depth5", "random_forest", {"trees": 500, "depth": 5, "min_leaf": 30, "min_split": 80}),
]
DECISION_CALIBRATIONS = ["isotonic", "sigmoid"]

# --- experiments planned after a diagnosis -----------------------------------
EXPERIMENTS = [  # id, learner, calibration, adds features, drops features, hypothesis, target metric
    ("C1_reject_features", "boosted_trees", "isotonic", True, False, "reject signal is too weak", "f1_reject"),
    ("C2_feature_cleanup", "boosted_trees", "isotonic", False, True, "noisy features hurt calibration", "brier_score"),
    ("C3_combined", "boosted_trees", "isotonic", True, True, "improve signal and noise together", "f1_reject, brier_score"),
    ("C4_no_calibration", "boosted_trees", "none", False, False, "calibration overfits the rejects", "brier_score"),
    ("C5_forest", "random_forest", "isotonic", False, False, "a forest may be steadier", "stability_score"),
]
EXPERIMENT_FEATURES = [f"{c}_scaled" for c in CROSS_FEATURES]
EXPERIMENT_PROTOCOL = {"windows": "rolling, all", "selection": "policy part", "judgement": "blind holdout, same rows as the baseline"}
