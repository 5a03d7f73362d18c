"""Column names, table schemas and fixed limits."""

from __future__ import annotations

from pyspark.sql.types import (
    BooleanType,
    DoubleType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampType,
)

V_COLS = [f"V{i}" for i in range(1, 29)]
RAW_COLUMNS = ["Time", *V_COLS, "Amount", "Class"]

RAW_SCHEMA = StructType(
    [StructField(c, DoubleType()) for c in ["Time", *V_COLS, "Amount"]]
    + [StructField("Class", LongType())]
)

# --- fixed values: limits and vocabularies of the data contract -------------
AMOUNT_MIN = 0.0
AMOUNT_MAX = 26000.0
CLASS_VALUES = [0, 1]
SERVING_AMOUNT_CAP = 30000.0
NULL_TOKENS = ["", " ", "NA", "N/A", "null", "NULL", "None"]
FEEDBACK_SOURCES = ["chargeback", "manual_review", "customer_report", "delayed_settlement"]
EXPECTED_ROWS = 284807
MISSING_LIMIT = 0.2
OUTLIER_Z = 3.0
HIGH_CARDINALITY = 50
HIGH_CORRELATION = 0.95
THRESHOLDS = [0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9]
KEY_THRESHOLDS = [0.3, 0.5, 0.7]
MISSED_FRAUD_LOSS = 500.0
FALSE_DECLINE_LOSS = 300.0
FPR_DRIFT_LIMIT = 0.20
PR_AUC_DRIFT_LIMIT = 0.10
# ----------------------------------------------------------------------------


def _fields(**types) -> StructType:
    return StructType([StructField(name, dtype) for name, dtype in types.items()])


TRANSACTIONS = StructType(
    [
        StructField("transaction_id", StringType()),
        StructField("timestamp_received", TimestampType()),
        StructField("time_seconds", DoubleType()),
        StructField("amount", DoubleType()),
        *[StructField(c.lower(), DoubleType()) for c in V_COLS],
        *[
            StructField(c, StringType())
            for c in ["card_id", "merchant_id", "merchant_category", "device_id", "ip_address"]
        ],
    ]
)

PREDICTIONS = _fields(
    prediction_id=StringType(),
    transaction_id=StringType(),
    model_name=StringType(),
    model_version=StringType(),
    fraud_probability=DoubleType(),
    is_fraud=BooleanType(),
    decision_threshold=DoubleType(),
    inference_time_ms=DoubleType(),
    created_at=TimestampType(),
)

GROUND_TRUTH = _fields(
    feedback_id=StringType(),
    transaction_id=StringType(),
    true_label=IntegerType(),
    feedback_source=StringType(),
    reported_at=TimestampType(),
    notes=StringType(),
)

MODEL_REGISTRY = _fields(
    model_id=StringType(),
    model_name=StringType(),
    model_version=StringType(),
    model_filepath=StringType(),
    metrics=StringType(),
    is_active=BooleanType(),
    deployed_at=TimestampType(),
    decommissioned_at=TimestampType(),
)

MONITORING_METRICS = _fields(
    check_id=StringType(),
    model_name=StringType(),
    check_timestamp=TimestampType(),
    metric_type=StringType(),
    metric_value=DoubleType(),
    baseline_value=DoubleType(),
    deviation_percent=DoubleType(),
    is_warning=BooleanType(),
    is_critical=BooleanType(),
    details=StringType(),
    action_taken=StringType(),
    resolved_at=TimestampType(),
)

SCORE_REQUEST = StructType(
    [StructField(c, DoubleType()) for c in ["Time", "Amount", *V_COLS]]
)

EVALUATION_DOC = StructType(
    [
        *[
            StructField(c, DoubleType())
            for c in [
                "pr_auc", "roc_auc", "average_precision", "precision", "recall", "f1_score",
                "specificity", "false_positive_rate", "fpr", "false_negative_rate",
                "inference_time_seconds", "inference_time_ms_per_sample", "threshold", "fraud_rate",
            ]
        ],
        *[
            StructField(c, LongType())
            for c in ["test_samples", "train_samples", "fraud_caught", "fraud_missed", "legitimate_declined"]
        ],
        StructField(
            "confusion_matrix",
            StructType(
                [
                    StructField(c, LongType())
                    for c in ["true_negatives", "false_positives", "false_negatives", "true_positives"]
                ]
            ),
        ),
        StructField("dataset_type", StringType()),
        StructField(
            "cv_metrics",
            StructType(
                [
                    StructField(m, StructType([StructField("mean", DoubleType()), StructField("std", DoubleType())]))
                    for m in ["average_precision", "roc_auc", "recall", "precision", "f1", "specificity", "tnr"]
                ]
            ),
        ),
    ]
)
